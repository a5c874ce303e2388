"""Column-expression helpers.

All helpers return ``pyspark.sql.Column`` objects built from built-in functions, so they
stay inside whole-stage code generation. None of them touches data on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isin_safe(c: str | Column, values: Iterable) -> Column:
    """Set membership that is never NULL: a missing value is simply "not in the set"."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def all_null(cols: Sequence[str]) -> Column:
    """True when every one of ``cols`` is missing (duplicates are harmless)."""
    uniq = list(dict.fromkeys(cols))
    return reduce(and_, [F.col(c).isNull() for c in uniq])


def any_of(conds: Sequence[Column]) -> Column:
    return reduce(or_, conds)


def all_of(conds: Sequence[Column]) -> Column:
    return reduce(and_, conds)


def code_to_null(c: str | Column, code: str = "NA") -> Column:
    """A text code that stands for "missing" becomes NULL."""
    return F.nullif(col(c), F.lit(code))


def recode(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace values by a literal map; unmapped values (and NULL) are kept."""
    if not mapping:
        return col(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(lookup, col(c)), col(c))


def first_match(c: str | Column, cases: Sequence[tuple[Column, object]], default: Column | None = None) -> Column:
    """``case_when`` semantics: the first true condition wins, else ``default`` (the column)."""
    expr = None
    for cond, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    fallback = col(c) if default is None else default
    return fallback if expr is None else expr.otherwise(fallback)


def fill_level(c: str | Column, level) -> Column:
    """Missing becomes an explicit level."""
    return F.coalesce(col(c), F.lit(level))


def member_count(cols: Sequence[str], values: Iterable) -> Column:
    """How many of ``cols`` hold a value in ``values`` (0..len(cols)); NULL counts as no."""
    vals = list(values)
    return reduce(lambda a, b: a + b, [isin_safe(c, vals).cast("int") for c in cols])


def signed_indicator(cols: Sequence[str], negative: Iterable, positive: Iterable) -> Column:
    """-1 if any column holds a negative value (checked first), else +1 if any holds a
    positive value, else 0."""
    neg, pos = list(negative), list(positive)
    return (F.when(any_of([isin_safe(c, neg) for c in cols]), F.lit(-1))
            .when(any_of([isin_safe(c, pos) for c in cols]), F.lit(1))
            .otherwise(F.lit(0)))


def replace_value(c: str | Column, old, new) -> Column:
    """Single-value correction, e.g. an obvious typo in a year."""
    return F.when(col(c) == F.lit(old), F.lit(new)).otherwise(col(c))


def floor_fallback(c: str | Column, floor, other: str | Column) -> Column:
    """Keep ``c`` when it is above ``floor``, else take ``other``; a NULL ``c`` stays NULL."""
    return F.when(col(c) <= F.lit(floor), col(other)).otherwise(col(c))


def equals_flag(c: str | Column, level, when_equal: int = 1) -> Column:
    """0/1 flag: ``when_equal`` if the column equals ``level``, else the other value.
    A NULL input gives NULL, as R's ``ifelse`` does."""
    eq = col(c).cast("string") == F.lit(str(level))
    return F.when(eq, F.lit(when_equal)).when(~eq, F.lit(1 - when_equal)).otherwise(F.lit(None).cast("int"))


def presence_flag(c: str | Column) -> Column:
    """0 when the amount is 0, else 1 (NULL stays NULL)."""
    return F.when(col(c) == 0, F.lit(0)).when(col(c).isNotNull(), F.lit(1)).otherwise(F.lit(None).cast("int"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Ratio that is NULL (not an error) for a zero denominator under ANSI mode."""
    return F.try_divide(col(num), col(den))


def log_positive(c: str | Column) -> Column:
    """Natural log; zero and negative inputs give NULL."""
    return F.when(col(c) > 0, F.log(col(c)))


def weighted_sum(terms: Mapping[str, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in terms.items()])


def skew_type3(c: str | Column, n: Column | None = None) -> Column:
    """Skewness as ``m3 / s^3`` with the sample (n-1) standard deviation: Spark's
    population ``skewness`` times ``((n-1)/n)^1.5``."""
    cnt = F.count(col(c)) if n is None else n
    return F.skewness(col(c)) * F.pow((cnt - 1) / cnt, F.lit(1.5))


def md5_order(seed, key: str | Column) -> Column:
    """Reproducible pseudo-random order of a key: md5 of ``seed|key``."""
    return F.md5(F.concat(F.lit(f"{seed}|"), col(key).cast("string")))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the rows where both are present, NULL (not an ANSI
    divide-by-zero error) when either side is constant there. An aggregate expression."""
    xc, yc = col(x).cast("double"), col(y).cast("double")
    sx = F.stddev_samp(F.when(yc.isNotNull(), xc))
    sy = F.stddev_samp(F.when(xc.isNotNull(), yc))
    return F.try_divide(F.covar_samp(xc, yc), sx * sy)
