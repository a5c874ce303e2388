"""Reconciliation with a codebook and row filters.

P1 rename, P2 lead-then-alphabetical order, P3/P4 drop/select, P5 select by kind,
P7 text -> number, P8 number -> code, P9 validate against the codebook (wide, literal
arrays: no join), P10 number -> factor code, E1 code -> NULL, E2 first-match recode,
E3 NULL -> explicit level, U3 codebook violations (melted, broadcast anti join),
A4 distinct values, F1-F9 filters and rule reports.

Everything is one ``select`` over the input: per-column work is never a job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions import exprs as X
from tabreg.sources.codebook import Codebook


# -- projections ------------------------------------------------------------------------

def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``{old: new}``; names not present are ignored."""
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in df.columns})


def lead_then_sorted(df: DataFrame, lead: Sequence[str]) -> DataFrame:
    """The lead columns first, the rest in case-insensitive alphabetical order."""
    rest = sorted([c for c in df.columns if c not in lead], key=lambda c: (c.casefold(), c))
    return df.select(*lead, *rest)


def select_kind(df: DataFrame, kinds: Mapping[str, Sequence[str]], kind: str,
                exclude: Sequence[str] = ()) -> DataFrame:
    """P5: keep the columns of one kind (``numeric``/``ordered``/``unordered``)."""
    return df.select(*[c for c in kinds[kind] if c in df.columns and c not in exclude])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema (helper for P5 / T17: exclusions are explicit)."""
    num = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in num or f.dataType.simpleString().startswith("decimal")
            if f.name not in exclude]


# -- casts and codebook reconciliation --------------------------------------------------

def to_number(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text -> double; anything that does not parse becomes NULL (no ANSI error)."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def to_code(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number -> code text; integral doubles print without a trailing ``.0``."""
    def code(c: str) -> Column:
        v = F.col(c)
        return F.when(v.cast("double") == F.floor(v.cast("double")),
                      v.cast("double").cast("long").cast("string")).otherwise(v.cast("string"))
    return df.withColumns({c: code(c) for c in cols})


def codes_to_null(df: DataFrame, cols: Sequence[str], code: str = "NA") -> DataFrame:
    """A code meaning "missing" becomes NULL."""
    return df.withColumns({c: X.code_to_null(c, code) for c in cols})


def recode_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Literal value map, unmapped values kept."""
    return df.withColumn(column, X.recode(column, mapping))


def fill_levels(df: DataFrame, fills: Mapping[str, str]) -> DataFrame:
    """NULL -> an explicit level, per column."""
    return df.withColumns({c: X.fill_level(c, v) for c, v in fills.items()})


def reconcile(df: DataFrame, codebook: Codebook, columns: Sequence[str] | None = None,
              na_code: str = "NA", rank_suffix: str | None = "_rank",
              fills: Mapping[str, str] | None = None) -> DataFrame:
    """Validate categorical text against the codebook, in one projection.

    * the code ``na_code`` is kept when the codebook lists it as a level, else it is NULL;
    * any other value outside the level list becomes NULL;
    * ``fills`` then turns NULL into an explicit level (E3);
    * ordered columns get ``<col><rank_suffix>`` = 1-based position in the level list.
    """
    cols = [c for c in (columns or codebook.columns) if c in df.columns]
    fills = dict(fills or {})
    exprs: dict[str, Column] = {}
    for c in cols:
        levels = [str(v) for v in codebook.levels(c)]
        v = F.col(c).cast("string")
        if na_code not in levels:
            v = F.nullif(v, F.lit(na_code))
        checked = F.when(v.isin(levels), v)
        if c in fills:
            checked = F.coalesce(checked, F.lit(fills[c]))
        exprs[c] = checked
    out = df.withColumns(exprs)
    if rank_suffix:
        ranks = {}
        for c in cols:
            if codebook.kind(c) == "ordered":
                lv = F.array(*[F.lit(str(v)) for v in codebook.levels(c)])
                ranks[f"{c}{rank_suffix}"] = F.when(F.col(c).isNotNull(),
                                                    F.array_position(lv, F.col(c)).cast("int"))
        out = out.withColumns(ranks)
    return out


def codebook_violations(df: DataFrame, codebook_frame: DataFrame,
                        columns: Sequence[str]) -> DataFrame:
    """Every ``(column, value, count)`` present in the data but not in the codebook.

    One melted scan; counts are partial aggregates before the shuffle, so a hot value
    costs one row per task. The codebook side is broadcast (its size is the literal
    level lists)."""
    melted = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("_m")).select("_m.column", "_m.value").where(F.col("value").isNotNull())
    counts = melted.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = codebook_frame.select("column", F.col("level").alias("value"))
    return counts.join(F.broadcast(known), on=["column", "value"], how="left_anti")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A4."""
    return df.select(column).distinct()


# -- filters ----------------------------------------------------------------------------

def range_filter(df: DataFrame, column: str, lower=None, upper=None,
                 inclusive: bool = False) -> DataFrame:
    """``lower < column < upper``; NULL never passes."""
    c = F.col(column)
    conds = []
    if lower is not None:
        conds.append(c >= lower if inclusive else c > lower)
    if upper is not None:
        conds.append(c <= upper if inclusive else c < upper)
    return df.where(X.all_of(conds))


def rule_report(df: DataFrame, rules: Mapping[str, Column], fired_col: str = "fired") -> DataFrame:
    """rows where any rule fires, plus an array naming the rules that fired."""
    names = list(rules)
    fired = F.filter(F.array(*[F.when(F.coalesce(rules[n], F.lit(False)), F.lit(n)) for n in names]),
                     lambda x: x.isNotNull())
    return df.where(X.any_of([F.coalesce(rules[n], F.lit(False)) for n in names])).withColumn(fired_col, fired)


def rule_filter(df: DataFrame, keep_rules: Sequence[Column]) -> DataFrame:
    """keep rows that pass every rule (NULL fails, as in a ``filter``)."""
    return df.where(X.all_of(list(keep_rules)))


def complement_rules(rules: Mapping[str, tuple[str, float]]) -> tuple[dict[str, Column], list[Column]]:
    """One rule list, two uses (T15): ``{name: (column, threshold)}`` gives the report
    rules ``column >= threshold`` and the keep rules ``column < threshold``."""
    report = {n: F.col(c) >= t for n, (c, t) in rules.items()}
    keep = [F.col(c) < t for c, t in rules.values()]
    return report, keep


def missing_rows(df: DataFrame, column: str, missing: bool = True) -> DataFrame:
    """rows where ``column`` is (not) missing, e.g. unlabelled vs labelled."""
    return df.where(F.col(column).isNull() if missing else F.col(column).isNotNull())


def all_missing_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows where every one of ``cols`` is missing."""
    return df.where(X.all_null(cols))


def flag_large(df: DataFrame, value: str | Column, threshold: float, label_from: str,
               out: str = "label") -> DataFrame:
    """``label_from`` where ``|value| > threshold``, else the empty string."""
    v = F.col(value) if isinstance(value, str) else value
    return df.withColumn(out, F.when(F.abs(v) > threshold, F.col(label_from).cast("string")).otherwise(F.lit("")))
