"""Secret scans with multipart credential linking, with DataFrame functions only.

Strong matches (the base kinds) are always reported. Weak candidates - short key identifiers,
opaque mixed strings and endpoints - say little alone, so they are reported only where parts
of different roles meet: an interval join links access identifiers, secrets and endpoints
whose spans lie apart and within ``scope`` code points of each other in one text. What is part of
an endpoint's own URL is no partner of endpoints, and paths are no candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, text_or_empty

# Fixed values of the base scan: kind, pattern, least length (of the last group, if it has one).
ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+")
ASSIGN_HEAD = ASSIGN.removesuffix("[A-Za-z0-9+/_.=-]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"          # maximal runs, so the same matches as [0-9a-f]+ of 24 and more
BASE_KINDS = ("assign", "access", "hex")

#: Weak candidates: kind -> (pattern, role).
WEAK = {
    "weak_id": (r"\b(?:A[SG]IA|AKIA|AROA|AIDA)[A-Z0-9]{4,}", "id"),
    "weak_secret": (r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Za-z])[A-Za-z0-9+/]{16,}={0,2}", "secret"),
    "endpoint": (r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?|\b[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}\b", "endpoint"),
}
ROLES = {"assign": "secret", "hex": "secret", "access": "id"} | {k: role for k, (_, role) in WEAK.items()}
#: An endpoint with the path of its URL, and with the whole of it.
URL_PATH = rf"(?:{WEAK['endpoint'][0]})(?:/[A-Za-z0-9+/._~%:@!$&()*-]*)?"
URL = URL_PATH + r"(?:[?#][A-Za-z0-9+/._~%:@!$&()*?#=-]*)?"
PATH_WORD = r"[0-9]*(?:[a-z]+|[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*)?[0-9]*"
#: Strings with a slash whose segments all are words or numbers; a random string's are not.
PATH = rf"^(?=[^/]*/){PATH_WORD}(?:[/+]{PATH_WORD})+=*$"
SPAN = "array<struct<kind:string,start:int,end:int>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join, empty: Column) -> Column:
    """Inclusive running fold of an array by an associative ``join``, by doubling: round k joins every
    element with the one 2^k places before it, so n elements take n log n steps and no array grows."""
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")
    before = lambda a, k: F.slice(F.concat(F.array_repeat(empty, F.call_function("shiftleft", F.lit(1), k)), a), F.lit(1), F.size(a))
    fold = lambda a, k: F.zip_with(before(a, k), a, join)
    rest = F.when(rounds > 0, F.sequence(F.lit(0), rounds - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, values, fold)


def running_max(values: Column) -> Column:
    return running(values, lambda x, y: F.greatest(x, y), F.lit(-1))


def spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end) in code points. The gaps between
    the matches come from splitting by the same pattern; ends are running sums of lengths."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)                    # one more than there are matches
    pairs = F.filter(F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), (F.length(m) + F.length(g)).alias("n"))),
                     lambda p: p["m"].isNotNull())

    def placed(p: Column) -> Column:
        ends = running(F.transform(p, lambda x: x["n"]), lambda x, y: x + y, F.lit(0))
        return F.zip_with(p, ends, lambda x, e: F.struct(
            F.lit(kind).alias("kind"), (e - F.length(x["m"])).alias("start"), e.alias("end"), x["m"].alias("m")))

    out = let(pairs, placed)
    out = out if keep is None else F.filter(out, lambda s: keep(s["m"]))
    bare = F.transform(out, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), bare).otherwise(F.array().cast(SPAN))


def flagged(spans_: Column, others: Column, inside: bool = False) -> Column:
    """``spans_`` as (s, flag), by end: whether a span overlaps any of ``others`` (``inside``: lies
    within one). Both kinds are sorted along the text once; the furthest end of the others that
    have begun decides, so the cost is that of the sort."""
    at = lambda s: s["start"] if inside else s["end"]
    # at the same place an other that begins there comes first only for ``inside`` (start <= start)
    mine = F.transform(spans_, lambda s: F.struct(at(s).alias("p"), F.lit(1 if inside else 0).alias("t"), F.lit(-1).alias("reach"), s.alias("s")))
    theirs = F.transform(others, lambda s: F.struct(s["start"].alias("p"), F.lit(0 if inside else 1).alias("t"), s["end"].alias("reach"), s.alias("s")))

    def swept(events: Column) -> Column:
        reach = running_max(F.transform(events, lambda e: e["reach"]))
        hit = (lambda e, r: r >= e["s"]["end"]) if inside else (lambda e, r: r > e["s"]["start"])
        return F.zip_with(events, reach, lambda e, r: F.struct(e["s"].alias("s"), hit(e, r).alias("flag"), (e["reach"] < 0).alias("own")))

    return F.filter(let(F.array_sort(F.concat(mine, theirs)), swept), lambda x: x["own"])


def without(spans_: Column, others: Column, inside: bool = False) -> Column:
    """The spans that overlap none of ``others`` (``inside``: lie within none)."""
    left = F.transform(F.filter(flagged(spans_, others, inside), lambda x: ~x["flag"]), lambda x: x["s"])
    return F.when((F.size(spans_) > 0) & (F.size(others) > 0), left).otherwise(spans_)


def base_spans(text: Column) -> Column:
    """The base spans by start, then in the order of the kinds."""
    value_long = lambda m: F.length(F.regexp_replace(m, "^" + ASSIGN_HEAD, "")) >= ASSIGN_LEAST
    all_ = F.concat(spans(text, "assign", ASSIGN, value_long),
                    spans(text, "access", ACCESS, lambda m: F.length(m) >= ACCESS_LEAST),
                    spans(text, "hex", HEX))
    return ordered(all_)


def ordered(span_array: Column) -> Column:
    rank = lambda kind: F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate([*BASE_KINDS, *WEAK]) for x in (k, i)]), kind)
    keyed = F.transform(span_array, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"),
                                                       s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                               s["end"].alias("end")))


def as_text(span_array: Column) -> Column:
    return F.array_join(F.transform(span_array, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """Interval join: the weak parts that have a part of another role, apart from them and at
    most ``scope`` code points away, in the same text. ``parts``: key columns ``id, h`` and
    ``kind, start, end, in_url``; a part inside a URL is no partner of endpoints.

    A part is filed under every cell of ``scope`` code points that its span, widened by the
    scope, touches and probes the cells of its own span, so partners always share a cell and a
    join key holds only what one stretch of one text holds.
    """
    role = F.element_at(F.create_map(*[F.lit(x) for k, r in ROLES.items() for x in (k, r)]), F.col("kind"))
    p = parts.withColumn("role", role)
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    weak = p.filter(F.col("kind").isin(*WEAK)).withColumn("cell", cells(F.col("start"), F.col("end") - 1))
    wide = (p.select(F.col("id").alias("o_id"), F.col("h").alias("o_h"), F.col("role").alias("o_role"),
                     F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                     F.col("in_url").alias("o_in_url"), cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope).alias("o_cell"))
            .distinct())
    gap = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    meets = (F.col("id").eqNullSafe(F.col("o_id")) & (F.col("h") == F.col("o_h")) & (F.col("cell") == F.col("o_cell"))
             & (F.col("role") != F.col("o_role")) & gap.between(0, scope)
             & ~(F.col("in_url") & (F.col("o_role") == "endpoint")) & ~(F.col("o_in_url") & (F.col("role") == "endpoint")))
    return weak.join(wide, meets, "left_semi").select("id", "h", "kind", "start", "end").distinct()


def weak_spans(text: Column) -> Column:
    """The weak candidates. No opaque strings are those that look like a path, touch an endpoint
    or the path of its URL, or lie within a weak identifier."""
    opaque = spans(text, "weak_secret", WEAK["weak_secret"][0], lambda m: ~m.rlike(PATH))
    names = spans(text, "weak_id", WEAK["weak_id"][0])

    def chosen(parts: Column) -> Column:
        apart = without(without(parts["opaque"], parts["paths"]), parts["names"], inside=True)
        return F.concat(parts["names"], apart, parts["ends"])

    return let(F.struct(opaque.alias("opaque"), names.alias("names"), spans(text, "url", URL_PATH).alias("paths"),
                        spans(text, "endpoint", WEAK["endpoint"][0]).alias("ends")), chosen)


def scan(docs: DataFrame, scope: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text, one row per distinct (id, text): ``id, h, copies, base,
    spans`` where ``h`` is the md5 of the text, ``copies`` how many rows have it, ``base`` the
    base spans and ``spans`` these and the linked weak candidates that overlap no base span,
    by start.

    A null text is empty and has no span; null ids are matched with null; other columns are
    ignored whatever their names; an empty table gives no row. A very long text with n matches takes
    n log n steps beyond the regular expressions.
    """
    text = text_or_empty(docs[text_col])
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.md5(F.encode(text, "UTF-8")).alias("h"), text.alias("text"))
    rows = cut_lineage(rows.select("id", "h", base_spans(F.col("text")).alias("base"), weak_spans(F.col("text")).alias("weak"),
                                   spans(F.col("text"), "url", URL).alias("urls")))
    some = (rows.filter(F.size("weak") > 0).select("id", "h", "base", "urls", without(F.col("weak"), F.col("base")).alias("weak"))
            .filter(F.size("weak") > 0))
    parts = (some.select("id", "h", F.explode(flagged(F.concat("base", "weak"), F.col("urls"))).alias("x"))
             .select("id", "h", "x.s.*", (F.col("x.flag") & F.col("x.s.kind").isin("weak_secret", "hex")).alias("in_url")).distinct())
    added = (linked(parts, scope).groupBy(F.col("id").alias("a_id"), F.col("h").alias("a_h"))
             .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))
    one = rows.groupBy("id", "h").agg(F.count("*").alias("copies"), F.first("base").alias("base"))
    return (one.join(added, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("h") == F.col("a_h")), "left")
            .select("id", "h", "copies", "base", ordered(F.concat("base", F.coalesce("added", F.array().cast(SPAN)))).alias("spans")))


MANY = 64


def redacted(text: Column, span_array: Column, mark: str) -> Column:
    """The text with every span (by start; overlapping ones as one) replaced by a mark. A text of
    more than ``MANY`` spans is cut from its list of code points, as counting from the start for
    every piece would take its length times their number."""
    def joined(ends: Column, cut) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), F.size(ends))       # furthest end so far
        pieces = F.zip_with(span_array, before, lambda s, at: F.when(
            s["start"] >= at, F.concat(cut(at, s["start"] - at), F.lit(mark))).otherwise(F.lit("")))
        return F.concat(F.array_join(pieces, ""), cut(F.element_at(ends, -1), F.length(text)))

    ends = running_max(F.transform(span_array, lambda s: s["end"]))
    plain = lambda at, n: F.substring(text, at + 1, n)
    points = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    listed = lambda chars: lambda at, n: F.array_join(F.slice(chars, at + 1, n), "")
    return (F.when(F.size(span_array) > MANY, let(F.struct(ends.alias("e"), points.alias("p")), lambda x: joined(x["e"], listed(x["p"]))))
            .when(F.size(span_array) > 0, let(ends, lambda e: joined(e, plain))).otherwise(text))


def redact(docs: DataFrame, mark: str, changed: str | None = None, scope: int = 256, id_col: str = "doc_id",
           text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """All rows and columns of ``docs`` with the secret spans of the text replaced by the mark;
    ``changed`` names a boolean column to add. Null texts stay null."""
    found = cut_lineage(scan(docs, scope, id_col, text_col).filter(F.size("spans") > 0)
                        .select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("spans").alias("__spans")))
    found = F.broadcast(found) if found.count() <= broadcast_rows else found
    h = F.md5(F.encode(text_or_empty(docs[text_col]), "UTF-8"))
    out = docs.join(found, docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (h == F.col("__h")), "left")
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(redacted(F.col(text_col), F.col("__spans"), mark))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, *([F.col("__spans").isNotNull().alias(changed)] if changed else []))
