"""Mixing sources to target weights, with DataFrame functions only.

Documents fall into cells (one level per margin: source, language, topic). Iterative
proportional fitting rakes the cells' token weights to every margin's target shares, a sum over
the cell table per margin and sweep. A document's probability is its cell's fitted ratio, scaled so that no probability exceeds 1; it is
kept when a hash of its key falls below that. With a stated share the raking is capped instead:
cells that would need more than all their tokens are kept whole and the others take up the rest,
so a scarce cell does not lower the probabilities of the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.base import cut_lineage, hex_uniform, text_or_empty

TOKEN = r"[^ \t\n\r]+"


def count_tokens(text: Column) -> Column:
    """Runs of other than white space."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text, for tables without a topic column: figures (a number in
    every 50 tokens), lines (a line break in every 16), short (under 100 tokens), prose."""
    n = count_tokens(text)
    return (F.when(F.regexp_count(text, F.lit("[0-9]+")) * 50 >= n, F.lit("figures"))
            .when(F.regexp_count(text, F.lit("\n")) * 16 >= n, F.lit("lines"))
            .when(n < 100, F.lit("short")).otherwise(F.lit("prose")))


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares proportional to a power of each level's tokens: ``level, share``. A level
    without tokens has no target."""
    by = cells.groupBy(F.col(margin).alias("level")).agg(F.sum("tokens").alias("t")).filter("t > 0")
    weight = F.pow(F.col("t").cast("double"), F.lit(float(power)))
    total = by.agg(F.sum(weight).alias("total"))
    return cut_lineage(by.select("level", (weight / total.scalar()).alias("share")))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-10, max_sweeps: int = 60,
         sweeps_per_table: int = 3, broadcast_rows: int = 500_000) -> DataFrame:
    """``cells`` with ``ratio``: the fitted weight over the token share, the product of one
    factor per margin.

    ``cells``: one row per combination of levels, ``tokens`` long; the table has at most as many
    rows as there are combinations. ``targets``: per margin ``level, share`` (the levels with
    tokens; shares sum to 1). A sweep scales the weights to each margin in turn; every
    ``sweeps_per_table`` sweeps they are written to the shared folder, until no weight moves by
    more than ``tolerance`` (relative) in a sweep. Where empty cells keep the margins from being
    met together, the last of ``max_sweeps`` sweeps stands: the margin swept last is met exactly.
    Cells without tokens get the ratio 1.
    """
    base = cells.filter("tokens > 0")
    whole = base.agg(F.sum("tokens").alias("t")).first()["t"]
    if not whole:
        return cells.withColumn("ratio", F.lit(1.0))
    df = base.withColumn("__w", F.col("tokens") / F.lit(float(whole)))
    for m, t in targets.items():
        share = t.select(F.col("level").alias("__l"), F.col("share").alias(f"__share_{m}"))
        share = F.broadcast(share) if t.count() <= broadcast_rows else share
        df = df.join(share, df[m].eqNullSafe(F.col("__l"))).drop("__l")
    done = 0
    while done < max_sweeps:
        for _ in range(sweeps_per_table):
            df = df.withColumn("__before", F.col("__w"))
            for m in targets:
                df = df.withColumn("__w", F.col("__w") * F.col(f"__share_{m}") / F.sum("__w").over(Window.partitionBy(m)))
        done += sweeps_per_table
        df = cut_lineage(df)
        if df.agg(F.max(F.abs(F.col("__w") / F.col("__before") - 1))).first()[0] <= tolerance:
            break
    fitted = df.withColumn("ratio", F.col("__w") * F.lit(float(whole)) / F.col("tokens")).select(*cells.columns, "ratio")
    return fitted.unionByName(cells.filter("tokens <= 0").withColumn("ratio", F.lit(1.0)))


def mixture(docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], text_col: str = "text",
            budget_tokens: float | None = None) -> DataFrame:
    """Cells with their ``probability``: the ratio over the largest ratio of a cell with tokens
    (so the margins are met and none exceeds 1), lowered further to a token budget if given."""
    rows = docs.select(count_tokens(text_or_empty(docs[text_col])).alias("tokens"), *[c.alias(m) for m, c in margins.items()])
    cells = cut_lineage(rows.groupBy(*margins).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    targets = {m: tempered(cells, m, powers[m]) for m in margins}
    cells = cut_lineage(rake(cells, targets))
    top = cells.filter("tokens > 0").agg(F.max("ratio").alias("top"), F.sum(F.col("tokens") * F.col("ratio")).alias("sum")).first()
    scale = 1.0 / top["top"] if top["top"] else 1.0
    if budget_tokens is not None and top["sum"]:
        scale = min(scale, budget_tokens / top["sum"])
    return cut_lineage(cells.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale))))


def capped_targets(cells: DataFrame, margin: str, target: DataFrame, budget: float) -> DataFrame:
    """Tokens to keep per level, ``level, target``: the budget by the target shares, where a level
    whose share is more than all its tokens gives these and the other levels take up the rest."""
    by = cells.groupBy(F.col(margin).alias("__l")).agg(F.sum("tokens").alias("t"))
    levels = cut_lineage(target.join(by, F.col("level").eqNullSafe(F.col("__l"))).select("level", "share", F.col("t").cast("double").alias("t")))
    factor, full, n = budget, F.lit(False), -1
    while True:                                               # the full levels only grow in number
        full = F.col("share") * F.lit(float(factor)) >= F.col("t")
        got = levels.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("t")).otherwise(0.0)).alias("t"),
                         F.sum(F.when(~full, F.col("share")).otherwise(0.0)).alias("share")).first()
        if got["n"] == n or not got["share"]:
            break
        n, factor = got["n"], max(factor, (budget - got["t"]) / got["share"])
    return levels.select("level", F.when(full, F.col("t")).otherwise(F.col("share") * F.lit(float(factor))).alias("target"))


def rake_capped(cells: DataFrame, targets: dict[str, DataFrame], budget_tokens: float, tolerance: float = 1e-6,
                max_sweeps: int = 60, sweeps_per_table: int = 3, broadcast_rows: int = 500_000) -> DataFrame:
    """``cells`` with ``probability``: the token weights raked to the margins' targets of a token
    budget, none above the cell's tokens.

    A sweep finds per level the factor that meets the level's target when cells past their tokens
    stand at these: the largest, over the cells by falling ratio, of (target less the tokens of
    the cells before) / (weight of the rest). Levels that cannot be met give all they have (see
    ``capped_targets``, ``unmet``); cells without tokens get the probability 1.
    """
    base = cells.filter("tokens > 0")
    whole = base.agg(F.sum("tokens").alias("t")).first()["t"]
    if not whole:
        return cells.withColumn("probability", F.lit(1.0))
    df = base.withColumn("__w", F.col("tokens") * F.lit(min(1.0, budget_tokens / whole)))
    for m, t in targets.items():
        goal = capped_targets(base, m, t, budget_tokens).select(F.col("level").alias("__l"), F.col("target").alias(f"__t_{m}"))
        goal = F.broadcast(goal) if t.count() <= broadcast_rows else goal
        df = df.join(goal, df[m].eqNullSafe(F.col("__l"))).drop("__l")
    done = 0
    while done < max_sweeps:
        for _ in range(sweeps_per_table):
            df = df.withColumn("__before", F.col("__w"))
            for m in targets:
                level = Window.partitionBy(m)
                before = (level.orderBy(F.desc(F.col("__w") / F.col("tokens")), *[x for x in targets if x != m])
                          .rowsBetween(Window.unboundedPreceding, -1))
                rest = F.sum("__w").over(level) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
                need = F.col(f"__t_{m}") - F.coalesce(F.sum("tokens").over(before), F.lit(0))
                df = df.withColumn("__f", F.when(rest > 1e-12 * F.col("__w"), need / rest))
                df = df.withColumn("__w", F.least(F.col("tokens").cast("double"), F.col("__w") * F.max("__f").over(level)))
        done += sweeps_per_table
        df = cut_lineage(df)
        if df.agg(F.max(F.abs(F.col("__w") - F.col("__before")) / F.col("tokens"))).first()[0] <= tolerance:
            break
    fitted = df.select(*cells.columns, (F.col("__w") / F.col("tokens")).alias("probability"))
    return fitted.unionByName(cells.filter("tokens <= 0").withColumn("probability", F.lit(1.0)))


def calibrated(docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], share: float,
               text_col: str = "text", tolerance: float = 1e-6) -> DataFrame:
    """Cells with the ``probability`` under which the stated share of all tokens is expected to
    be kept, at margins as near the tempered targets as the cells' tokens allow. A cell that is too
    small for its target is kept whole and lowers no other cell's probability."""
    rows = docs.select(count_tokens(text_or_empty(docs[text_col])).alias("tokens"), *[c.alias(m) for m, c in margins.items()])
    cells = cut_lineage(rows.groupBy(*margins).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    whole = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    return cut_lineage(rake_capped(cells, {m: tempered(cells, m, powers[m]) for m in margins}, share * whole, tolerance))


def unmet(cells: DataFrame, powers: dict[str, float], tolerance: float = 1e-3) -> DataFrame:
    """The margins that ``cells`` with their ``probability`` leave unmet: ``margin, level, target,
    reached`` (shares of the kept tokens) where these differ by more than ``tolerance``."""
    kept = cells.filter("tokens > 0").withColumn("__k", F.col("tokens") * F.col("probability"))
    out = []
    for m, power in powers.items():
        by = kept.groupBy(F.col(m).alias("__l")).agg(F.sum("__k").alias("k")).withColumn("all", kept.agg(F.sum("__k")).scalar())
        both = tempered(cells, m, power).join(by, F.col("level").eqNullSafe(F.col("__l")))
        out.append(both.select(F.lit(m).alias("margin"), F.col("level").cast("string").alias("level"),
                               F.col("share").alias("target"), (F.col("k") / F.col("all")).alias("reached")))
    return reduce(DataFrame.unionByName, out).filter(F.abs(F.col("target") - F.col("reached")) > tolerance)


def assigned(docs: DataFrame, margins: dict[str, Column], cells: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """All rows and columns of ``docs`` with ``__probability`` and ``__kept``.

    The draw is a hash of the id as text (of the text where the id is null), so it does not
    change with the order of rows; repeated rows share a draw. A null level is a level of its
    own, a null text is empty; columns of ``docs`` keep their names and values.
    """
    key = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("null:"), F.md5(F.encode(text_or_empty(docs[text_col]), "UTF-8"))))
    df = docs.withColumns({f"__m_{m}": c for m, c in margins.items()} | {"__u": hex_uniform(key)})
    p = cells.select(*[F.col(m).alias(f"__c_{m}") for m in margins], F.col("probability").alias("__probability"))
    p = F.broadcast(p) if p.count() <= broadcast_rows else p
    on = reduce(lambda x, y: x & y, [F.col(f"__m_{m}").eqNullSafe(F.col(f"__c_{m}")) for m in margins])
    df = df.join(p, on, "left").withColumn("__kept", F.col("__u") < F.col("__probability"))
    return df.drop(*[f"__c_{m}" for m in margins], *[f"__m_{m}" for m in margins], "__u")


def document_margins(docs: DataFrame) -> dict[str, Column]:
    return {"source": docs["source"].cast("string"), "lang": docs["lang"].cast("string"),
            "topic": form_topic(text_or_empty(docs["text"]))}


#: Powers of the token shares that the targets of the registered query follow.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Share of all tokens that the registered query and the pipeline's mixing stage keep.
SHARE = 0.5


def sql(sweeps: int = 60, share: float = SHARE) -> str:
    """The registered query in SQL: targets, caps and sweeps written out."""
    names = list(POWERS)
    n = "len(regexp_extract_all(text, '[^ \\t\\n\\r]+'))"
    out = [f"""WITH rows_ AS (SELECT doc_id, source, lang, n AS tokens, CASE
      WHEN len(regexp_extract_all(text, '[0-9]+')) * 50 >= n THEN 'figures'
      WHEN len(regexp_extract_all(text, '\\n')) * 16 >= n THEN 'lines'
      WHEN n < 100 THEN 'short' ELSE 'prose' END AS topic,
      coalesce(doc_id::VARCHAR, 'null:' || md5(text)) AS key
    FROM (SELECT doc_id, source, lang, text, {n} AS n FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents) d) e),
    cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM rows_ GROUP BY ALL),
    goal AS (SELECT {share} * sum(tokens) AS b FROM cells)"""]
    for m in names:
        # a level whose share of the budget is more than its tokens gives these; the others' factor is the
        # largest of (budget less the full levels) / (shares of the rest), by rising tokens per share
        out.append(f"""s_{m} AS (SELECT level, t, pow(t, {POWERS[m]}) / sum(pow(t, {POWERS[m]})) OVER () AS share
      FROM (SELECT {m} AS level, sum(tokens) AS t FROM cells GROUP BY 1 HAVING sum(tokens) > 0)),
    g_{m} AS MATERIALIZED (SELECT level, least(t, share * max(f) OVER ()) AS target FROM (
      SELECT *, (b - coalesce(sum(t) OVER (ORDER BY t / share, level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(share) OVER (ORDER BY t / share, level ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM s_{m}, goal))""")
    goals = " ".join(f"JOIN g_{m} ON cells.{m} IS NOT DISTINCT FROM g_{m}.level" for m in names)
    out.append("w_0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens * least(1.0, b / (SELECT sum(tokens) FROM cells)) AS w, "
               + ", ".join(f"g_{m}.target AS t_{m}" for m in names) + f" FROM cells {goals}, goal WHERE tokens > 0)")
    k = 0
    for _ in range(sweeps):
        for m in names:
            others = ", ".join(x for x in names if x != m)
            before = f"OVER (PARTITION BY {m} ORDER BY w / tokens DESC, {others} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
            out.append(f"""w_{k + 1} AS MATERIALIZED (SELECT * REPLACE (least(tokens, w * max(CASE WHEN rest > 1e-12 * w THEN need / rest END) OVER (PARTITION BY {m})) AS w)
      FROM (SELECT * EXCLUDE (need, rest), t_{m} - coalesce(sum(tokens) {before}, 0) AS need,
                   sum(w) OVER (PARTITION BY {m}) - coalesce(sum(w) {before}, 0) AS rest FROM w_{k}))""".replace(
                       "* EXCLUDE (need, rest)", "*" if k == 0 else "* EXCLUDE (need, rest)"))
            k += 1
    return ",\n".join(out) + f"""
    SELECT doc_id, r.source, r.lang, r.topic, r.tokens, round(coalesce(w / c.tokens, 1.0), 5) AS probability,
      ('0x' || substr(md5(key), 1, 13))::BIGINT / 4503599627370496.0 < coalesce(w / c.tokens, 1.0) AS kept
    FROM rows_ r LEFT JOIN w_{k} c ON r.source IS NOT DISTINCT FROM c.source AND r.lang IS NOT DISTINCT FROM c.lang AND r.topic = c.topic"""
