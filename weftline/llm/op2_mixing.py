"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted into cells of source, language and topic. Raking scales the cells' token weights to one
marginal after another, SWEEPS times or until no marginal is further than a tolerance from its target; only cell rows take part, as a grouped sum and a join for each
marginal, so no task or driver gathers them. A cell's weight over its tokens is the rate at which its documents
are kept, scaled so that the largest rate is 1. The draw is a hash of doc_id, equal on every run.

DataFrame functions only: no Python runs on the executors.

Defined cases: a null source or language is the value '(none)'; a null or empty text counts one token, so no cell
weighs nothing; repeated rows count and are drawn alike; a value that targets leave out gets the weight 0;
a row without doc_id can't be drawn (kept is null, and sampled() leaves it); an empty table gives no rows. Only doc_id, text, lang and source are
read, and the column that a caller names as topic; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
TEMPER = 0.8
SWEEPS = 6
WORD = "[^ \\t\\n\\r\\f]+"
LONG_TOKENS, BRIEF_TOKENS = 1000, 120


def topic(text: Column, n_tokens: Column) -> Column:
    """A coarse topic by layout and length, where the caller has no better one: sample() and sampled() take any other as a column."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!! "), "shouting")
        .when(text.rlike("[%$&*#]{3} "), "symbols")
        .when(n_tokens < BRIEF_TOKENS, "brief")
        .when(n_tokens < LONG_TOKENS, "prose")
        .otherwise("long")
    )


def measured(docs: DataFrame, topics: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, n_tokens, topic); topics: an expression over docs in place of topic()."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in ("source", "lang")),
        F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1)).cast("long").alias("n_tokens"),
        text.alias("text"),
        (F.lit(None) if topics is None else F.coalesce(topics.cast("string"), F.lit(NONE))).alias("topic"),
    )
    own = topic(F.col("text"), F.col("n_tokens")) if topics is None else F.col("topic")
    return counted.select("doc_id", "source", "lang", "n_tokens", own.alias("topic"))


def tempered(cells: DataFrame, dimension: str, total: int, temper: float) -> DataFrame:
    """Targets (value, target): the shares of the corpus raised to a power below 1, which lifts the small values."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("n"), F.lit(temper)).alias("t"))
    scale = total / (sums.agg(F.sum("t")).first()[0] or 1.0)
    return sums.select(dimension, (F.col("t") * scale).alias("target"))


def residual(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest distance of a marginal from its target, in parts of the target; one number a dimension comes to the driver."""
    off = []
    for dimension, target in targets.items():
        have = cells.groupBy(dimension).agg(F.sum("w").alias("have")).join(target.where("target > 0"), dimension)
        off.append(have.agg(F.max(F.abs(F.col("have") / F.col("target") - 1))).first()[0] or 0.0)
    return max(off)


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float | None = None) -> DataFrame:
    """cells (dimensions, n) with the column w, whose sums over each dimension's values approach the targets.

    With a tolerance, sweeps end as soon as residual() is within it, and an error is raised if `sweeps` don't get there.
    Every sweep ends in a written table: the next one reads it twice, for the sums and for the cells.
    """
    cells = cells.withColumn("w", F.col("n").cast("double"))
    for _ in range(sweeps):
        if tolerance is not None and residual(cells, targets) <= tolerance:
            return cells
        for dimension, target in targets.items():
            factor = cells.groupBy(dimension).agg(F.sum("w").alias("have")).join(target, dimension).select(dimension, F.expr("coalesce(try_divide(target, have), 0)").alias("factor"))
            cells = cells.join(factor, dimension, "left").withColumn("w", F.col("w") * F.coalesce("factor", F.lit(0.0))).drop("factor")
        cells = written(cells, "raked")
    if tolerance is not None and residual(cells, targets) > tolerance:
        raise ValueError(f"the marginals don't meet their targets after {sweeps} sweeps")
    return cells


def probabilities(rows: DataFrame, temper: float = TEMPER, sweeps: int = SWEEPS, targets: dict[str, DataFrame] | None = None, tolerance: float | None = None) -> DataFrame:
    """Cells (dimensions, n, w, probability) for rows with the dimensions and n_tokens. targets: (value, target) in tokens."""
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n")), "cells")
    total = cells.agg(F.sum("n")).first()[0] or 0
    targets = targets or {d: written(tempered(cells, d, total, temper), f"target-{d}") for d in DIMENSIONS}
    cells = rake(cells, targets, sweeps, tolerance)
    highest = cells.agg(F.max(F.col("w") / F.col("n"))).first()[0] or 1.0
    return cells.withColumn("probability", F.col("w") / F.col("n") / F.lit(highest))


def draw(doc_id: Column) -> Column:
    """A number from 0 to below 1 for each doc_id: the first 52 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), doc_id.cast("string"))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample(docs: DataFrame, temper: float = TEMPER, sweeps: int = SWEEPS, targets: dict[str, DataFrame] | None = None, topics: Column | None = None, tolerance: float | None = None) -> DataFrame:
    """One row for each document: its cell, calibrated probability and whether it is kept."""
    rows = measured(docs, topics)
    odds = probabilities(rows, temper, sweeps, targets, tolerance).select(*DIMENSIONS, "w", "probability")
    drawn = rows.join(odds, list(DIMENSIONS), "left")
    return drawn.select("doc_id", *DIMENSIONS, "n_tokens", "probability", (draw(F.col("doc_id")) < F.col("probability")).alias("kept"))


def sampled(docs: DataFrame, temper: float = TEMPER, sweeps: int = SWEEPS, targets: dict[str, DataFrame] | None = None, topics: Column | None = None, tolerance: float | None = None) -> DataFrame:
    """The documents that are kept, with all their columns. A doc_id's rows are kept or left together only if their cells agree."""
    free = "_"
    while any(c.lower().startswith(free) for c in docs.columns):  # a prefix that no column has
        free += "_"
    odds = probabilities(measured(docs, topics), temper, sweeps, targets, tolerance).select(*(F.col(d).alias(f"{free}{d}") for d in DIMENSIONS), F.col("probability").alias(f"{free}p"))
    text = F.coalesce("text", F.lit(""))
    own = topic(text, F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1))) if topics is None else F.coalesce(topics.cast("string"), F.lit(NONE))
    cell = {"source": F.coalesce("source", F.lit(NONE)), "lang": F.coalesce("lang", F.lit(NONE)), "topic": own}
    placed = docs.withColumns({f"{free}{d}": c for d, c in cell.items()})
    drawn = placed.join(odds, [f"{free}{d}" for d in DIMENSIONS])
    return drawn.where(draw(F.col("doc_id").cast("long")) < F.col(f"{free}p")).select(*docs.columns)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return sample(docs).select("doc_id", *DIMENSIONS, "n_tokens", F.round("probability", 6).alias("probability"), F.col("kept").cast("int").alias("kept"))


def sql(documents: str = "documents", temper: float = TEMPER, sweeps: int = SWEEPS) -> str:
    """The same rows in DuckDB, the sweeps written out one after another."""
    parts = [
        f"""measured as (select doc_id, coalesce(source, '{NONE}') as source, coalesce(lang, '{NONE}') as lang, coalesce(text, '') as text,
            greatest(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+')), 1)::bigint as n_tokens from {documents})""",
        f"""rows_ as materialized (select doc_id, source, lang, n_tokens, case when contains(text, ' | ') then 'table' when contains(text, '!! ') then 'shouting'
            when regexp_matches(text, '[%$&*#]{{3}} ') then 'symbols' when n_tokens < {BRIEF_TOKENS} then 'brief' when n_tokens < {LONG_TOKENS} then 'prose' else 'long' end as topic from measured)""",
        "cells as materialized (select source, lang, topic, sum(n_tokens)::bigint as n from rows_ group by all)",
        *(f"t_{d} as materialized (select {d}, t * (select sum(n) from cells) / sum(t) over () as target from (select {d}, pow(sum(n)::double, {temper}) as t from cells group by {d}))" for d in DIMENSIONS),
        "w0 as (select *, n::double as w from cells)",
    ]
    k = 0
    for _ in range(sweeps):
        for d in DIMENSIONS:
            parts.append(f"w{k + 1} as materialized (select c.source, c.lang, c.topic, c.n, c.w * t.target / sum(c.w) over (partition by c.{d}) as w from w{k} c join t_{d} t using ({d}))")
            k += 1
    parts.append(f"odds as (select *, w / n / (select max(w / n) from w{k}) as probability from w{k})")
    return "with " + ",\n".join(parts) + f"""
select doc_id, source, lang, topic, n_tokens, round(probability, 6) as probability,
    (('0x' || substr(md5('mix:' || doc_id::varchar), 1, 13))::bigint::double / {float(1 << 52)} < probability)::int as kept
from rows_ join odds using (source, lang, topic)"""
