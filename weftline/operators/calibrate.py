"""Bias calibration: evidence tables at three grains, a no-regression gate, and applying factors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.config import GLOBAL, Calibration, Folds
from weftline.functions import clipped, ratio, settled
from weftline.operators.selection import tried, walk_forward

#: Eight origins, a quarter apart.
BACKTEST_FOLDS = (Folds(1, 8, 3, 24), Folds(3, 8, 3, 24))


def with_errors(rows: DataFrame) -> DataFrame:
    error = F.col("predicted") - F.col("actual")
    return rows.withColumns({"error": error, "abs_error": F.abs(error), "bias_ratio": ratio(F.col("predicted"), F.col("actual"))})


def backtest(panel: DataFrame, end: date, model: str = "seasonal_naive") -> DataFrame:
    """Forecasts of one model from all origins at once: entity, origin, month, horizon, predicted, actual and their error."""
    return with_errors(validated(panel, end, BACKTEST_FOLDS, model))


def backtest_roster(panel: DataFrame, segments: DataFrame, end: date, more: DataFrame | None = None) -> DataFrame:
    """The same for every model that a series' segment tries, from one reading of the histories: entity, segment, model and the columns of backtest().

    more: rows of learnt models (operators.ml.walk_forward over BACKTEST_FOLDS), scored where LEARNT asks for them.
    """
    return with_errors(tried(walk_forward(panel, end, BACKTEST_FOLDS), segments, more=more).select("entity", "segment", "model", "origin", "month", "horizon", "predicted", "actual"))


def tier(n: Column, total: Column, cfg: Calibration) -> Column:
    return F.when((n >= cfg.strong[0]) & (total >= cfg.strong[1]), "STRONG").when((n >= cfg.moderate[0]) & (total >= cfg.moderate[1]), "MODERATE").when(n >= cfg.weak, "WEAK").otherwise("NONE")


def factors(evidence: DataFrame, keys: list[str], cfg: Calibration, positive: str = "actual") -> DataFrame:
    """Clipped ratios of actual to predicted sums, for keys with enough evidence; 1 for the rest."""
    known = evidence.where(F.col(positive) > 0)
    sums = known.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("actual").alias("total_actual"), F.sum("predicted").alias("total_predicted"))
    raw = ratio(F.col("total_actual"), F.col("total_predicted"))
    rows = sums.withColumn("raw_factor", raw).withColumn("evidence", tier(F.col("n"), F.col("total_actual"), cfg))
    usable = F.col("evidence").isin("STRONG", "MODERATE") & F.col("raw_factor").isNotNull()
    return rows.withColumn("factor", F.when(usable, clipped(F.col("raw_factor"), cfg.low, cfg.high)).otherwise(1.0))


def history_factors(sparse: DataFrame, end: date, horizon: int, months: int = 24) -> DataFrame:
    """Fallback from the sparse series: pairs of a month and the month `horizon` before; never more than weak evidence, so the factor stays 1."""
    recent = sparse.where((F.col("month") <= F.lit(end)) & (F.col("month") > F.add_months(F.lit(end), -months)))
    earlier = recent.select("entity", F.add_months("month", horizon).alias("month"), F.col("units").alias("predicted"))
    pairs = recent.select("entity", "month", F.col("units").alias("actual")).join(earlier, ["entity", "month"]).where("predicted > 0")
    sums = pairs.groupBy("entity").agg(F.count("*").alias("n"), F.sum("actual").alias("total_actual"), F.sum("predicted").alias("total_predicted"))
    return sums.select("entity", F.lit(horizon).alias("horizon"), "n", "total_actual", "total_predicted", ratio(F.col("total_actual"), F.col("total_predicted")).alias("raw_factor"), F.when(F.col("n") > 0, "WEAK").otherwise("NONE").alias("evidence"), F.lit(1.0).alias("factor"))


def first_of(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the first table, and those of the second whose keys it lacks."""
    return primary.unionByName(fallback.join(primary.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def validated(panel: DataFrame, end: date, folds: tuple[Folds, ...], model: str = "seasonal_naive") -> DataFrame:
    """What one model said and what came in the folds of validation: entity, origin, month, horizon, predicted, actual."""
    return walk_forward(panel, end, folds).select("entity", "origin", "month", "horizon", F.col(model).alias("predicted"), "actual")


def global_evidence(backtested: DataFrame, diagnosed: DataFrame, before: date) -> DataFrame:
    """(horizon, month, predicted, actual, source): the backtest's rows before a date; for a horizon without any, those of the holdout's diagnosis."""
    columns = ["horizon", "month", "predicted", "actual"]
    early = backtested.where(F.col("month") < F.lit(before)).select(*columns, F.lit("backtest").alias("source"))
    other = diagnosed.select(*columns, F.lit("diagnosis").alias("source"))
    return first_of(early, other, ["horizon"])


def _gate_error(rows: DataFrame, predicted: Column) -> DataFrame:
    """WMAPE by horizon over entities summed over all gate months."""
    sums = rows.groupBy("horizon", "entity").agg(F.sum("actual").alias("a"), F.sum(predicted).alias("p"))
    return sums.groupBy("horizon").agg(ratio(F.sum(F.abs(F.col("a") - F.col("p"))) * 100, F.sum("a")).alias("wmape"))


def global_gate(evidence: DataFrame, gate: DataFrame, cfg: Calibration = GLOBAL, accept_blind: bool = False) -> DataFrame:
    """One factor a horizon, taken only if it doesn't worsen the gate set's WMAPE by more than cfg.gate points.

    gate: entity, horizon, month, predicted, actual, of every horizon at hand. Without gate rows a factor is refused unless accept_blind.
    """
    table = factors(evidence, ["horizon", *(["source"] if "source" in evidence.columns else [])], cfg)  # a horizon has one source
    raw = _gate_error(gate, F.col("predicted")).withColumnRenamed("wmape", "raw_wmape")
    projected = _gate_error(gate.join(F.broadcast(table.select("horizon", "factor")), "horizon"), F.col("predicted") * F.col("factor")).withColumnRenamed("wmape", "calibrated_wmape")
    rows = table.join(raw, "horizon", "left").join(projected, "horizon", "left")
    delta = F.col("calibrated_wmape") - F.col("raw_wmape")
    accepted = F.when(delta.isNull(), F.lit(accept_blind)).otherwise(delta <= cfg.gate)
    rows = rows.withColumn("delta", delta).withColumn("accepted", accepted.cast("int"))
    reason = F.when(F.col("delta").isNull(), "no evidence").when(F.col("accepted") == 1, "within tolerance").otherwise("worse than tolerance")
    return rows.withColumn("applied_factor", F.when(F.col("accepted") == 1, F.col("factor")).otherwise(1.0)).withColumn("reason", reason)


def apply_factors(forecasts: DataFrame, table: DataFrame, keys: list[str], suffix: str, factor: str = "factor") -> DataFrame:
    """Units and bounds times the factor of their key; keys without one stay as they are. Tables have a row a key."""
    joined = forecasts.join(table.select(*keys, F.col(factor).alias("_factor")), keys, "left")
    f = F.coalesce("_factor", F.lit(1.0))
    out = joined.withColumns({c: settled(F.greatest(F.col(c) * f, F.lit(0.0))) for c in ("units", "lower", "upper")} | {"calibration_factor": f})
    if "model_version" in forecasts.columns:
        out = out.withColumn("model_version", F.concat("model_version", F.lit(suffix)))
    return out.drop("_factor")


def bias_analysis(rows: DataFrame, table: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Raw and calibrated bias and WMAPE. rows: predicted, actual, and the keys."""
    joined = rows.join(table.select(*keys, "factor"), keys, "left")
    a, p = F.col("actual"), F.col("predicted")
    c = p * F.coalesce("factor", F.lit(1.0))

    def of(x: Column) -> Column:
        return ratio(F.sum(F.abs(a - x)) * 100, F.sum(a))

    return joined.groupBy(*by).agg(F.sum(a).alias("actual"), F.sum(p).alias("raw"), F.sum(c).alias("calibrated"), ratio(F.sum(p), F.sum(a)).alias("raw_bias"), ratio(F.sum(c), F.sum(a)).alias("calibrated_bias"), of(p).alias("raw_wmape"), of(c).alias("calibrated_wmape"))


def validate(table: DataFrame, keys: list[str], cfg: Calibration, evidence_end: date, holdout_start: date) -> DataFrame:
    """(check, passed, detail): factors in range, keys unique, and no evidence from the holdout (from its real last month)."""
    out_of_range = table.agg(F.count_if(~F.col("factor").between(cfg.low, cfg.high)).alias("x"))
    doubled = table.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("x"))
    late = table.sparkSession.createDataFrame([(int(evidence_end >= holdout_start),)], "x long")
    parts = [d.select(F.lit(name).alias("check"), (F.col("x") == 0).cast("int").alias("passed"), F.col("x").cast("long").alias("n_failed")) for name, d in (("factor_range", out_of_range), ("unique_keys", doubled), ("no_leakage", late))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
