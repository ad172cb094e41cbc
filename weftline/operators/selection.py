"""Walk-forward validation with folds as data, error metrics, model choice and scenario bounds."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import CROSTON_ALPHA, FOLDS, LEARNT, ROSTER, Folds
from weftline.functions import mae, mape, months_ago, rmse, wmape
from weftline.operators.baselines import croston_path, histories, levels, stepped

CV_MODELS = ("ma_3", "ma_12", "seasonal_naive", "seasonal_avg3y", "croston_sba", "zero")
#: Months of history that a model needs for a forecast of its own.
HISTORY = {"ma_3": 3, "ma_12": 12, "seasonal_naive": 12, "seasonal_avg3y": 12}


def origins(end: date, folds: Folds) -> list[date]:
    """Months that forecasts start from, the oldest first; the last one leaves `horizon` months to score."""
    last = end.year * 12 + end.month - 1 - folds.horizon
    found = [last - k * folds.step for k in range(folds.count)]
    return [date(m // 12, m % 12 + 1, 1) for m in sorted(found)]


def walk_forward(panel: DataFrame, end: date, folds: Folds | tuple[Folds, ...], roster: dict[tuple[str, int], tuple[str, ...]] | None = None) -> DataFrame:
    """(entity, horizon, fold, origin, month, step, actual, one column a model); with the segment, if the panel has it.

    One grouping of the panel to a history a series serves all origins of all horizons: they are literal rows, and each cuts the
    histories at its place. The calendar bounds a history, and only months of origins are ever computed. With a roster, models that a row's
    segment and horizon don't try are null and aren't computed; that needs the segment.
    """
    folds = (folds,) if isinstance(folds, Folds) else folds
    starts = [
        F.struct(F.lit(f.horizon).alias("horizon"), F.lit(k).alias("fold"), F.lit(o).alias("origin"), F.lit(f.least).alias("least"))
        for f in folds
        for k, o in enumerate(origins(end, f), 1)
    ]
    known = histories(panel, first=True)
    kind = ["segment"] if "segment" in known.columns else []
    path = croston_path(F.col("u"))  # a series' once, not once an origin
    if roster is not None:
        path = F.when(F.col("segment").isin(*{segment for (segment, _), models in roster.items() if "croston_sba" in models}), path)
    rows = known.withColumn("path", path).select("entity", *kind, "first", "path", F.col("u").alias("whole"), F.explode(F.array(*starts)).alias("o"))
    rows = rows.withColumn("age", -months_ago("o.origin", F.col("first")) + 1).where("age >= o.least and age < size(whole)")
    known = rows.select("entity", *kind, "o.horizon", "o.fold", "o.origin", "age", "path", "whole", F.expr("slice(whole, 1, age)").alias("u"))
    size = F.expr("coalesce(try_element_at(filter(path, x -> x.place < age), -1).value, 0D)")
    known = levels(known).withColumns({"croston": size, "croston_sba": size * (1 - CROSTON_ALPHA / 2)})
    if roster is not None:
        known = known.withColumns({m: F.when(in_roster(roster, m), F.col(m)) for m in CV_MODELS if m in known.columns})
    each = stepped(known, F.col("horizon")).withColumn("actual", F.expr("get(whole, age - 1 + step)")).where("actual is not null")
    return each.select("entity", *kind, "horizon", "fold", "origin", F.expr("add_months(origin, step)").alias("month"), "step", "actual", *CV_MODELS)


def long_form(scored: DataFrame, models: tuple[str, ...] = CV_MODELS) -> DataFrame:
    """One row a model."""
    return scored.unpivot([c for c in scored.columns if c not in CV_MODELS], list(models), "model", "predicted")


def in_roster(roster: dict[tuple[str, int], tuple[str, ...]] = ROSTER, model: str | None = None) -> Column:
    """Whether a row's model (the column's, unless one is named) is one of those that its segment and horizon try."""
    cases = [(F.col("segment") == segment) & (F.col("horizon") == horizon) & (F.col("model").isin(*models) if model is None else F.lit(model in models)) for (segment, horizon), models in roster.items()]
    return reduce(Column.__or__, cases, F.lit(False))


def tried(rows: DataFrame, segments: DataFrame, roster: dict[tuple[str, int], tuple[str, ...]] | None = ROSTER, more: DataFrame | None = None) -> DataFrame:
    """Rows of walk_forward() in long form with their segment, of the roster's models (of all without a roster).

    Rows that have their segment already aren't joined, and rows of models that nobody tries are never made.

    more: rows (entity, fold, origin, month, step, actual, horizon, model, predicted) of learnt models, taken where LEARNT asks for them.
    """
    kinds = segments.select("entity", "segment")
    models = CV_MODELS if roster is None else tuple(m for m in CV_MODELS if any(m in names for names in roster.values()))
    joined = long_form(rows if "segment" in rows.columns else rows.join(kinds, "entity"), models)
    if roster is not None:
        joined = joined.where(in_roster(roster))
    if more is not None:
        learnt = more.join(kinds, "entity")
        joined = joined.unionByName(learnt if roster is None else learnt.where(in_roster(LEARNT)))
    return joined


def cv_metrics(panel: DataFrame, segments: DataFrame, end: date, folds: tuple[Folds, ...] = FOLDS, roster: dict[tuple[str, int], tuple[str, ...]] | None = ROSTER, more: DataFrame | None = None) -> DataFrame:
    """Errors of tried() models by model, horizon, segment and fold. Every series that an origin scores is scored one step ahead, once."""
    a, p = F.col("actual"), F.col("predicted")
    rows = tried(walk_forward(panel, end, folds, roster if "segment" in panel.columns else None), segments, roster, more)
    return rows.groupBy("model", "horizon", "segment", "fold", "origin").agg(rmse(a, p).alias("rmse"), mae(a, p).alias("mae"), mape(a, p).alias("mape"), wmape(a, p).alias("wmape"), F.count_if(F.col("step") == 1).alias("n_entities"), F.count("*").alias("n_rows"))


def best_models(metrics: DataFrame) -> DataFrame:
    """The model with the smallest mean WMAPE over folds for each segment and horizon."""
    means = metrics.groupBy("segment", "horizon", "model").agg(*(F.avg(m).alias(f"mean_{m}") for m in ("wmape", "rmse", "mae", "mape")))
    w = Window.partitionBy("segment", "horizon").orderBy(F.round("mean_wmape", 6).asc_nulls_last(), "model")
    return means.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place").withColumnRenamed("model", "best_model")


def expected_error(metrics: DataFrame, best: DataFrame) -> DataFrame:
    """(segment, horizon, error share): what the chosen model missed in validation; 0 for DEAD."""
    chosen = metrics.join(best.select("segment", "horizon", F.col("best_model").alias("model")), ["segment", "horizon", "model"])
    means = chosen.groupBy("segment", "horizon").agg(F.avg("wmape").alias("w"))
    return means.select("segment", "horizon", F.when(F.col("segment") == "DEAD", 0.0).otherwise(F.col("w") / 100).alias("expected_error"))


def scenarios(forecasts: DataFrame, errors: DataFrame) -> DataFrame:
    """Conservative, middle and aggressive units; forecasts: entity, segment, month, horizon, units."""
    joined = forecasts.join(F.broadcast(errors), ["segment", "horizon"], "left")  # a row a segment and horizon
    e = F.coalesce("expected_error", F.lit(0.0))
    return joined.withColumns({"conservative": F.greatest(F.lit(0.0), F.col("units") * (1 - e)), "middle": F.col("units"), "aggressive": F.col("units") * (1 + e)})


def simulation_error(scored: DataFrame, cv: DataFrame, least: int = 5) -> DataFrame:
    """Expected error from simulated forecasts with at least `least` scored rows, else from validation, else 0."""
    a, p = F.col("actual"), F.col("predicted")
    own = scored.groupBy("segment", "horizon").agg(F.when(F.count("*") >= least, wmape(a, p) / 100).alias("own"))
    joined = own.join(cv, ["segment", "horizon"], "full")
    return joined.select("segment", "horizon", F.when(F.col("segment") == "DEAD", 0.0).otherwise(F.coalesce("own", "expected_error", F.lit(0.0))).alias("expected_error"))


def simulation_summary(scored: DataFrame, by: str) -> DataFrame:
    """Errors of simulated whole-unit forecasts by month, segment or model."""
    a, p = F.col("actual"), F.col("predicted")
    return scored.groupBy(by, "horizon").agg(F.count_distinct("entity").alias("n_entities"), F.count(a).alias("n_scored"), F.sum(p).alias("predicted"), F.sum(a).alias("actual"), wmape(a, p).alias("wmape"), mae(a, p).alias("mae"))


def simulation_rows(simulated: DataFrame) -> DataFrame:
    """Simulated forecasts with has_actual, middle, error (actual less predicted), abs_error, and abs_pct_error (of actuals above 0); errors are null without an actual."""
    error = F.col("actual") - F.col("predicted")
    out = simulated.withColumns({"has_actual": F.col("actual").isNotNull(), "middle": F.col("predicted"), "error": error, "abs_error": F.abs(error)})
    return out.withColumn("abs_pct_error", F.when(F.col("actual") > 0, F.col("abs_error") / F.col("actual") * 100.0))


def holdout_scores(forecasts: DataFrame, actuals: DataFrame, segments: DataFrame, needs: dict[str, int] = HISTORY) -> DataFrame:
    """Every model against the holdout: errors, n_candidate, n_dropped and n_obs by segment, step and model; what can't be scored gives no row.

    A candidate is an actual (entity, month, actual) of a series that has a segment; a model drops those of series with fewer months than
    it needs, so that what it only fills in isn't scored as its own.
    """
    rows = actuals.join(forecasts, ["entity", "month"]).join(segments.select("entity", "segment", "total_months"), "entity")
    rows = rows.select("segment", F.col("step").alias("horizon"), "total_months", "actual", *CV_MODELS)
    long = rows.unpivot(["segment", "horizon", "total_months", "actual"], list(CV_MODELS), "model", "predicted")
    least = F.coalesce(*(F.when(F.col("model") == m, n) for m, n in needs.items()), F.lit(0))
    kept = F.col("total_months") >= least
    a, p = F.when(kept, F.col("actual")), F.when(kept, F.col("predicted"))
    out = long.groupBy("segment", "horizon", "model").agg(
        F.count("*").alias("n_candidate"), F.count_if(~kept).alias("n_dropped"), F.count(a).alias("n_obs"), rmse(a, p).alias("rmse"), mae(a, p).alias("mae"), mape(a, p).alias("mape"), wmape(a, p).alias("wmape")
    )
    return out.where("n_obs > 0")
