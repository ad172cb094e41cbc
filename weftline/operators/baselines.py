"""Baseline forecasts from whole histories, post-model adjustments and bounds: array expressions after one grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.config import BOUNDS, CROSTON_ALPHA, Adjustments
from weftline.functions import let

MODELS = ("zero", "ma_3", "ma_12", "seasonal_naive", "seasonal_avg3y", "croston", "croston_sba")


def histories(panel: DataFrame, first: bool = False) -> DataFrame:
    """(entity, u): units of each month, oldest first; a panel is dense, so places are months. Bounded by the calendar. first: with the first month.

    A panel that has histories already (panel.series()) isn't grouped again; its segments come along, if it has them.
    """
    if "u" in panel.columns:
        return panel.select("entity", "u", *(["first"] if first else []), *(c for c in panel.columns if c == "segment"))
    ordered = F.array_sort(F.collect_list(F.struct("month", "units")))
    more = [F.min("month").alias("first")] if first else []
    return panel.groupBy("entity").agg(F.transform(ordered, lambda x: x["units"]).alias("u"), *more)


def croston(u: Column, alpha: float = CROSTON_ALPHA) -> Column:
    """Smoothed size over smoothed interval of the non-zero months; 0 for a series without any."""
    sold, start, step = _croston_steps(u, alpha)
    return F.aggregate(sold, start, step, lambda s: F.when(s["place"] >= 0, s["size"] / s["gap"]).otherwise(F.lit(0.0)))


def croston_path(u: Column, alpha: float = CROSTON_ALPHA) -> Column:
    """What croston() is from each month with sales on, [(place, value)], in one pass over the series."""
    sold, start, step = _croston_steps(u, alpha)
    path = F.array().cast("array<struct<place:int,value:double>>")
    both = F.aggregate(
        sold,
        F.struct(start.alias("now"), path.alias("path")),
        lambda s, x: let(step(s["now"], x), lambda now: F.struct(now.alias("now"), F.array_append(s["path"], F.struct(now["place"].alias("place"), (now["size"] / now["gap"]).alias("value"))).alias("path"))),
    )
    return both["path"]


def _croston_steps(u: Column, alpha: float) -> tuple[Column, Column, Callable[[Column, Column], Column]]:
    """The months with sales, the state before them, and how one of them changes it."""
    def state(size: Column, gap: Column, place: Column) -> Column:
        return F.named_struct(F.lit("size"), size, F.lit("gap"), gap, F.lit("place"), place)

    def step(s: Column, x: Column) -> Column:
        begun = s["place"] >= 0
        size = F.when(begun, alpha * x["units"] + (1 - alpha) * s["size"]).otherwise(x["units"])
        gap = F.when(begun, alpha * (x["place"] - s["place"]) + (1 - alpha) * s["gap"]).otherwise(F.lit(1.0))
        return state(size, gap, x["place"])

    sold = F.filter(F.transform(u, lambda x, i: F.struct(x.cast("double").alias("units"), i.alias("place"))), lambda x: x["units"] > 0)  # only these months change anything
    return sold, state(F.lit(0.0), F.lit(1.0), F.lit(-1)), step


def _sum_of_last(n: int) -> str:
    return f"aggregate(slice(u, -least({n}, size(u)), least({n}, size(u))), 0D, (a, x) -> a + x)"


def levels(rows: DataFrame) -> DataFrame:
    """Adds what holds for every step ahead of a known history `u`: the models without a season, and the measures that corrections need."""
    mean_3, mean_12 = (f"if(size(u) > 0, {_sum_of_last(n)} / least({n}, size(u)), 0D)" for n in (3, 12))
    size = croston(F.col("u"))
    return rows.withColumns(
        {
            "zero": F.lit(0.0),
            "ma_3": F.expr(f"greatest(0D, {mean_3})"),
            "ma_12": F.expr(f"greatest(0D, {mean_12})"),
            "croston": size,
            "croston_sba": size * (1 - CROSTON_ALPHA / 2),
            "trail_3": F.expr(mean_3),
            "sum_12": F.expr(_sum_of_last(12)),
            "last_sold": F.expr("coalesce(try_element_at(filter(u, x -> x > 0), -1), 0D)"),
        }
    )


def stepped(rows: DataFrame, steps: Column) -> DataFrame:
    """A row a step ahead of a known history `u`, with the seasonal models. They look at the same month of earlier years, never at steps before."""
    at = "size(u) + step - 1"
    years = [f"get(u, int({at} - {k}))" for k in (12, 24, 36)]  # null where there is no such month
    total, known = " + ".join(f"coalesce({y}, 0D)" for y in years), " + ".join(f"int({y} is not null)" for y in years)
    return rows.withColumn("step", F.explode(F.sequence(F.lit(1), steps))).withColumns(
        {
            "seasonal_naive": F.expr(f"coalesce(if({at} - 12 * ceil(step / 12D) >= 0, get(u, int({at} - 12 * ceil(step / 12D))), 0D), 0D)"),
            "seasonal_avg3y": F.expr(f"coalesce(try_divide({total}, {known}), 0D)"),
        }
    )


def forecast(panel: DataFrame, end: date, steps: int) -> DataFrame:
    """(entity, month, step, one column a model, trail_3, sum_12, last_sold) for the `steps` months after `end`; with the segment, if the panel has it."""
    out = stepped(levels(histories(panel)), F.lit(steps))
    return out.select("entity", *(c for c in out.columns if c == "segment"), F.expr(f"add_months(date'{end}', step)").alias("month"), "step", *MODELS, "trail_3", "sum_12", "last_sold")


def blended(ml: Column, seasonal: Column, cfg: Adjustments = Adjustments()) -> Column:
    """Mixed with the seasonal value where the two are far apart."""
    apart = F.abs(ml - seasonal) / F.greatest(F.lit(1.0), seasonal)
    return F.when(apart > cfg.blend_threshold, F.greatest(F.lit(0.0), cfg.blend_weight * ml + (1 - cfg.blend_weight) * seasonal)).otherwise(ml)


def capped(value: Column, sum_12: Column, last_sold: Column, cfg: Adjustments = Adjustments()) -> Column:
    """No more than a multiple of the mean month of the last year, or three times what sold last, or 1, whichever is most."""
    return F.least(value, F.greatest(cfg.cap_multiple * sum_12 / 12, 3 * last_sold, F.lit(1.0)))


def shrunk(value: Column, trail_3: Column, cfg: Adjustments = Adjustments()) -> Column:
    """Drawn towards the mean of the last three months where it is far above; a series that sold nothing then is left alone."""
    far = (trail_3 > 0) & (value > cfg.shrink_threshold * trail_3)
    return F.when(far, cfg.shrink_weight * value + (1 - cfg.shrink_weight) * trail_3).otherwise(value)


TRAIL = "array<struct<rule:string,before:double,after:double>>"


def adjusted(rows: DataFrame, cfg: Adjustments = Adjustments()) -> DataFrame:
    """Units after the corrections, in order, with a `trail` of those that changed them.

    A learnt forecast is mixed with the three-year seasonal mean; INTERMITTENT series are capped; all but DEAD ones are shrunk. rows: segment,
    learnt, units, seasonal_avg3y, sum_12, last_sold, trail_3, and a trail of what happened before, if there is one.
    """
    before = F.col("trail") if "trail" in rows.columns else F.array().cast(TRAIL)

    def blend(v: Column) -> Column:
        return F.when(F.col("learnt"), blended(v, F.col("seasonal_avg3y"), cfg)).otherwise(v)

    def cap(v: Column) -> Column:
        return F.when(F.col("segment") == "INTERMITTENT", capped(v, F.col("sum_12"), F.col("last_sold"), cfg)).otherwise(v)

    def shrink(v: Column) -> Column:
        return F.when(F.col("segment") != "DEAD", shrunk(v, F.col("trail_3"), cfg)).otherwise(v)

    path = let(F.col("units"), lambda u: let(blend(u), lambda b: let(cap(b), lambda c: F.array(u, b, c, shrink(c)))))
    entries = [F.struct(F.lit(rule).alias("rule"), F.get("_path", F.lit(k)).alias("before"), F.get("_path", F.lit(k + 1)).alias("after")) for k, rule in enumerate(("blend", "cap", "shrink"))]
    changes = F.filter(F.array(*entries), lambda e: e["before"] != e["after"]).cast(TRAIL)
    return rows.withColumn("_path", path).withColumns({"trail": F.concat(before, changes), "units": F.get("_path", F.lit(3))}).drop("_path")


def trail_of(adjusted_rows: DataFrame) -> DataFrame:
    """(entity, step, place, rule, before, after): every correction that changed a forecast, in order."""
    each = adjusted_rows.select("entity", "step", F.posexplode("trail").alias("place", "t"))
    return each.select("entity", "step", (F.col("place") + 1).alias("place"), "t.rule", "t.before", "t.after")


def chosen(forecasts: DataFrame, segments: DataFrame, best: DataFrame, learnt: Iterable[str] = ()) -> DataFrame:
    """Forecast rows with their segment and the model that was chosen for it; without one, or without that model at hand, the seasonal naive. best: segment, best_model."""
    joined = forecasts if "segment" in forecasts.columns else forecasts.join(segments.select("entity", "segment"), "entity", "left")
    joined = joined.join(F.broadcast(best.select("segment", "best_model")), "segment", "left")  # a row a segment
    known = F.col("best_model").isin(*MODELS, *learnt)
    return joined.withColumn("model", F.when(known, F.col("best_model")).otherwise("seasonal_naive")).drop("best_model")


def by_formula(rows: DataFrame) -> DataFrame:
    """Units of rows whose model is one of MODELS."""
    return rows.withColumn("units", F.greatest(F.coalesce(*(F.when(F.col("model") == m, F.col(m)) for m in MODELS)), F.lit(0.0)))


def bounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"lower": F.col("units") * (1 - BOUNDS), "upper": F.col("units") * (1 + BOUNDS)})


def dispatched(forecasts: DataFrame, segments: DataFrame, best: DataFrame, cfg: Adjustments | None = None) -> DataFrame:
    """Each entity's forecast by the model chosen for its segment, with bounds; with settings, corrected and with its trail."""
    out = by_formula(chosen(forecasts, segments, best))
    if cfg is not None:
        out = adjusted(out.withColumn("learnt", F.lit(False)), cfg)
    return bounded(out)
