"""Scoring against actuals, error decomposition, risk flags, validation, and the diagnostics of a scored forecast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import accuracy_tier, direction, ratio
from weftline.operators.ranking import placed
from weftline.sources.files import normalised


def scored(forecasts: DataFrame, actuals: DataFrame, more: Iterable[str] = ()) -> DataFrame:
    """Forecast rows with an actual (sku and month sold), with errors. forecasts: sku, month, step, units; actuals: sku, month, units, and `more` columns to keep."""
    variant = ["variant"] if "variant" in forecasts.columns else []
    joined = forecasts.select(*variant, "sku", "month", "step", F.col("units").alias("predicted")).join(actuals.select("sku", "month", F.col("units").alias("actual"), *more), ["sku", "month"])
    return joined.withColumn("abs_error", F.abs(F.col("actual") - F.col("predicted")))


def _floor1(by: DataFrame) -> DataFrame:
    return by.agg(F.count("*").alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), (F.sum("abs_error") * 100 / F.greatest(F.lit(1.0), F.sum("actual"))).alias("wmape"))


def holdout_table(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _floor1(rows.groupBy(*(by or []), "step", "month"))


def grid_table(allocated: DataFrame, parents: DataFrame, actuals: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """A row a variant: mean WMAPE over months of one and of all steps, bias, whether its sums meet the parents', and its place by WMAPE.

    allocated: variant, parent, child, month, step, units; parents: child (the variants' parent), month, step, units. One grouping by
    parent makes the checks, one by month the errors; the few variants are then put in order.
    """
    totals = allocated.groupBy("variant", "parent", "month", "step").agg(F.sum("units").alias("total"), F.min("units").alias("least"))
    held = totals.join(parents.select(F.col("child").alias("parent"), "month", "step", F.col("units").alias("parent_units")), ["parent", "month", "step"])
    checks = held.groupBy("variant").agg(((F.max(F.abs(F.col("parent_units") - F.col("total"))) < tolerance) & (F.min("least") >= 0)).cast("int").alias("validated"))
    months = holdout_table(scored(allocated.withColumnRenamed("child", "sku"), actuals), ["variant"])
    errors = months.groupBy("variant").agg(F.avg(F.when(F.col("step") == 1, F.col("wmape"))).alias("h1_wmape"), F.avg("wmape").alias("h3_wmape"), ratio(F.sum("predicted"), F.sum("actual")).alias("bias_ratio"), F.sum("n").alias("n"))
    place = F.row_number().over(Window.orderBy(F.round("h3_wmape", 6), "variant"))  # as many rows as variants
    return errors.join(checks, "variant").select("variant", F.col("variant").startswith("baseline").cast("int").alias("is_baseline"), "n", "h1_wmape", "h3_wmape", "bias_ratio", "validated", place.alias("place"))


def holdout_by_segment(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """By month and segment, and ALL."""
    joined = rows.join(segments.select(F.col("entity").alias("sku"), "segment"), "sku", "left").withColumn("segment", F.coalesce("segment", F.lit("UNKNOWN")))
    sets = joined.groupingSets([["step", "month", "segment"], ["step", "month"]], "step", "month", "segment").agg(
        F.count("*").alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), (F.sum("abs_error") * 100 / F.greatest(F.lit(1.0), F.sum("actual"))).alias("wmape")
    )
    return sets.withColumn("segment", F.coalesce("segment", F.lit("ALL")))


def decomposition(rows: DataFrame, products: DataFrame) -> DataFrame:
    """WMAPE at sku, color and style: how much of the error allocation makes."""
    joined = rows.join(products.select("sku", "color", "style"), "sku", "left")
    levels = F.array(*(F.struct(F.lit(level).alias("level"), F.col(level).alias("key")) for level in ("sku", "color", "style")))
    each = joined.select("step", "month", "actual", "predicted", F.explode(levels).alias("l")).where("l.key is not null")
    sums = each.groupBy("l.level", "l.key", "step", "month").agg(F.sum("actual").alias("a"), F.sum("predicted").alias("p"))
    error = F.when(F.sum("a") > 0, F.sum(F.abs(F.col("a") - F.col("p"))) * 100 / F.sum("a"))
    return sums.groupBy("level", "step", "month").agg(F.sum("a").alias("actual"), F.sum("p").alias("predicted"), error.alias("wmape"))


def risk_flags(forecasts: DataFrame, gold: DataFrame, calibration: DataFrame, before: object, sparse: int = 6, zero_rate: float = 0.50, jump: float = 3.0, low_units: float = 5.0, high_bias: float = 1.30) -> DataFrame:
    """(sku, month, step, flag, severity, reason): one join with history and evidence, then an array of conditions exploded.

    forecasts: sku, style, month, step, units; calibration: entity (the style), horizon, evidence, bias. History ends before `before`; its
    last three months are counted from its own last one. A sku without history has no months, a zero rate of 1 and a recent mean of 0.
    """
    known = gold.where(F.col("month") < F.lit(before))
    last = known.agg(F.add_months(F.max("month"), -2)).scalar()
    recent = F.col("month") >= last
    history = known.groupBy("sku").agg(F.count_if(F.col("units") > 0).alias("sold"), (1 - F.count_if(F.col("units") > 0) / F.count("*")).alias("zeros"), F.avg(F.when(recent, F.col("units"))).alias("mean_3"))
    rows = forecasts.join(history, "sku", "left").join(calibration.select(F.col("entity").alias("style"), F.col("horizon").alias("step"), "evidence", "bias"), ["style", "step"], "left")
    rows = rows.withColumns({"sold": F.coalesce("sold", F.lit(0)), "zeros": F.coalesce("zeros", F.lit(1.0)), "mean_3": F.coalesce("mean_3", F.lit(0.0)), "evidence": F.coalesce("evidence", F.lit("NONE"))})
    sold, zeros, mean, units, bias = (F.col(c) for c in ("sold", "zeros", "mean_3", "units", "bias"))

    def text(*parts: str | Column) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))

    conditions: list[tuple[str, str, Column, Column]] = [
        ("sparse_history", "MEDIUM", sold < sparse, text("only ", sold, " months with sales")),
        ("intermittent_demand", "LOW", zeros > zero_rate, text("zero rate ", F.round(zeros, 2))),
        ("large_forecast_jump", "HIGH", (mean > 0) & (units > jump * mean), text("units ", F.round(units, 1), f" above {jump:g} times the recent mean ", F.round(mean, 1))),
        ("low_recent_demand", "LOW", mean <= low_units, text("recent mean ", F.round(mean, 1))),
        ("calibration_weak_or_missing", "LOW", F.col("evidence").isin("WEAK", "NONE"), text("evidence ", F.col("evidence"))),
        ("parent_forecast_high_error", "MEDIUM", bias > high_bias, text("style forecast at ", F.round(bias, 2), " of the actuals")),
    ]
    flags = F.array(*(F.when(c, F.struct(F.lit(name).alias("flag"), F.lit(severity).alias("severity"), reason.alias("reason"))) for name, severity, c, reason in conditions))
    return rows.select("sku", "month", "step", F.explode(F.filter(flags, lambda f: f.isNotNull())).alias("f")).select("sku", "month", "step", "f.*")


def validation_report(parents: DataFrame, colors: DataFrame, skus: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(check, passed, n_failed) of a production forecast, from two aggregations: totals by level, and all conditions on rows at once.

    parents: parent, month, step, units; colors and skus: parent, child, month, step, units, lower, upper.
    """
    key = ["month", "step"]

    def meets(up: DataFrame, name: str, down: DataFrame) -> DataFrame:
        sums = down.groupBy("parent", *key).agg(F.sum("units").alias("below"))
        joined = up.select(F.col(name).alias("parent"), *key, "units").join(sums, ["parent", *key], "left")
        return joined.agg(F.count_if(F.abs(F.col("units") - F.coalesce("below", F.lit(0.0))) >= tolerance).alias("x"))

    twice = skus.groupBy("child", *key).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("units") < 0).alias("no_negative_units"),
        F.count_if(F.col("units").isNull()).alias("no_null_units"),
        F.count_if((F.col("lower") > F.col("units")) | (F.col("units") > F.col("upper"))).alias("bounds_ordered"),
    )
    rows = twice.agg(*(F.sum(c).alias(c) for c in ("no_negative_units", "no_null_units", "bounds_ordered")), F.count_if(F.col("n") > 1).alias("unique_keys"))
    one = rows.crossJoin(meets(parents, "parent", colors).withColumnRenamed("x", "colors_meet_styles")).crossJoin(meets(colors, "child", skus).withColumnRenamed("x", "skus_meet_colors"))  # one row each
    checks = one.select(*(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in one.columns)).unpivot([], one.columns, "check", "n_failed")
    return checks.select("check", (F.col("n_failed") == 0).cast("int").alias("passed"), "n_failed")


def lowest_step(rows: DataFrame) -> DataFrame:
    """Of each sku and month the row of the lowest step."""
    w = Window.partitionBy("sku", "month").orderBy("step")
    return rows.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def same_population(rows: DataFrame) -> DataFrame:
    """Errors of variants by step and month on the skus that all of them scored."""
    n = rows.select("variant").distinct().agg(F.count("*")).scalar()
    both = rows.groupBy("sku", "month", "step").agg(F.count_distinct("variant").alias("n_variants")).where(F.col("n_variants") == n)
    return holdout_table(rows.join(both, ["sku", "month", "step"], "left_semi"), ["variant"])


def against(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two forecasts' errors by step and month on the skus that both of them scored, with the difference and the better one. a, b: scored() rows."""
    keys = ["sku", "month", "step"]
    both = a.select(*keys, "actual", F.col("abs_error").alias("error_a")).join(b.select(*keys, F.col("abs_error").alias("error_b")), keys)
    total = F.greatest(F.lit(1.0), F.sum("actual"))
    sums = both.groupBy("step", "month").agg(F.count("*").alias("n"), F.count_distinct("sku").alias("n_skus"), (F.sum("error_a") * 100 / total).alias("wmape_a"), (F.sum("error_b") * 100 / total).alias("wmape_b"))
    delta = F.round(F.col("wmape_a") - F.col("wmape_b"), 4)
    return sums.withColumns({"delta": delta, "better": F.when(delta < 0, "a").when(delta > 0, "b").otherwise("tie")})


def version_table(rows: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Versions side by side: WMAPE by version, level, step and month, and the difference to the first version.

    rows: version and scored() columns, of skus that aren't null; with color and style, or else products. Rows of a sku and month lie together, so
    errors of skus are summed where they are, and only sums by color and style are shuffled.
    """
    joined = rows if products is None else rows.join(products.select("sku", "color", "style"), "sku", "left")
    cell = ["version", "step", "month"]
    skus = joined.groupBy(*cell, "sku", "color", "style").agg(F.sum("actual").alias("a"), F.sum("predicted").alias("p"))
    error = F.sum(F.abs(F.col("a") - F.col("p")))
    parents = skus.groupBy(*cell, "color", "style").agg(F.sum("a").alias("a"), F.sum("p").alias("p"), error.alias("sku_error"))
    keys = {"sku": F.lit("all"), "color": F.col("color"), "style": F.col("style")}
    levels = F.array(*(F.struct(F.lit(level).alias("level"), key.alias("key"), (F.col("sku_error") if level == "sku" else F.lit(None).cast("double")).alias("known")) for level, key in keys.items()))
    each = parents.select(*cell, "a", "p", F.explode(levels).alias("l")).where("l.key is not null")
    sums = each.groupBy(*cell, "l.level", "l.key").agg(F.sum("a").alias("a"), F.sum("p").alias("p"), F.sum("l.known").alias("known"))
    error = F.sum(F.coalesce("known", F.abs(F.col("a") - F.col("p"))))
    table = sums.groupBy("version", "level", "step", "month").agg(F.sum("a").alias("actual"), F.sum("p").alias("predicted"), F.when(F.sum("a") > 0, error * 100 / F.sum("a")).alias("wmape"))
    first = F.first("wmape").over(Window.partitionBy("level", "step", "month").orderBy("version"))  # as many rows as versions
    return table.withColumn("delta", F.col("wmape") - first)


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged(predictions: DataFrame, actuals: DataFrame | None = None, products: DataFrame | None = None, months: Iterable | None = None, step: int | None = None) -> DataFrame:
    """Scored rows for the diagnostics, from predictions in whatever columns they have: of the months and the step asked for.

    Actuals are joined where the predictions have none, style and color where they lack them or have only nulls; tables are read only if they are needed.
    """
    out = normalised(predictions).withColumnsRenamed({"units": "predicted", "predicted_units": "predicted", "actual_units": "actual", "horizon": "step"})
    if step is not None:
        out = out.where(F.col("step") == step)
    if months is not None:
        out = out.where(F.col("month").isin(*months))
    if "actual" not in out.columns and actuals is not None:
        known = normalised(actuals).withColumnsRenamed({"units": "actual", "actual_units": "actual"})
        out = out.join(known.groupBy("sku", "month").agg(F.any_value("actual").alias("actual")), ["sku", "month"])
    if products is not None:
        absent = [c for c in ("style", "color") if c not in out.columns]
        there = [c for c in ("style", "color") if c in out.columns]
        if there:
            counts = out.agg(*(F.count(c).alias(c) for c in there)).first()
            absent += [c for c in there if not counts[c]]
        if absent:
            out = out.drop(*absent).join(products.groupBy("sku").agg(*(F.any_value(c).alias(c) for c in absent)), "sku", "left")
    return out if "actual" not in out.columns or "abs_error" in out.columns else out.withColumn("abs_error", F.abs(F.col("actual") - F.col("predicted")))


# Diagnostics. rows: sku, month, step, predicted, actual, abs_error, style, color.


def performance(rows: DataFrame, key: str, strong: float, moderate: float) -> DataFrame:
    """Sums, bias, WMAPE, share of all error and tier of each style or sku."""
    sums = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("abs_error").alias("abs_error"), F.count_distinct("sku").alias("n_skus"))
    total = sums.agg(F.sum("abs_error")).scalar()
    error = F.when(F.col("actual") > 0, F.col("abs_error") * 100 / F.col("actual"))
    out = sums.withColumns({"wmape": error, "bias_ratio": ratio(F.col("predicted"), F.when(F.col("actual") > 0, F.col("actual"))), "error_share": ratio(F.col("abs_error") * 100, total)})
    return out.withColumns({"tier": accuracy_tier(F.col("wmape"), strong, moderate), "bias": direction(F.col("bias_ratio"))})


def concentration(perf: DataFrame, key: str) -> DataFrame:
    """Rank by error with running sums: how few make most of it."""
    total = perf.agg(F.sum("abs_error")).scalar()
    out = placed(perf.select(key, "abs_error"), [F.round("abs_error", 6).desc(), F.col(key)], {"cumulative_error": "abs_error"})
    return out.select(key, "abs_error", F.col("place").alias("rank"), "cumulative_error", ratio(F.col("cumulative_error") * 100, total).alias("cumulative_percent"))


def banded(perf: DataFrame, key: str) -> DataFrame:
    """Each row's band by volume: the top 20 %, the middle 30 %, the rest; both upper bands have a row at least."""
    n = perf.agg(F.count("*")).scalar()
    top, middle = F.greatest(F.lit(1), F.ceil(n * 2 / 10)), F.greatest(F.lit(1), F.ceil(n * 3 / 10))
    band = F.when(F.col("place") <= top, "TOP_20").when(F.col("place") <= top + middle, "MIDDLE_30").otherwise("BOTTOM_50")
    return placed(perf, [F.round("actual", 6).desc(), F.col(key)]).withColumn("band", band)


def volume_bands(perf: DataFrame, key: str) -> DataFrame:
    sums = banded(perf, key).groupBy("band").agg(F.count("*").alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("abs_error").alias("abs_error"))
    positive = F.when(F.col("actual") > 0, F.col("actual"))
    return sums.withColumns({"wmape": ratio(F.col("abs_error") * 100, positive), "bias_ratio": ratio(F.col("predicted"), positive)})


def accuracy_rank(perf: DataFrame, key: str) -> DataFrame:
    """Rows with a WMAPE, the best first."""
    known = perf.where("wmape is not null").select(key, "wmape", "bias_ratio", "tier")
    return placed(known, [F.round("wmape", 6), F.col(key)]).withColumnRenamed("place", "rank")


def high_impact(perf: DataFrame, key: str) -> DataFrame:
    """Large errors on large volumes: error at or above the 80th percentile and volume above the median."""
    p80, p50 = (perf.agg(F.expr(e)).scalar() for e in ("percentile(abs_error, 0.8)", "percentile(actual, 0.5)"))
    return perf.where((F.col("abs_error") >= p80) & (F.col("actual") > p50))


def client_summary(skus: DataFrame, styles: DataFrame) -> DataFrame:
    """Fourteen metrics in long form. skus, styles: performance()."""

    def percent(tier: str) -> Column:
        return F.count_if(F.col("tier") == tier) * 100.0 / F.count("*")

    def missed(band: str) -> Column:
        inside = F.col("band") == band
        return ratio(F.sum(F.when(inside, F.col("abs_error"))) * 100, F.sum(F.when(inside, F.col("actual"))))

    of_skus = banded(skus, "sku").agg(
        F.count("*").cast("double").alias("n_skus"),
        F.sum("predicted").alias("total_predicted"),
        F.sum("actual").alias("total_actual"),
        ratio(F.sum("abs_error") * 100, F.sum("actual")).alias("wmape"),
        missed("TOP_20").alias("wmape_top_20"),
        missed("BOTTOM_50").alias("wmape_bottom_50"),
        *(percent(t).alias(f"skus_{t.lower()}") for t in ("STRONG", "MODERATE", "WEAK")),
        F.sum("abs_error").alias("total_abs_error"),
    )
    of_styles = styles.agg(F.count("*").cast("double").alias("n_styles"), *(percent(t).alias(f"styles_{t.lower()}") for t in ("STRONG", "MODERATE", "WEAK")))
    worst = skus.orderBy(F.desc("abs_error"), "sku").limit(10).agg(F.sum("abs_error").alias("worst"))
    one = of_skus.crossJoin(of_styles).crossJoin(worst)  # one row each
    one = one.withColumn("error_top_10", ratio(F.col("worst") * 100, F.col("total_abs_error"))).drop("worst", "total_abs_error")
    return one.unpivot([], one.columns, "metric", "value")


def verdict(summary: DataFrame) -> DataFrame:
    """Green, amber or red by WMAPE (55, 70) and bias (5 %, 10 %). summary: step, wmape, bias_ratio."""
    off = F.abs(F.col("bias_ratio") - 1)
    return summary.withColumn("verdict", F.when((F.col("wmape") < 55) & (off <= 0.05), "GREEN").when((F.col("wmape") <= 70) & (off <= 0.10), "AMBER").otherwise("RED"))


def win_loss(rows: DataFrame, products: DataFrame, parent: str = "style") -> DataFrame:
    """By parent, on the skus and months that both variants a and b scored: which has the smaller error."""
    error = {v: F.max(F.when(F.col("variant") == v, F.col("abs_error"))).alias(f"error_{v}") for v in ("a", "b")}
    both = rows.groupBy("sku", "month", "step").agg(F.max("actual").alias("actual"), *error.values()).where("error_a is not null and error_b is not null")
    joined = both.join(products.select("sku", F.col(parent).alias("parent")), "sku").where("parent is not null")
    sums = joined.groupBy("parent").agg(F.sum("actual").alias("actual"), F.sum("error_a").alias("error_a"), F.sum("error_b").alias("error_b"))
    delta = F.round(F.col("error_b") - F.col("error_a"), 4)
    return sums.withColumn("winner", F.when(delta < 0, "b").when(delta > 0, "a").otherwise("tie"))
