"""Whole runs: from raw tables to written facts, and from the fact to written forecasts, simulations, variants and diagnostics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import BACKTEST, FOLDS, MODEL_VERSION, Adjustments
from weftline.operators import baselines, calibrate, etl, ml, panel, score, selection, shares
from weftline.sources import files, retail, sinks
from weftline.sources.versions import CheckFailed, counted, unique, write_checked


def run_etl(headers: DataFrame, lines: DataFrame, products: DataFrame, folder: str, months: DataFrame | None = None) -> dict[str, str]:
    """Write transactions, the monthly fact, what it leaves out, the product dimension, and the calendar if there is one; returns their paths.

    Each table is checked by the job that writes it: as many transactions as lines (headers must not multiply them), no fact without month or
    sku, one dimension row a sku. headers: order_number, order_date and others; lines: order_number, sku, item, month, shipped_qty, revenue and others.
    """
    spark = lines.sparkSession
    paths = {name: f"{folder}/{name}" for name in ("transactions", "gold", "excluded", "dim_product")}
    counted_lines, seen = counted(lines)
    n = write_checked(etl.with_headers(counted_lines, etl.latest_headers(headers, "order_number", ["order_date"], "order_number")), paths["transactions"])
    if n != seen.get["n_rows"]:
        raise CheckFailed(f"{seen.get['n_rows']} lines became {n} transactions")
    base = spark.read.parquet(paths["transactions"])
    write_checked(etl.gold_monthly(base), paths["gold"], {"no_month": F.col("month").isNull(), "no_sku": F.col("sku").isNull()}, ["month"])
    write_checked(etl.excluded_audit(base), paths["excluded"])
    write_checked(unique(products, "sku"), paths["dim_product"], {"no_sku": F.col("sku").isNull()})
    if months is not None:
        paths["dim_date"] = f"{folder}/dim_date"
        write_checked(months, paths["dim_date"], {"no_month": F.col("month").isNull()})
    return paths


def _level(demand: DataFrame, products: DataFrame, parent: str, child: str, forecasts: DataFrame, end: date, cfg) -> DataFrame:
    kids = products.select(F.col(parent).alias("parent"), F.col(child).alias("child")).distinct()
    return shares.allocate(forecasts, shares.compute_shares(demand.withColumnRenamed("entity", "child"), kids, end, cfg))


def run_production(spark: SparkSession, paths: dict[str, str], folder: str, end: date | None = None, phase: int = 1, steps: int = 3, corrections: Adjustments | None = None, learnt: int = 0) -> dict[str, str]:
    """Validate, choose, forecast styles, calibrate, split to colours and skus, flag and check; every table is written and its path returned.

    Training ends where the calendar says: before its holdout in phase 1, after it in phase 2; or at `end`. Phase 1 also scores what it
    forecast for the holdout. corrections: settings of what follows a model; learnt: with how many trees learnt models take part (0: not).
    """
    gold, products = spark.read.parquet(paths["gold"]), files.require(spark.read.parquet(paths["dim_product"]), ["sku", "style", "color"], "dim_product")
    months = spark.read.parquet(paths["dim_date"]) if "dim_date" in paths else None
    end = end or retail.phase_end(months, phase)
    names = ("cv_metrics", "best_models", "style_raw", "calibration", "style_forecast", "color_forecast", "sku_forecast", "production", "risk_flags", "validation")
    out = {name: f"{folder}/{name}" for name in names}

    def write(df: DataFrame, name: str, checks: dict | None = None) -> DataFrame:
        write_checked(df, out[name], checks)
        return spark.read.parquet(out[name])

    demand = {e: panel.demand_by(gold, products, e) for e in ("style", "color", "sku")}
    dense = sinks.kept(panel.build_panel(demand["style"], end), "style-panel")
    kinds = sinks.kept(panel.segment(dense, end), "style-segments")
    categories = products.select(F.col("style").alias("entity")).distinct()
    more = None
    if learnt:
        regular = dense.join(kinds.where("segment = 'REGULAR'").select("entity"), "entity", "left_semi")
        more = score.union_all([ml.walk_forward("gbt", regular, end, f, categories, learnt) for f in FOLDS[:2]])
    metrics = write(selection.cv_metrics(dense, kinds, end, FOLDS[:2], more=more), "cv_metrics")
    best = write(selection.best_models(metrics), "best_models")
    rows = ml.run(dense, kinds, best, categories, end, steps, f"{folder}/models", corrections, learnt or None)
    raw = rows.select("entity", "month", "step", "segment", "model", "units", "lower", "upper", "trail", F.col("step").alias("horizon"), F.lit(MODEL_VERSION).alias("model_version"))
    raw = write(raw, "style_raw", {"negative_units": F.col("units") < 0})
    factors = write(calibrate.factors(calibrate.backtest(dense, end), ["entity", "horizon"], BACKTEST), "calibration")
    calibrated = calibrate.apply_factors(raw, factors, ["entity", "horizon"], "+backtest")
    styles = write(calibrated.select(F.col("entity").alias("parent"), "month", "step", "units", "lower", "upper", "calibration_factor", "model", "model_version"), "style_forecast")
    colors = write(_level(demand["color"], products, "style", "color", styles, end, shares.ZERO_UNSEEN), "color_forecast")
    skus = write(_level(demand["sku"], products, "color", "sku", colors.drop("parent").withColumnRenamed("child", "parent"), end, shares.RECENCY), "sku_forecast")
    named = panel.filled(skus.withColumnRenamed("child", "sku").drop("parent").withColumns({c: F.lit(None).cast("string") for c in ("style", "color", "size")}), products, ["style", "color", "size"])
    sku_kinds = panel.segment(panel.build_panel(demand["sku"], end), end).select(F.col("entity").alias("sku"), "segment")
    known = styles.select(F.col("parent").alias("style"), "month", "step", "calibration_factor", "model", "model_version")
    production = write(named.join(sku_kinds, "sku", "left").join(known, ["style", "month", "step"], "left"), "production")
    evidence = factors.withColumn("bias", F.try_divide("total_predicted", "total_actual"))
    write(score.risk_flags(production, gold, evidence, F.add_months(F.lit(end), 1)), "risk_flags")
    write(score.validation_report(styles, colors, skus), "validation")
    held = retail.holdout(months, gold) if months is not None and phase == 1 else []
    if held:
        out |= {name: f"{folder}/{name}" for name in ("holdout_predictions", "holdout_evaluation", "error_decomposition")}
        predicted = production.where(F.col("month").isin(*held)).select("sku", "month", "step", "units", "segment")
        scored = write(score.scored(predicted, gold), "holdout_predictions")
        write(score.holdout_by_segment(scored, sku_kinds.withColumnRenamed("sku", "entity")), "holdout_evaluation")
        write(score.decomposition(scored, products), "error_decomposition")
    return out


def run_simulation(rows: DataFrame, folder: str) -> dict[str, str]:
    """Write simulated forecasts (entity, segment, month, horizon, model, predicted, actual) and their summaries by month, segment and model."""
    out = {name: f"{folder}/{name}" for name in ("predictions", "by_month", "by_segment", "by_model")}
    write_checked(selection.simulation_rows(rows), out["predictions"], {"negative": F.col("predicted") < 0, "part_units": F.col("predicted") != F.round("predicted")})
    stored = rows.sparkSession.read.parquet(out["predictions"])
    for by in ("month", "segment", "model"):
        write_checked(selection.simulation_summary(stored, by), out[f"by_{by}"])
    return out


def run_variants(forecasts: DataFrame, gold: DataFrame, products: DataFrame, folder: str) -> dict[str, str]:
    """Write what several share variants make of one forecast: forecasts, holdout scores and error decomposition, each a table partitioned by variant.

    forecasts: variant, parent, child (the sku), month, step, units.
    """
    out = {name: f"{folder}/{name}" for name in ("sku_forecast", "holdout", "decomposition")}
    write_checked(forecasts, out["sku_forecast"], {"negative_units": F.col("units") < 0}, ["variant"])
    stored = forecasts.sparkSession.read.parquet(out["sku_forecast"]).withColumnRenamed("child", "sku")
    scored = sinks.kept(score.scored(stored, gold), "scored-variants")
    write_checked(score.holdout_table(scored, ["variant"]), out["holdout"], partition_by=["variant"])
    decomposed = score.version_table(scored.withColumnRenamed("variant", "version"), products).withColumnRenamed("version", "variant")
    write_checked(decomposed, out["decomposition"], partition_by=["variant"])
    return out


def run_diagnostics(rows: DataFrame, folder: str) -> dict[str, str]:
    """Write the nine diagnostics of a scored forecast. rows: score.merged()."""
    rows = sinks.kept(rows, "diagnosed")
    styles, skus = sinks.kept(score.performance(rows, "style", 40, 70), "style-performance"), sinks.kept(score.performance(rows, "sku", 50, 100), "sku-performance")
    tables = {
        "style_performance": styles,
        "sku_performance": skus,
        "error_concentration": score.concentration(skus, "sku"),
        "volume_bands": score.volume_bands(skus, "sku"),
        "accuracy_rank": score.accuracy_rank(skus, "sku"),
        "reliability_rank": score.accuracy_rank(styles, "style"),
        "bias_direction": skus.groupBy("bias").agg(F.count("*").alias("n"), F.sum("abs_error").alias("abs_error")),
        "high_impact": score.high_impact(skus, "sku"),
        "client_summary": score.client_summary(skus, styles),
    }
    for name, table in tables.items():
        write_checked(table, f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in tables}
