"""Whole runs on the smallest tables: every table written, checked by the job that writes it, and read back; both phases of the calendar."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from weftline.config import Adjustments
from weftline.operators import runs, score
from weftline.plans import catalog
from weftline.sources import retail
from weftline.sources.versions import CheckFailed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    headers = retail.table(spark, SF, "orders").selectExpr("o_orderkey as order_number", "cast(o_orderdate as date) as order_date")
    products = retail.dim_product(spark, SF)
    lines = retail.order_lines(spark, SF).join(products.select("sku", "item"), "sku")
    return runs.run_etl(headers, lines, products, str(tmp_path_factory.mktemp("etl")), retail.dim_date(spark))


def test_etl(spark, tables):
    gold = spark.read.parquet(tables["gold"])
    assert gold.groupBy("sku", "month").count().where("count > 1").count() == 0
    assert gold.agg({"units": "sum"}).first()[0] == retail.order_lines(spark, SF).where("shipped_qty > 0").agg({"shipped_qty": "sum"}).first()[0]
    assert set(tables) == {"transactions", "gold", "excluded", "dim_product", "dim_date"}
    assert spark.read.parquet(tables["transactions"]).count() == retail.order_lines(spark, SF).count()


def test_etl_refuses_doubled_products(spark, tmp_path):
    lines = spark.createDataFrame([(1, "a", "thing", date(2024, 1, 1), 2.0, 3.0)], "order_number long, sku string, item string, month date, shipped_qty double, revenue double")
    headers = spark.createDataFrame([(1, date(2024, 1, 2)), (1, date(2024, 1, 3))], "order_number long, order_date date")
    products = spark.createDataFrame([("a", "x"), ("a", "y")], "sku string, style string")
    with pytest.raises(Exception, match="more than one row of a"):
        runs.run_etl(headers, lines, products, str(tmp_path))
    with pytest.raises(CheckFailed, match="no_sku"):
        runs.run_etl(headers, lines.withColumn("sku", F.lit(None).cast("string")), products, str(tmp_path / "b"))


def test_both_phases(spark, tables, tmp_path):
    first = runs.run_production(spark, tables, str(tmp_path / "1"))
    second = runs.run_production(spark, tables, str(tmp_path / "2"), phase=2)
    n = retail.dim_product(spark, SF).count()
    for out, months in ((first, [date(2001, 8, 1), date(2001, 9, 1), date(2001, 10, 1)]), (second, [date(2001, 10, 1), date(2001, 11, 1), date(2001, 12, 1)])):
        checks = {r["check"]: r["passed"] for r in spark.read.parquet(out["validation"]).collect()}
        assert set(checks) == {"no_negative_units", "no_null_units", "bounds_ordered", "unique_keys", "colors_meet_styles", "skus_meet_colors"}
        assert checks["no_negative_units"] == checks["unique_keys"] == checks["no_null_units"] == checks["bounds_ordered"] == 1
        rows = spark.read.parquet(out["production"])
        assert rows.count() == 3 * n and sorted(r["month"] for r in rows.select("month").distinct().collect()) == months
        assert rows.where("style is null or color is null or size is null").count() == 0
    assert set(first) - set(second) == {"holdout_predictions", "holdout_evaluation", "error_decomposition"} and len(first) == 13
    scored = spark.read.parquet(first["holdout_predictions"])
    assert scored.count() > 0 and scored.where("month not in ('2001-08-01', '2001-09-01')").count() == 0
    assert {r["level"] for r in spark.read.parquet(first["error_decomposition"]).collect()} == {"sku", "color", "style"}


def test_learnt_models_and_corrections_in_production(spark, tables, tmp_path):
    out = runs.run_production(spark, tables, str(tmp_path), corrections=Adjustments(), learnt=2)
    assert "gbt" in {r["model"] for r in spark.read.parquet(out["cv_metrics"]).collect()}
    raw = spark.read.parquet(out["style_raw"])
    best = {(r["segment"], r["horizon"]): r["best_model"] for r in spark.read.parquet(out["best_models"]).collect()}
    assert {(r["segment"], r["model"]) for r in raw.select("segment", "model").distinct().collect()} == {(s, best[s, 3]) for s in {r["segment"] for r in raw.select("segment").distinct().collect()}}
    assert {t["rule"] for r in raw.collect() for t in r["trail"]} <= {"guardrail", "feedback", "blend", "cap", "shrink"}


def test_simulation_variants_and_diagnostics(spark, tmp_path):
    out = runs.run_simulation(catalog.simulated(spark, SF), str(tmp_path / "s"))
    by = {name: spark.read.parquet(path) for name, path in out.items()}
    assert {r["model"] for r in by["predictions"].collect()} == {r["model"] for r in by["by_model"].collect()} and by["by_month"].count() == 3
    assert by["predictions"].where("has_actual").count() == by["by_segment"].agg({"n_scored": "sum"}).first()[0]
    assert by["predictions"].where("has_actual <> (error is not null) or abs_pct_error < 0 or conservative > middle or middle > aggressive").count() == 0
    out = runs.run_variants(catalog.variant_alloc(spark, SF, {"a": catalog.shares.BASELINE, "b": catalog.shares.RECENCY}), catalog.gold(spark, SF), retail.dim_product(spark, SF), str(tmp_path / "v"))
    assert {p.name for p in (tmp_path / "v" / "sku_forecast").iterdir() if p.name.startswith("variant")} == {"variant=a", "variant=b"}
    table = spark.read.parquet(out["decomposition"])
    assert {r["variant"] for r in table.collect()} == {"a", "b"} and table.where("variant = 'a' and delta <> 0").count() == 0
    out = runs.run_diagnostics(catalog.diagnosed(spark, SF), str(tmp_path / "d"))
    assert len(out) == 9 and all(spark.read.parquet(p).count() for name, p in out.items() if name != "high_impact")
    assert spark.read.parquet(out["client_summary"]).count() == score.client_summary(catalog.sku_perf(spark, SF), catalog.style_perf(spark, SF)).count()
