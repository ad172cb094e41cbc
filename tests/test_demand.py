"""Micro fixtures of the demand operators, with results worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from weftline.config import FOLDS, GLOBAL, Shares
from weftline.operators import baselines, calibrate, etl, panel, score, selection, shares
from weftline.sources import files, retail, sinks
from weftline.streaming import demand as stream


def month(text):
    return date.fromisoformat(text + "-01")


def close(a, b, digits=5):
    assert a == pytest.approx(b, abs=10**-digits)


def series(spark, units, start="2024-01", entity="a"):
    y, m = map(int, start.split("-"))
    return spark.createDataFrame([(entity, date(y + (m - 1 + k) // 12, (m - 1 + k) % 12 + 1, 1), float(u), 0.0) for k, u in enumerate(units)], "entity string, month date, units double, revenue double")


def test_croston(spark):
    h = baselines.histories(series(spark, [0, 3, 0, 0, 5, 2]))
    row = h.select(baselines.croston(F.col("u")).alias("c"), (baselines.croston(F.col("u")) * 0.9).alias("s")).first()
    close(row["c"], 2.363636)
    close(row["s"], 2.127273)
    assert baselines.histories(series(spark, [0, 0])).select(baselines.croston(F.col("u")).alias("c")).first()["c"] == 0


def test_metrics(spark):
    from weftline.functions import mae, mape, rmse, wmape

    a, p = F.col("a"), F.col("p")
    row = spark.createDataFrame([(10.0, 8.0), (0.0, 1.0), (5.0, 5.0)], "a double, p double").agg(rmse(a, p).alias("rmse"), mae(a, p).alias("mae"), mape(a, p).alias("mape"), wmape(a, p).alias("wmape")).first()
    close(row["rmse"], 1.290994)
    assert (row["mae"], row["mape"], row["wmape"]) == (1.0, 10.0, 20.0)


@pytest.mark.parametrize(
    "cfg, expected",
    [
        (shares.ZERO_UNSEEN, (0.5, 0.5, 0.0)),
        (shares.BASELINE, (0.375, 0.375, 0.25)),
        (shares.RECENCY, (0.525, 0.225, 0.25)),
        (shares.SMOOTHED, (0.364865, 0.364865, 0.270270)),
        (shares.CAPPED, (0.375, 0.375, 0.25)),
        (Shares(smoothing=1.0), (1 / 3, 1 / 3, 1 / 3)),
    ],
)
def test_shares(spark, cfg, expected):
    demand = spark.createDataFrame([("A", month("2025-12"), 10.0), ("A", month("2025-08"), 20.0), ("B", month("2023-06"), 30.0)], "child string, month date, units double")
    children = spark.createDataFrame([("P", c) for c in "ABC"], "parent string, child string")
    rows = {r["child"]: r for r in shares.compute_shares(demand, children, month("2025-12"), cfg).collect()}
    for child, share in zip("ABC", expected):
        close(rows[child]["share"], share)
        assert rows[child]["used_window"] == "full_history"


def test_shares_without_sales_are_equal(spark):
    demand = spark.createDataFrame([], "child string, month date, units double")
    children = spark.createDataFrame([("P", "A"), ("P", "B")], "parent string, child string")
    assert {(r["share"], r["used_window"]) for r in shares.compute_shares(demand, children, month("2025-12")).collect()} == {(0.5, "equal")}


def test_size_shares_match_null_sizes(spark):
    demand = spark.createDataFrame([("A", month("2025-12"), 30.0), ("B", month("2025-12"), 10.0)], "child string, month date, units double")
    children = spark.createDataFrame([("P", "A", None), ("P", "B", "1"), ("P", "C", "1")], "parent string, child string, size string")
    rows = {r["child"]: r["share"] for r in shares.size_shares(demand, children, month("2025-12")).collect()}
    close(rows["A"], 0.75 / 1.25)
    close(rows["B"], rows["C"])
    close(sum(rows.values()), 1)


def test_adjustments(spark):
    row = spark.range(1).select(
        baselines.capped(F.lit(100.0), F.lit(60.0), F.lit(30.0)).alias("cap"),
        baselines.shrunk(F.lit(90.0), F.lit(20.0)).alias("shrink"),
        baselines.blended(F.lit(100.0), F.lit(50.0)).alias("blend"),
        baselines.capped(F.lit(100.0), F.lit(0.0), F.lit(0.0)).alias("floor"),
        baselines.shrunk(F.lit(30.0), F.lit(20.0)).alias("near"),
    ).first()
    assert row["cap"] == 90 and row["blend"] == 85 and row["floor"] == 1 and row["near"] == 30
    close(row["shrink"], 76)


def test_seasonal(spark):
    p = series(spark, [m + 100 * y for y in (0, 1) for m in range(1, 13)])
    row = baselines.forecast(p, month("2025-12"), 1).first()
    assert row["seasonal_naive"] == 101 and row["seasonal_avg3y"] == 51
    assert row["ma_3"] == 111 and row["month"] == month("2026-01")


def test_short_history(spark):
    row = baselines.forecast(series(spark, [4.0, 6.0]), month("2024-02"), 1).first()
    assert row["ma_3"] == 5 and row["seasonal_naive"] == 0 and row["seasonal_avg3y"] == 0


def test_rolling(spark):
    rows = panel.features(series(spark, [4, 0, 8, 2])).orderBy("month").collect()
    assert [r["rolling_mean_3"] for r in rows] == [None, 4, 2, 4]
    assert rows[0]["rolling_std_3"] is None and rows[1]["rolling_std_3"] is None
    close(rows[2]["rolling_std_3"], 2.828427)
    assert [r["rolling_mean_6"] for r in rows] == [None, None, None, 4]
    assert [r["trend_index"] for r in rows] == [0, 1, 2, 3]


def test_segments(spark):
    dead = panel.segment(series(spark, [5] + [0] * 13), month("2025-02")).first()
    assert dead["segment"] == "DEAD"
    edge = panel.segment(series(spark, [1, 0, 0, 0, 0, 1, 1, 1, 1, 1]), month("2024-10")).first()
    assert edge["segment"] == "INTERMITTENT" and edge["zero_ratio"] == 0.4
    close(panel.segment(series(spark, [4, 8, 2]), month("2024-03")).first()["cv_nonzero"], 0.534522)


def test_holdout_scores_drop_what_is_only_filled_in(spark):
    at = month("2001-08")
    models = "ma_3 double, ma_12 double, seasonal_naive double, seasonal_avg3y double, croston_sba double, zero double"
    forecasts = spark.createDataFrame([(e, at, 1, 4.0, 4.0, 2.0, 2.0, 1.0, 0.0) for e in ("old", "young", "new")], f"entity string, month date, step int, {models}")
    actuals = spark.createDataFrame([("old", at, 4.0), ("young", at, 0.0), ("gone", at, 9.0)], "entity string, month date, actual double")
    kinds = spark.createDataFrame([("old", "REGULAR", 30), ("young", "REGULAR", 5), ("gone", "DEAD", 30)], "entity string, segment string, total_months int")
    found = {r["model"]: r for r in selection.holdout_scores(forecasts, actuals, kinds).collect()}
    assert {r["segment"] for r in found.values()} == {"REGULAR"} and len(found) == 6
    naive, mean = found["seasonal_naive"], found["ma_3"]
    assert (naive["n_candidate"], naive["n_dropped"], naive["n_obs"], naive["mae"], naive["wmape"]) == (2, 1, 1, 2.0, 50.0)
    assert (mean["n_dropped"], mean["mae"], mean["mape"], mean["rmse"]) == (0, 2.0, 0.0, pytest.approx(8**0.5))
    assert selection.holdout_scores(forecasts, actuals.where("false"), kinds).count() == 0


def test_zero_fill(spark):
    d = spark.createDataFrame([("a", month("2025-01"), 3.0, 1.0), ("a", month("2025-04"), 4.0, 1.0), ("late", month("2025-07"), 1.0, 1.0), (None, month("2025-01"), 9.0, 1.0)], "entity string, month date, units double, revenue double")
    rows = panel.build_panel(d, month("2025-06")).orderBy("month").collect()
    assert [r["units"] for r in rows] == [3, 0, 0, 4, 0, 0] and {r["entity"] for r in rows} == {"a"}


def test_header_dedupe(spark):
    rows = [("X", None, date(2025, 1, 9)), ("X", date(2025, 1, 5), date(2025, 1, 1)), ("X", date(2025, 1, 5), date(2025, 1, 2))]
    out = etl.latest_headers(spark.createDataFrame(rows, "order_number string, invoice_date date, order_date date"), "order_number", ["invoice_date", "order_date"], "order_date").collect()
    assert len(out) == 1 and out[0]["order_date"] == date(2025, 1, 2)


def test_goods_rule(spark):
    rows = spark.createDataFrame([("FREIGHT-1", 1.0), ("altltlx", 1.0), ("TEE-01", 0.0), ("TEE-02", 3.0), (None, 2.0)], "item string, shipped_qty double")
    assert [r["item"] for r in rows.where(etl.is_goods()).collect()] == ["TEE-02", None]


def test_clean_lines_takes_accounting_month(spark):
    raw = spark.createDataFrame([("1", "1", "0", "A", "B", None, "2023", "5", "2", "0", "1", " tee SHIRT "), ("2", "1", "0", "A", "A", "2024-03-09", None, None, "bad", None, "0", "x"), ("3", "1", "0", "A", None, None, "2023", "13", "1", "0", "0", "x")], ["order_number", "line_number", "bo_number", "item_number", "original_item", "invoice_date", "acct_year", "acct_period", "shipped_qty", "cancel_qty", "returned_qty", "item_category"])
    rows = etl.clean_lines(raw, {}, ["shipped_qty", "cancel_qty", "returned_qty"]).orderBy("order_number").collect()
    assert [r["demand_month"] for r in rows] == [date(2023, 5, 1), date(2024, 3, 1), None]
    assert [r["is_substituted"] for r in rows] == [1, 0, 0] and rows[0]["is_return"] == 1 and rows[1]["shipped_qty"] == 0 and rows[1]["is_zero_ship"] == 1
    assert rows[0]["line_key"] == "1|1|0" and rows[0]["item_category"] == "Tee Shirt"


def test_clean_orders(spark):
    raw = spark.createDataFrame([(" 7 ", "2024-05-17", "12.5"), ("8", "nonsense", "x")], ["order-number", "order-date", "OrderValue"])
    rows = etl.clean_orders(raw, {"order-number": "order_number", "order-date": "order_date", "OrderValue": "order_value"}, ["order_date"], ["order_value"]).orderBy("order_number").collect()
    assert rows[0]["order_number"] == "7" and rows[0]["order_month"] == date(2024, 5, 1) and rows[0]["order_value"] == 12.5
    assert rows[1]["order_date"] is None and rows[1]["order_value"] is None


def test_gate(spark):
    evidence = spark.createDataFrame([("s", 1, 100.0, 120.0)], "entity string, horizon int, actual double, predicted double")
    gate = evidence.withColumn("month", F.lit(month("2025-01")))
    row = calibrate.global_gate(evidence, gate).first()
    assert row["factor"] == GLOBAL.low and row["accepted"] == 1 and row["reason"] == "within tolerance"
    under = spark.createDataFrame([("s", 1, 120.0, 100.0)], "entity string, horizon int, actual double, predicted double").withColumn("month", F.lit(month("2025-01")))
    assert calibrate.global_gate(evidence, under).first()["accepted"] == 0
    blind = calibrate.global_gate(evidence, gate.where("false")).first()
    assert blind["accepted"] == 0 and blind["applied_factor"] == 1 and blind["reason"] == "no evidence"


def test_tiers(spark):
    from weftline.config import BACKTEST

    rows = spark.createDataFrame([(6, 499.0), (6, 500.0), (3, 199.0), (3, 200.0), (0, 0.0)], "n int, total double").select(calibrate.tier(F.col("n"), F.col("total"), BACKTEST).alias("t")).collect()
    assert [r["t"] for r in rows] == ["MODERATE", "STRONG", "WEAK", "MODERATE", "NONE"]


def test_null_parents_stand_alone(spark):
    gold = spark.createDataFrame([("1", month("2025-01"), 1.0, 1.0), ("2", month("2025-01"), 2.0, 1.0), ("3", month("2025-01"), 4.0, 1.0)], "sku string, month date, units double, revenue double")
    products = spark.createDataFrame([("1", "s", "c"), ("2", None, None)], "sku string, style string, color string")
    assert [r["units"] for r in panel.demand_by(gold, products, "style").collect()] == [1.0]
    assert {r["sku"] for r in panel.standalone(gold, products).collect()} == {"2", "3"}
    c = shares.coverage(gold, products).first()
    assert (c["dim_skus"], c["sold_skus"], c["standalone_skus"], c["skus_without_parent"]) == (2, 3, 2, 1)


def test_profiles(spark):
    cells = [("D", "d1", month("2025-12"), 5.0)]
    cells += [("M", "m1", date(2025, m, 1), 90.0) for m in range(1, 13)] + [("M", "m2", date(2025, m, 1), 10.0) for m in range(1, 13)]
    cells += [("T", "t1", date(2025, m, 1), 50.0) for m in range(1, 13)] + [("T", "t2", date(2025, m, 1), 50.0) for m in range(1, 13)]
    cells += [("H", f"h{k}", date(2025, m, 1), 80.0 if (m + k) % 2 else 20.0) for m in range(1, 13) for k in (1, 2)]
    cells += [("S", "s1", month("2025-12"), 50.0)]
    demand = spark.createDataFrame([(c, m, u) for _, c, m, u in cells], "child string, month date, units double")
    children = spark.createDataFrame(sorted({(p, c) for p, c, _, _ in cells}), "parent string, child string")
    kinds = {r["parent"]: r["profile"] for r in shares.profiles(demand, children, month("2025-12")).collect()}
    assert kinds == {"D": "DEAD_OR_NEAR_DEAD", "M": "DOMINANT", "T": "STABLE", "H": "HIGH_VOLUME", "S": "SPARSE"}


def test_origins():
    assert selection.origins(month("2025-12"), FOLDS[0])[-1] == month("2025-11")
    assert len(selection.origins(month("2025-12"), FOLDS[1])) == 4


def test_allocation_reconciles(spark):
    f = spark.createDataFrame([("P", month("2026-01"), 1, 100.0, 80.0, 120.0), ("Q", month("2026-01"), 1, 10.0, 8.0, 12.0)], "parent string, month date, step int, units double, lower double, upper double")
    s = spark.createDataFrame([("P", "A", 0.3), ("P", "B", 0.7)], "parent string, child string, share double")
    out = shares.allocate(f, s)
    assert {(r["child"], r["units"]) for r in out.collect()} == {("A", 30.0), ("B", 70.0), (None, 0.0)}
    assert {r["parent"]: r["passed"] for r in shares.reconcile(f, out).collect()} == {"P": 1, "Q": 0}


def test_allocation_that_does_not_meet_its_parents(spark):
    up = spark.createDataFrame([("p", 1, 1, 10.0), ("q", 1, 1, 0.0), ("r", 1, 1, 5.0)], "parent string, month int, step int, units double")
    down = spark.createDataFrame([("p", "a", 1, 1, 12.0), ("p", "b", 1, 1, -2.0), ("q", "c", 1, 1, 0.0), ("r", "d", 1, 1, 4.9)], "parent string, child string, month int, step int, units double")
    found = shares.reconcile_summary(up, down).first()
    assert (found["n_groups"], found["n_parents"], found["n_children"]) == (3, 3, 4)
    assert (found["sum_check_passed"], found["share_check_passed"], found["no_negatives"]) == (0, 1, 0)
    close(found["max_abs_diff"], 0.1)
    without = shares.reconcile_summary(up, down.where("parent <> 'r'")).first()
    assert (without["share_check_passed"], without["max_abs_diff"]) == (0, 5.0)  # a parent whose children are missing
    none = shares.reconcile_summary(up.where("false"), down.where("false")).first()
    assert (none["n_groups"], none["max_abs_diff"], none["sum_check_passed"], none["no_negatives"]) == (0, None, 1, 1)


def test_upsert(spark, tmp_path):
    schema = "run_date date, key string, month date, horizon int, model string, units double"
    d = date(2025, 1, 1)
    first = spark.createDataFrame([(d, "a", d, 1, "m", 1.0), (d, "b", d, 1, "m", 2.0)], schema)
    second = spark.createDataFrame([(d, "b", d, 1, "m", 9.0), (d, "c", d, 1, "m", 3.0)], schema)
    sinks.upsert(spark, str(tmp_path / "t"), first, 0)
    path = sinks.upsert(spark, str(tmp_path / "t"), second, 1)
    assert {(r["key"], r["units"]) for r in spark.read.parquet(path).collect()} == {("a", 1.0), ("b", 9.0), ("c", 3.0)}


def test_split_files(spark, tmp_path):
    for k, (year, value) in enumerate([(2023, "1"), (2024, "2")]):
        (tmp_path / f"lines_{k}.csv").write_text(f"acct_year,x\n{year},{value}\n")
    df = files.read_splits(spark, str(tmp_path / "lines_*.csv"))
    assert {(r["source_file"], r["years"]) for r in files.coverage(df).collect()} == {("lines_0.csv", "2023"), ("lines_1.csv", "2024")}
    assert files.read_optional(spark, str(tmp_path / "none.csv")) is None
    assert files.read_first(spark, [str(tmp_path / "none.csv"), str(tmp_path / "lines_0.csv")]).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_first(spark, [str(tmp_path / "none.csv")])
    with pytest.raises(ValueError):
        files.require(df, ["missing"])
    assert files.union_of([df, df.drop("x")]).count() == 4


def test_column_variants(spark):
    df = files.normalised(spark.createDataFrame([(1.0, "True"), (2.0, "no")], ["ForecastUnits", "HasActual"]))
    assert df.columns == ["predicted_units", "has_actual"] and [r["has_actual"] for r in df.collect()] == [True, False]


def test_train_end(spark):
    assert retail.train_end(retail.dim_date(spark)) == date(2001, 7, 1)
    assert retail.train_end(retail.dim_date(spark), with_holdout=True) == date(2001, 9, 1)
    with pytest.raises(ValueError):
        retail.train_end(retail.dim_date(spark).where("split = 'FORECAST'"))
    assert [retail.phase_end(retail.dim_date(spark), p) for p in (1, 2)] == [date(2001, 7, 1), date(2001, 9, 1)]
    with pytest.raises(ValueError, match="phase"):
        retail.phase_end(retail.dim_date(spark), 3)


def test_holdout_is_found_under_several_names(spark):
    m = [month(f"2024-0{k}") for k in range(1, 5)]
    named = spark.createDataFrame([(x, " holdout " if k in (1, 2) else "Train", None) for k, x in enumerate(m)], "month date, DataSplit string, Split string")
    assert retail.holdout(named) == m[1:3] and retail.train_end(named) == m[3]
    flags = spark.createDataFrame([(x, "1" if k < 2 else "False") for k, x in enumerate(m)], "month date, is_train string")
    assert retail.holdout(flags) == m[2:] and retail.train_end(flags) == m[1] and retail.train_end(flags, with_holdout=True) == m[3]
    assert retail.holdout(flags, spark.createDataFrame([(m[2],), (m[0],)], "month date")) == m[2:3]
    for bad in (flags.select("month"), flags.where("is_train = '1'")):
        with pytest.raises(ValueError, match="no holdout month"):
            retail.holdout(bad)


def test_dimension(spark):
    item = spark.createDataFrame([("1", "a", "c", "s", "red", "01", "s|red"), ("2", "b", "c", "t", "red", "x", "t|red"), ("2", "b", "c", "t", "red", "x", "t|red")], "sku string, item_name string, item_categ string, style_code string, color_code string, size_code string, style_color_key string")
    size = spark.createDataFrame([(1, "small")], "size_code int, size_desc string")
    color = spark.createDataFrame([("s|red", "Red")], "style_color_key string, color_desc string")
    style = spark.createDataFrame([("s", "S", "SS", None, "Y", "A")], "style_code string, style_desc string, style_code_desc string, web_description string, web_active string, item_status string")
    out = etl.dim_product(item, size, color, style, provenance=True)
    assert out.columns == [*etl.DIMENSION, "filled_by"] and len(etl.DIMENSION) == 14
    rows = {r["sku"]: r for r in out.collect()}
    assert len(rows) == 2 and rows["1"]["filled_by"] == "item,size,color,style" and rows["2"]["filled_by"] == "item" and rows["2"]["size_code"] == "x"
    assert (rows["1"]["size_desc"], rows["1"]["color_desc"], rows["1"]["style_code_desc"], rows["1"]["web_description"]) == ("small", "Red", "SS", None)
    with pytest.raises(Exception, match="more than one row of 1"):
        etl.dim_product(item, size.unionByName(spark.createDataFrame([(1, "s")], size.schema)), color, style).collect()


def test_title(spark):
    from weftline.functions import title

    texts = ["t-shirt", "AIR mail", "men's 2nd x", "", None, "élan ÉTÉ", "a", "1a b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(title("t").alias("t")).collect()
    assert [r["t"] for r in rows] == [None if t is None else t.title() for t in texts]


def test_merged_predictions(spark):
    p = spark.createDataFrame([("1", month("2025-01"), 1, 5.0), ("1", month("2025-02"), 1, 6.0), ("2", month("2025-01"), 2, 7.0)], "sku string, MonthStart date, HorizonMonths int, ForecastUnits double")
    g = spark.createDataFrame([("1", month("2025-01"), 4.0), ("1", month("2025-01"), 4.0), ("2", month("2025-01"), 9.0)], "sku string, month date, units double")
    d = spark.createDataFrame([("1", "s", "c"), ("1", "s", "c")], "sku string, style string, color string")
    rows = score.merged(p, g, d).orderBy("sku").collect()
    assert [(r["sku"], r["step"], r["predicted"], r["actual"], r["abs_error"], r["style"]) for r in rows] == [("1", 1, 5.0, 4.0, 1.0, "s"), ("2", 2, 7.0, 9.0, 2.0, None)]
    assert score.merged(p, g, step=1).count() == 1 and score.merged(p, g, months=[month("2025-02")]).count() == 0
    whole = p.withColumns({"ActualUnits": F.lit(5.5), "style": F.lit("own"), "color": F.lit(None).cast("string")})
    rows = score.merged(whole, None, d, [month("2025-02")]).collect()
    assert [(r["actual"], r["abs_error"], r["style"], r["color"]) for r in rows] == [(5.5, 0.5, "own", "c")]
    assert "abs_error" not in score.merged(p).columns and score.merged(p).count() == 3


def test_against_one_population(spark):
    schema = "sku string, month date, step int, actual double, abs_error double"
    a = spark.createDataFrame([("1", month("2025-01"), 1, 10.0, 2.0), ("2", month("2025-01"), 1, 10.0, 1.0), ("3", month("2025-01"), 1, 10.0, 9.0)], schema)
    b = spark.createDataFrame([("1", month("2025-01"), 1, 10.0, 1.0), ("2", month("2025-01"), 1, 10.0, 1.0), ("4", month("2025-01"), 1, 10.0, 0.0)], schema)
    r = score.against(a, b).first()
    assert (r["n"], r["wmape_a"], r["wmape_b"], r["delta"], r["better"]) == (2, 15.0, 10.0, 5.0, "b")


def test_encoding_of_unseen(spark):
    codes = panel.encoding(spark.createDataFrame([("b",), ("a",), (None,)], "v string"), "v")
    rows = panel.encoded(spark.createDataFrame([("a",), ("b",), ("z",)], "v string"), "v", codes).collect()
    assert {r["v"]: r["v_enc"] for r in rows} == {"a": 0, "b": 1, "z": -1}


def test_risk_flags(spark):
    f = spark.createDataFrame([("1", "s", month("2025-01"), 1, 100.0), ("2", "z", month("2025-01"), 1, 0.0), ("3", "s", month("2025-01"), 1, 20.0)], "sku string, style string, month date, step int, units double")
    gold = spark.createDataFrame([("1", month("2024-12"), 4.0)] + [("3", month(f"2024-{k:02d}"), 10.0) for k in range(5, 13)] + [("1", month("2025-01"), 99.0)], "sku string, month date, units double")
    evidence = spark.createDataFrame([("s", 1, "STRONG", 1.4)], "entity string, horizon int, evidence string, bias double")
    rows = score.risk_flags(f, gold, evidence, month("2025-01")).collect()
    found = {(r["sku"], r["flag"]) for r in rows}
    assert found == {
        *(("1", x) for x in ("sparse_history", "large_forecast_jump", "low_recent_demand", "parent_forecast_high_error")),
        *(("2", x) for x in ("sparse_history", "intermittent_demand", "low_recent_demand", "calibration_weak_or_missing")),
        ("3", "parent_forecast_high_error"),
    }
    reasons = {(r["sku"], r["flag"]): (r["severity"], r["reason"]) for r in rows}
    assert reasons["1", "large_forecast_jump"] == ("HIGH", "units 100.0 above 3 times the recent mean 4.0") and reasons["2", "sparse_history"] == ("MEDIUM", "only 0 months with sales")
    assert reasons["3", "parent_forecast_high_error"] == ("MEDIUM", "style forecast at 1.4 of the actuals") and reasons["2", "calibration_weak_or_missing"][1] == "evidence NONE"


def test_stream_upsert(spark, tmp_path):
    schema = "ts timestamp, event_type string, value double"
    spark.sql("select timestamp'2024-01-01 01:00:00' as ts, 'view' as event_type, 2D as value union all select timestamp'2024-01-01 02:00:00', 'view', 3D").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    stream.start_upsert(stream.windowed(source), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out" / "v0")).collect()
    assert [(r["key"], r["n"], r["total"]) for r in rows] == [("view", 2, 5.0)]


def test_places_over_partitions(spark):
    """Places and running sums are those of one window over everything, ties and all."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from weftline.operators.ranking import placed

    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 97).cast("double").alias("x")).repartition(7)
    found = {r["id"]: (r["place"], r["s"]) for r in placed(rows, [F.desc("x"), F.col("id")], {"s": "x"}).collect()}
    w = Window.orderBy(F.desc("x"), "id")
    assert found == {r["id"]: (r["p"], r["s"]) for r in rows.select("id", F.row_number().over(w).alias("p"), F.sum("x").over(w).alias("s")).collect()}
    assert placed(rows.where("false"), [F.col("id")]).count() == 0


def test_coerced_rows_and_their_count(spark):
    from weftline.operators import panel

    raw = spark.createDataFrame([("a", "2020-01-01", "2"), ("a", "soon", "2"), (None, "2020-01-01", "2"), ("b", "2020-02-01", "many")], "entity string, month string, units string")
    rows, dropped = panel.coerced(raw)
    assert [(r["entity"], r["units"]) for r in rows.collect()] == [("a", 2.0)] and dropped.first()[0] == 3


def test_split_files_and_lookups(spark, tmp_path):
    from weftline.sources import files

    for k, name in enumerate(("order_lines_2020.csv", "order_lines_2021.csv")):
        (tmp_path / name).write_text("order_number,acct_year\n" + "".join(f"{i},{2020 + k}\n" for i in range(3 + k)))
    found = files.read_splits(spark, f"{tmp_path}/order lines*.csv")  # blanks in the pattern, _ in the names
    assert [tuple(r) for r in files.listed(found).collect()] == [("order_lines_2020.csv", 3), ("order_lines_2021.csv", 4)]
    assert files.whole_union([found, found.drop("acct_year")]).count() == 14
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_splits(spark, f"{tmp_path}/none*.csv")
    for name in ("item", "size", "style", "color"):
        (tmp_path / f"{name}.csv").write_text("code,name\n1,x\n")
    lookups = files.read_lookups(spark, str(tmp_path))
    assert set(lookups) == {"item", "size", "style", "color"} and lookups["size"].columns == ["code", "name"]
