"""Steps whose cost must grow no faster than the tables: what is broadcast, how often the fact is made, and histories without joins."""

import datetime
import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from weftline.config import Folds
from weftline.operators import baselines, etl, ml, panel, score, selection, shares
from weftline.plans import catalog
from weftline.sources import retail, sinks

SF = "/root/testdata/sf0.001"
END = datetime.date(2001, 7, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name", ["gold", "facts"])
def test_products_are_not_broadcast(spark, name):
    assert "Broadcast" not in plan(getattr(catalog, name)(spark, SF))


def test_products_are_not_broadcast_where_children_split(spark):
    found = plan(catalog.split(spark, SF, "color", "sku", shares.BASELINE))
    assert "Broadcast" not in found and "ShuffledHashJoin" in found


def test_kept_fact_is_not_broadcast(spark):
    """Its file is small, but each row holds many months."""

    @catalog.once
    def joined(spark, d):
        skus = spark.range(10).select(F.col("id").cast("string").alias("sku"))
        return skus.join(catalog.gold(spark, d), "sku", "left")

    assert "Broadcast" not in plan(joined(spark, SF))


def made(spark, monkeypatch, name) -> list[str]:
    """Labels of what the query writes to the shared folder."""
    labels, keep = [], sinks.kept
    monkeypatch.setattr(sinks, "kept", lambda df, label: labels.append(label) or keep(df, label))
    lines, table = [], retail.order_lines
    monkeypatch.setattr(retail, "order_lines", lambda s, d: lines.append(d) or table(s, d))
    catalog.QUERIES[name](spark, SF)
    return [*labels, *(["lines"] * len(lines))]


@pytest.mark.parametrize("name", ["alloc_grid_top3", "alloc_with_standalone", "alloc_v6", "holdout_v6", "v6_against_skus", "holdout_by_segment", "version_compare"])
def test_lines_are_read_once(spark, monkeypatch, name):
    found = made(spark, monkeypatch, name)
    assert found.count("lines") == 1 and found.count("facts") == 1


@pytest.mark.parametrize("name", ["fc_dispatch", "fc_adjusted", "fc_adjust_trail"])
def test_chains_of_skus_keep_a_row_a_series(spark, monkeypatch, name):
    found = made(spark, monkeypatch, name)
    assert found == ["sku-series", "lines"]


def test_validation_shuffles_sums_only(spark):
    """Nothing of a series is shuffled: the only exchange of the metrics is that of their sums."""
    p = sinks.kept(catalog.segmented(spark, SF, "sku"), "sku-series")
    found = selection.cv_metrics(p, p, END)._jdf.queryExecution().executedPlan().toString()
    assert found.count("Exchange") == 1 and "Join" not in found


def test_fact_survives_packing(spark):
    rows = spark.createDataFrame([("a", datetime.date(2001, 1, 1), 1.0, None), ("a", datetime.date(2000, 5, 1), 2.0, 3.0), ("b", None, 4.0, 5.0), (None, datetime.date(2001, 1, 1), 6.0, 7.0)], "sku string, month date, units double, revenue double")
    back = etl.unpacked(etl.packed(rows))
    key = lambda r: str(tuple(r))
    assert sorted(back.select("sku", "month", "units", "revenue").collect(), key=key) == sorted(rows.collect(), key=key)


def test_series_are_the_rows_of_the_panel(spark):
    """Gaps, null units, months after the end, a series that begins at the end, and one that begins after it."""
    day = datetime.date
    rows = [("a", day(2000, 11, 1), 1.0), ("a", day(2001, 2, 1), 2.0), ("a", day(2001, 9, 1), 9.0), ("b", END, 3.0), ("c", day(2001, 8, 1), 4.0), ("d", day(2001, 5, 1), None), ("d", day(2001, 6, 1), 5.0), (None, day(2001, 5, 1), 1.0)]
    g = spark.createDataFrame(rows, "sku string, month date, units double").withColumn("revenue", F.lit(0.0))
    expected = {"a": [1.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0], "b": [3.0], "d": [0.0, 5.0, 0.0]}
    demand = g.select(F.col("sku").alias("entity"), "month", "units", "revenue")
    for found in (panel.series(demand, END), panel.series_of(etl.packed(g), END), baselines.histories(panel.build_panel(demand, END), first=True)):
        assert {r["entity"]: r["u"] for r in found.collect()} == expected
        assert {r["entity"]: r["first"] for r in found.collect()} == {"a": day(2000, 11, 1), "b": END, "d": day(2001, 5, 1)}


def test_segments_of_series_are_those_of_rows(spark):
    rows = catalog.dense(spark, SF, "sku")
    a, b = panel.segment(rows, END), panel.segment(catalog.series(spark, SF, "sku"), END)
    assert a.dtypes == b.dtypes

    def settled(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.na.fill(-1.0, ["cv_nonzero"]).collect())

    assert settled(a) == settled(b)


@pytest.mark.parametrize("entity", ["sku", "color"])
def test_filters_on_segments_make_series_once(spark, entity):
    """A filter on DEAD is pushed down to where months are sorted: they must not be sorted again for each month or use of a series."""
    found = catalog.segments(spark, SF, entity).where("segment = 'DEAD'").select("entity")._jdf.queryExecution().optimizedPlan().toString()
    assert (found.count("array_sort("), found.count("flatten(")) == (1, 1)


def test_filters_on_segments_find_their_rows(spark):
    """Gaps, null units, sales just within and just before the last twelve months, months after the end, and a series that begins after it."""
    day = datetime.date
    rows = [("a", day(2000, 7, 1), 5.0), ("b", day(2000, 8, 1), 5.0), ("c", day(2000, 5, 1), 1.0), ("c", day(2001, 8, 1), 9.0), ("d", day(2001, 6, 1), None), ("e", day(2001, 8, 1), 4.0)]
    rows += [("f", day(1999 + k // 12, k % 12 + 1, 1), 2.0) for k in range(31)] + [(None, day(2001, 5, 1), 1.0)]
    g = spark.createDataFrame(rows, "sku string, month date, units double").withColumn("revenue", F.lit(0.0))
    demand = g.select(F.col("sku").alias("entity"), "month", "units", "revenue")
    expected = {"DEAD": ["a", "c", "d"], "INTERMITTENT": ["b"], "REGULAR": ["f"]}
    for made_by in (panel.series(demand, END), panel.series_of(etl.packed(g), END), panel.build_panel(demand, END)):
        kinds = panel.segment(made_by, END)
        for kind, skus in expected.items():
            assert sorted(r["entity"] for r in kinds.where(F.col("segment") == kind).collect()) == skus


def test_months_with_sales_beyond_sixty(spark):
    """Windows longer than a block of bits count every month once, of all children together."""
    months = [datetime.date(2001 - k // 12, 12 - k % 12, 1) for k in range(5, 125, 5)]
    demand = spark.createDataFrame([(c, m, 1.0) for c, ms in (("x", months[:15]), ("y", months[10:])) for m in ms if m <= END], "child string, month date, units double")
    kids = spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "z")], "parent string, child string")
    cfgs = [shares.Shares(window=w) for w in (6, 60, 61, 100)]
    found = {r["parent"]: r for r in shares.child_sums(demand, kids, END, cfgs).collect()}
    ago = {(2001 - m.year) * 12 + 7 - m.month for m in months if m <= END}
    for w in (6, 60, 61, 100):
        assert found["p"][f"m{w}"] == sum(a < w for a in ago) and not found["q"][f"m{w}"]


def test_folds_learn_from_as_many_partitions_as_rows_need(spark, monkeypatch):
    """Every tree runs jobs over all partitions: a small table must not have one for each of the shuffle's."""
    seen = []

    def learnt(name, rows, *args):
        seen.append(rows.rdd.getNumPartitions())
        return PipelineModel([SQLTransformer(statement="select *, lag_1 as prediction from __THIS__")])

    monkeypatch.setattr(ml, "train", learnt)
    p = catalog.dense(spark, SF, "style")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert ml.walk_forward("gbt", p, END, Folds(3, 2, 3, 24)).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 2 and max(seen) <= 4


def test_shares_are_not_broadcast(spark):
    """The size of exploded variants is guessed from the products' file."""
    assert "Broadcast" not in plan(catalog.variant_alloc(spark, SF, shares.weight_grid()))


def test_croston_is_computed_once_a_series(spark):
    """Not once an origin: the pass over the months stands below the rows of origins, and gives what each origin's own history would."""
    p = sinks.kept(catalog.segmented(spark, SF, "sku"), "sku-series")
    rows = selection.walk_forward(p, END, (Folds(3, 4, 3, 24),))
    found = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(filter(transform(u#" in found[found.rindex("Generate explode") :] and "aggregate(filter(transform(u#" not in found[: found.rindex("Generate explode")]
    cut = rows.join(p.select("entity", "first", "u"), "entity").withColumn("u", F.expr("slice(u, 1, int(months_between(origin, first)) + 1)"))
    wrong = cut.where(F.abs(F.col("croston_sba") - baselines.croston(F.col("u")) * 0.9) > 1e-12)
    assert cut.where("croston_sba > 0").count() > 100 and wrong.count() == 0
    empty = spark.createDataFrame([([],), ([0.0, 0.0],), ([0.0, 3.0, 0.0, 5.0],)], "u array<double>").select(baselines.croston_path(F.col("u")).alias("p")).collect()
    assert [len(r["p"]) for r in empty] == [0, 0, 2]


def test_versions_are_written_without_a_shuffle(spark, monkeypatch):
    """There are three horizons and a few styles: looking up their factors by a shuffle would leave all skus to as many tasks."""
    plans = {}
    monkeypatch.setattr(catalog.versions, "publish", lambda df, path, version, *args: plans.update({version: plan(df)}))
    catalog.once(catalog.published)(spark, SF)
    joins = {v: [line.split("Join")[0].split()[-1] for line in p.splitlines() if "Join" in line] for v, p in plans.items()}
    assert joins["v1"] == [] and joins["v2"] == ["BroadcastHash"] and joins["v3"][0] == "BroadcastHash"  # further down, v3 joins rows of styles


def test_demand_of_parents_is_summed_once(spark, monkeypatch):
    """However often a query asks for styles and colors, the fact is read once for them."""
    read, unpack = [], etl.unpacked
    monkeypatch.setattr(etl, "unpacked", lambda rows: read.append(1) or unpack(rows))

    @catalog.once
    def asked(spark, d):
        found = [sorted((r["entity"], r["month"], r["units"], round(r["revenue"], 4)) for r in catalog.demand(spark, d, e).collect()) for e in ("style", "color", "style")]
        return found, len(read)

    found, n = asked(spark, SF)
    expected = [sorted((r["entity"], r["month"], r["units"], round(r["revenue"], 4)) for r in catalog.demand(spark, SF, e).collect()) for e in ("style", "color")]
    assert n == 1 and found == [*expected, expected[0]] and len(expected[1]) > len(expected[0]) > 0


def test_version_table_against_plain_sums(spark):
    """Skus without color or style count for skus only, and errors cancel out within a color or style but not within skus; sums of skus aren't shuffled."""
    day = datetime.date(2001, 8, 1)
    skus = {"a": ("x|1", "x"), "b": ("x|1", "x"), "c": ("x|2", "x"), "d": (None, None), "e": ("y", None)}
    rows = [(v, s, day, step, 10.0 * (k + 1), 10.0 * (k + 1) + (-1) ** k * (k + step + len(v)), *skus[s]) for v in ("v1", "v22") for k, s in enumerate(skus) for step in (1, 2) if (v, s) != ("v22", "b")]
    rows.append(("v1", "a", day, 2, 5.0, 1.0, *skus["a"]))  # a sku's second row is summed with its first
    df = spark.createDataFrame(rows, "version string, sku string, month date, step int, actual double, predicted double, color string, style string").repartition("sku", "month")
    table = score.version_table(df)
    assert len(re.findall(r"hashpartitioning\([^)]*sku#", table._jdf.queryExecution().executedPlan().toString())) == 1
    expected = {}
    for level, at in (("sku", 1), ("color", 6), ("style", 7)):
        for v in ("v1", "v22"):
            for step in (1, 2):
                sums = {}
                for r in rows:
                    if (r[0], r[3]) == (v, step) and r[at] is not None:
                        a, p = sums.get(r[at], (0.0, 0.0))
                        sums[r[at]] = (a + r[4], p + r[5])
                total = sum(a for a, _ in sums.values())
                expected[v, level, step] = (total, sum(p for _, p in sums.values()), sum(abs(a - p) for a, p in sums.values()) * 100 / total)
    found = {(r["version"], r["level"], r["step"]): r for r in table.collect()}
    assert set(found) == set(expected)
    for (v, level, step), values in expected.items():
        r = found[v, level, step]
        assert (r["actual"], r["predicted"], r["wmape"], r["delta"]) == pytest.approx((*values, values[2] - expected["v1", level, step][2]))
    products = spark.createDataFrame([(s, *skus[s]) for s in skus], "sku string, color string, style string")
    joined = score.version_table(df.drop("color", "style"), products)
    assert sorted(map(tuple, joined.select("version", "level", "step", F.round("wmape", 9)).collect())) == sorted(map(tuple, table.select("version", "level", "step", F.round("wmape", 9)).collect()))
