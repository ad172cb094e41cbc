"""Learnt models: codes of categories, saved pipelines, the recursion and its corrections, folds, and the choice."""

import math
import random
from datetime import date

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from weftline.config import CAUTIOUS, Adjustments, Folds
from weftline.operators import baselines, ml, panel, selection


def months(n, start=(2020, 1)):
    y, m = start
    return [date(y + (m - 1 + k) // 12, (m - 1 + k) % 12 + 1, 1) for k in range(n)]


def panel_of(spark, series):
    rows = [(e, m, float(u), 0.0) for e, units in series.items() for m, u in zip(months(len(units)), units)]
    return spark.createDataFrame(rows, "entity string, month date, units double, revenue double")


def formula(text):
    return PipelineModel([SQLTransformer(statement=f"select *, {text} as prediction from __THIS__")])


def plain_recursion(units, predict, horizon, cfg):
    """The same by a loop over one list: reports are capped predictions, what is fed back is something else."""
    fed, reported, guard = list(units), [], 0.15 if horizon == 3 else 0.25
    previous = fed[-1] if fed else None
    for step in range(horizon):
        value = max(0.0, predict(fed))
        if previous is not None and previous > 0:
            value = min(value, previous * (1 + guard))
        reported.append(value)
        previous = value
        mean = sum(fed[-3:]) / len(fed[-3:]) if fed else 0.0
        fed.append(max(0.0, cfg.recursive_alpha * value + (1 - cfg.recursive_alpha) * mean) if step and mean > 0 else value)
    return reported


def plain_corrections(units, said, segment, cfg, learnt=True):
    n, out = len(units), []
    mean_3 = sum(units[-3:]) / len(units[-3:])
    cap = max(cfg.cap_multiple * sum(units[-12:]) / 12, 3 * next((u for u in reversed(units) if u > 0), 0.0), 1.0)
    for step, value in enumerate(said, 1):
        past = [units[n + step - 1 - k] for k in (12, 24, 36) if n + step - 1 - k >= 0]
        seasonal = sum(past) / len(past) if past else 0.0
        if learnt and abs(value - seasonal) / max(1.0, seasonal) > cfg.blend_threshold:
            value = max(0.0, cfg.blend_weight * value + (1 - cfg.blend_weight) * seasonal)
        if segment == "INTERMITTENT":
            value = min(value, cap)
        if segment != "DEAD" and mean_3 > 0 and value > cfg.shrink_threshold * mean_3:
            value = cfg.shrink_weight * value + (1 - cfg.shrink_weight) * mean_3
        out.append(value)
    return out


SERIES = {
    "grows": [10 * 1.3**k for k in range(30)],
    "quiet": [0.0] * 25 + [4.0, 0.0, 0.0, 0.0],
    "stops": [8.0] * 20 + [0.0] * 4,
    "short": [5.0, 7.0],
    "waves": [20 + 15 * math.sin(k / 2) for k in range(50)],
    "faint": [0.0] * 20 + [0.5, 0.0, 0.0, 0.0],
    "spiky": [0, 0, 9, 0, 0, 0, 30, 0, 0, 1, 0, 0, 0, 0, 50, 0],
}


@pytest.mark.parametrize("cfg", [Adjustments(), CAUTIOUS, Adjustments(recursive_alpha=1.0)])
@pytest.mark.parametrize("horizon", [1, 3, 12])
def test_recursion_against_a_loop(spark, cfg, horizon):
    series = {e: [float(u) for u in s] for e, s in SERIES.items()}
    model = formula("0.9 * lag_1 + 0.6 * lag_2 - 1")
    found = {}
    for r in ml.recursion(model, ml.state(panel_of(spark, series)), horizon, cfg=cfg).collect():
        found.setdefault(r["entity"], {})[r["step"]] = (r["units"], r["trail"])
    for entity, units in series.items():
        expected = plain_recursion(units, lambda u: 0.9 * u[-1] + 0.6 * (u[-2] if len(u) > 1 else 0.0) - 1, horizon, cfg)
        assert [found[entity][s][0] for s in range(1, horizon + 1)] == pytest.approx(expected), entity
    if horizon == 3:
        assert [t["rule"] for t in found["grows"][1][1]] == ["guardrail"]  # 1.3 and 1.15 of the last month
        assert [t["rule"] for t in found["grows"][3][1]] == ([] if cfg.recursive_alpha == 1 else ["feedback"]) or found["grows"][3][1][0]["rule"] == "guardrail"


@pytest.mark.parametrize("cfg", [Adjustments(), CAUTIOUS])
def test_recursion_then_blend_cap_and_shrinkage(spark, cfg):
    series = {e: [float(u) for u in s] for e, s in SERIES.items()}
    p = panel_of(spark, series)
    kinds = spark.createDataFrame([(e, {"quiet": "INTERMITTENT", "faint": "INTERMITTENT", "spiky": "INTERMITTENT", "stops": "DEAD"}.get(e, "REGULAR")) for e in series], "entity string, segment string")
    best = spark.createDataFrame([(s, "rule") for s in ("REGULAR", "INTERMITTENT", "DEAD")], "segment string, best_model string")
    out = ml.dispatched(baselines.forecast(p, date(2024, 2, 1), 3), ml.state(p), kinds, best, {"rule": formula("1.6 * lag_1 + 3")}, 3, cfg)
    found = {(r["entity"], r["step"]): r for r in out.collect()}
    assert len(found) == 3 * len(series)
    for r in kinds.collect():
        units = series[r["entity"]]
        said = plain_recursion(units, lambda u: 1.6 * u[-1] + 3, 3, cfg)
        expected = plain_corrections(units, said, r["segment"], cfg)
        assert [found[r["entity"], s]["units"] for s in (1, 2, 3)] == pytest.approx(expected), r["entity"]
        for s in (1, 2, 3):
            row = found[r["entity"], s]
            assert (row["lower"], row["upper"]) == pytest.approx((0.8 * row["units"], 1.2 * row["units"]))
            corrections = [t for t in row["trail"] if t["rule"] != "feedback"]
            assert all(a["after"] == b["before"] for a, b in zip(corrections, corrections[1:])) and (not corrections or corrections[-1]["after"] == row["units"])
    trail = baselines.trail_of(out).where("entity = 'spiky'").orderBy("step", "place").collect()
    assert {"blend", "cap"} <= {t["rule"] for t in baselines.trail_of(out).collect()} and all(t["place"] >= 1 for t in trail)


def test_without_settings_nothing_is_corrected(spark):
    series = {"a": [1.0] * 20 + [50.0]}
    p = panel_of(spark, series)
    kinds = spark.createDataFrame([("a", "INTERMITTENT")], "entity string, segment string")
    best = spark.createDataFrame([("INTERMITTENT", "gone"), ("REGULAR", "ma_3")], "segment string, best_model string")
    rows = ml.dispatched(baselines.forecast(p, date(2021, 9, 1), 3), ml.state(p), kinds, best, {}, 3, None).collect()
    assert {r["model"] for r in rows} == {"seasonal_naive"} and [r["units"] for r in rows] == [1.0] * 3 and not any(r["trail"] for r in rows)


def test_inputs_of_a_short_history(spark):
    h = ml.state(panel_of(spark, {"a": [2.0, 4.0]}))
    row = h.select(*(c.alias(k) for k, c in ml.inputs().items())).first().asDict()
    assert (row["lag_1"], row["lag_2"], row["lag_3"], row["lag_24"]) == (4, 2, 0, 0)
    assert (row["mean_3"], row["mean_6"], row["mean_12"], row["yoy_growth"], row["momentum_3"]) == (3, 0, 0, 0, 0)  # fewer than half a window is no window
    assert (row["month_of_year"], row["quarter"], row["year"], row["trend"]) == (3, 1, 2020, 2)


def test_inputs_look_only_back(spark):
    h = ml.state(panel_of(spark, {"a": [float(k * k % 17) for k in range(40)]}))
    rows = {r["month"]: r.asDict() for r in ml.training_rows(h, 3).collect()}
    cut = ml.state(panel_of(spark, {"a": [float(k * k % 17) for k in range(30)]}))
    for r in ml.training_rows(cut, 3).collect():
        assert rows[r["month"]] == r.asDict()
    assert min(rows) == date(2021, 1, 1)  # twelve months are the longest required lag


def test_codes_travel_with_the_model(spark, tmp_path):
    rng = random.Random(4)
    series = {f"e{k}": [float(rng.randint(1, 5) + (40 if k % 2 else 0)) for _ in range(20)] for k in range(12)}
    attributes = spark.createDataFrame([(f"e{k}", "loud" if k % 2 else None, f"b{k % 3}") for k in range(12)], "entity string, style string, brand string")
    h = ml.state(panel_of(spark, series), attributes)
    assert {r["style"] for r in h.select("style").distinct().collect()} == {"loud", "UNKNOWN"}
    assert ml.input_names(3, ("style", "brand"))[-2:] == ["style_enc", "brand_enc"]
    model = ml.train("gbt", ml.training_rows(h, 1), 1, ("style", "brand"), iterations=3)
    paths = ml.save_models({("gbt", 1): model}, str(tmp_path))
    again = ml.load_models(paths | {("gbt", 3): "nowhere"}, 1)["gbt"]
    seen = h.withColumns(ml.inputs()).unionByName(h.where("entity = 'e1'").withColumns({"style": F.lit("new"), "brand": F.lit("b1")}).withColumns(ml.inputs()))
    out = again.transform(seen).collect()
    assert {(r["style"], r["style_enc"]) for r in out} == {("UNKNOWN", 0.0), ("loud", 1.0), ("new", -1.0)}
    assert {(r["brand"], r["brand_enc"]) for r in out} == {("b0", 0.0), ("b1", 1.0), ("b2", 2.0)}
    assert [r["prediction"] for r in out] == [r["prediction"] for r in model.transform(seen).collect()]


def trend_panel(spark):
    """Series whose next month doubles what a season ago was like: seasonal formulas are wrong, trees that see the last month are not."""
    rng = random.Random(9)
    return panel_of(spark, {f"e{k}": [float(20 + 4 * j + 3 * k + rng.randint(0, 3)) for j in range(48)] for k in range(12)})


def test_trees_win_and_are_dispatched(spark, tmp_path):
    p, end = trend_panel(spark), date(2023, 12, 1)
    kinds = panel.segment(p, end)
    assert {r["segment"] for r in kinds.collect()} == {"REGULAR"}
    attributes = spark.createDataFrame([(f"e{k}", f"s{k % 2}") for k in range(12)], "entity string, style string")
    folds = Folds(3, 2, 3, 24)
    more = ml.walk_forward("gbt", p, end, folds, attributes, iterations=8)
    assert more.columns == ["entity", "fold", "origin", "month", "step", "actual", "horizon", "model", "predicted"] and more.count() == 12 * 2 * 3
    metrics = selection.cv_metrics(p, kinds, end, (folds,), more=more)
    assert {r["model"] for r in metrics.collect()} == {"gbt", "seasonal_naive", "seasonal_avg3y"}
    best = selection.best_models(metrics)
    assert [(r["segment"], r["best_model"]) for r in best.collect()] == [("REGULAR", "gbt")]
    out = ml.run(p, kinds, best, attributes, end, 3, str(tmp_path), iterations=8).collect()
    assert len(out) == 36 and {r["model"] for r in out} == {"gbt"} and (tmp_path / "gbt_h3").is_dir()
    assert all(abs(r["units"] - (20 + 4 * (47 + r["step"]) + 3 * int(r["entity"][1:]))) < 60 for r in out)


def test_learnt_rows_count_only_where_asked_for(spark):
    p, end = trend_panel(spark), date(2023, 12, 1)
    folds = Folds(3, 1, 3, 24)
    more = selection.walk_forward(p, end, folds).select("entity", "fold", "origin", "month", "step", "actual", "horizon", F.lit("gbt").alias("model"), F.col("actual").alias("predicted"))
    for segment, models in (("REGULAR", {"gbt", "seasonal_naive", "seasonal_avg3y"}), ("INTERMITTENT", {"croston_sba", "seasonal_avg3y"})):
        kinds = p.select("entity").distinct().withColumn("segment", F.lit(segment))
        assert {r["model"] for r in selection.cv_metrics(p, kinds, end, (folds,), more=more).collect()} == models


def test_folds_know_nothing_after_their_origin(spark):
    """Changing what came after the last origin changes no prediction."""
    p, end = trend_panel(spark), date(2023, 12, 1)
    folds = Folds(1, 1, 1, 24)
    later = p.withColumn("units", F.when(F.col("month") > date(2023, 11, 1), 999.0).otherwise(F.col("units")))
    a, b = ({r["entity"]: r["predicted"] for r in ml.walk_forward("random_forest", x, end, folds, iterations=5).collect()} for x in (p, later))
    assert a == b and len(a) == 12


def test_walk_forward_of_all_horizons_at_once(spark):
    p, end = panel_of(spark, {"a": [float(k % 12 + k // 12) for k in range(60)], "young": [1.0] * 5}), date(2024, 12, 1)
    both = selection.walk_forward(p, end, (Folds(1, 2, 3, 24), Folds(3, 2, 3, 24)))
    rows = {(r["horizon"], r["origin"], r["step"]): r for r in both.collect()}
    assert set(rows) == {(1, date(2024, 8, 1), 1), (1, date(2024, 11, 1), 1)} | {(3, o, s) for o in (date(2024, 6, 1), date(2024, 9, 1)) for s in (1, 2, 3)}
    r = rows[3, date(2024, 6, 1), 3]
    assert (r["month"], r["actual"], r["seasonal_naive"], r["seasonal_avg3y"], r["ma_3"]) == (date(2024, 9, 1), 12.0, 11.0, 10.0, 8.0)
