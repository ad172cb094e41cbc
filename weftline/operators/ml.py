"""Global panel regressors from MLlib: coded categories, saved models, folds learnt side by side, and recursive forecasts."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.config import HISTORY, INPUTS, Adjustments, Features, Folds
from weftline.functions import let
from weftline.operators import baselines
from weftline.operators.selection import origins
from weftline.sources.sinks import kept

TREES = {"gbt": 100, "random_forest": 300}
UNKNOWN = "UNKNOWN"
AT_ONCE = 4  # models that are learnt side by side


def input_names(horizon: int, categories: Iterable[str] = ()) -> list[str]:
    """What a model of the horizon sees."""
    return [*INPUTS[horizon], *(f"{c}_enc" for c in categories)]


def codes(rows: DataFrame, categories: tuple[str, ...]) -> list[Transformer]:
    """Stages that add `<category>_enc`: the place among the sorted values of the learnt rows, -1 for any other value.

    The values are those of product attributes, a few at a dimension row; they become part of the fitted pipeline and travel with it.
    """
    if not categories:
        return []
    raw = [f"_{c}_place" for c in categories]
    indexer = StringIndexer(inputCols=list(categories), outputCols=raw, handleInvalid="keep", stringOrderType="alphabetAsc").fit(rows)
    each = ", ".join(f"if({r} < {len(known)}, {r}, -1D) as {c}_enc" for c, r, known in zip(categories, raw, indexer.labelsArray))
    return [indexer, SQLTransformer(statement=f"select *, {each} from __THIS__")]


def learner(name: str, iterations: int | None = None, seed: int = 42) -> GBTRegressor | RandomForestRegressor:
    """iterations: trees, TREES unless given."""
    n = iterations or TREES.get(name)
    common = {"featuresCol": "features", "labelCol": "label", "seed": seed}
    if name == "gbt":
        return GBTRegressor(maxIter=n, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, **common)
    if name == "random_forest":
        return RandomForestRegressor(numTrees=n, maxDepth=10, minInstancesPerNode=5, **common)
    raise ValueError(f"unknown model {name}")


def train(name: str, rows: DataFrame, horizon: int = 1, categories: tuple[str, ...] = (), iterations: int | None = None) -> PipelineModel:
    """A model of `label` on the horizon's inputs and the codes of the categories."""
    assembler = VectorAssembler(inputCols=input_names(horizon, categories), outputCol="features")
    return Pipeline(stages=[*codes(rows, categories), assembler, learner(name, iterations)]).fit(rows)


def state(panel: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """(entity, u, first, attributes): the whole dense history of each entity as an array; its length is bounded by the calendar.

    attributes: entity (unique) and the columns that models take as categories, UNKNOWN where there is none.
    """
    out = baselines.histories(panel, first=True).drop("segment")
    if attributes is None:
        return out
    names = [c for c in attributes.columns if c != "entity"]
    return out.join(attributes, "entity", "left").na.fill(UNKNOWN, names)


def inputs(at: str = "size(u)", cfg: Features = Features()) -> dict[str, Column]:
    """Features of the month at place `at` of u from those before it; 0 where history is too short for them."""

    def lag(k: int) -> str:
        return f"coalesce(if({at} - {k} >= 0, get(u, int({at} - {k})), 0D), 0D)"

    out = {f"lag_{k}": F.expr(lag(k)) for k in cfg.lags}
    for n in cfg.windows:
        part = f"slice(u, greatest(1, int({at}) - {n} + 1), least({n}, int({at})))"
        total, squares = f"aggregate({part}, 0D, (a, x) -> a + x)", f"aggregate({part}, 0D, (a, x) -> a + x * x)"
        enough = f"{at} >= {max(1, n // 2)}"
        out[f"mean_{n}"] = F.expr(f"if({enough}, {total} / size({part}), 0D)")
        out[f"std_{n}"] = F.expr(f"if({enough} and {at} > 1, sqrt(greatest(0D, ({squares} - {total} * {total} / size({part})) / (size({part}) - 1))), 0D)")
    month = f"add_months(first, int({at}))"
    return out | {
        "trend": F.expr(f"double({at})"),
        "momentum_3": F.expr(f"if({at} >= 3, least(greatest(({lag(1)} - {lag(3)}) / ({lag(3)} + 1), -{cfg.momentum_clip}D), {cfg.momentum_clip}D), 0D)"),
        "yoy_growth": F.expr(f"if({at} >= 24 and {lag(24)} <> 0, least(greatest({lag(12)} / {lag(24)}, {cfg.growth_low}D), {cfg.growth_high}D), 0D)"),
        "month_sin": F.expr(f"sin(month({month}) * pi() / 6)"),
        "month_cos": F.expr(f"cos(month({month}) * pi() / 6)"),
        "month_of_year": F.expr(f"double(month({month}))"),
        "quarter": F.expr(f"double(quarter({month}))"),
        "year": F.expr(f"double(year({month}))"),
    }


def training_rows(histories: DataFrame, horizon: int = 3) -> DataFrame:
    """(entity, month, label, inputs, attributes): a row a month that has the horizon's longest required lag."""
    attributes = [c for c in histories.columns if c not in ("entity", "u", "first")]
    least = HISTORY[horizon]
    each = histories.where(F.size("u") > least).withColumn("place", F.explode(F.expr(f"sequence({least}, size(u) - 1)")))
    return each.select("entity", F.expr("add_months(first, place)").alias("month"), F.expr("u[place]").alias("label"), *attributes, *(c.alias(k) for k, c in inputs("place").items()))


def save_models(models: dict[tuple[str, int], PipelineModel], folder: str) -> dict[tuple[str, int], str]:
    """Write fitted pipelines by model and horizon; returns their paths."""
    paths = {(name, horizon): f"{folder}/{name}_h{horizon}" for name, horizon in models}
    for key, model in models.items():
        model.write().overwrite().save(paths[key])
    return paths


def load_models(paths: dict[tuple[str, int], str], horizon: int) -> dict[str, PipelineModel]:
    """The saved pipelines of a horizon by name."""
    return {name: PipelineModel.load(path) for (name, h), path in paths.items() if h == horizon}


def growth_limit(horizon: int) -> float:
    """How much more than the month before a step may be, as a share."""
    return 0.15 if horizon == 3 else 0.25


def recursion(model: Transformer, histories: DataFrame, horizon: int, steps: int | None = None, cfg: Adjustments = Adjustments()) -> DataFrame:
    """(entity, step, units, trail). Each step is one narrow transformation of every series' state.

    A prediction is never negative and grows by no more than growth_limit() over what was reported for the month before (the last
    actual at first), if that sold; so it is reported. What later steps see is another value: from the second step on the report is mixed with the mean of the
    last three months, if that isn't 0. Reports and the history that is fed are apart in the state. The trail tells which of the two rules changed a value.
    """
    steps = steps or horizon
    own = histories.columns
    none = F.array().cast("array<double>")
    now = histories.withColumns({"_reported": none, "_trails": F.array().cast(f"array<{baselines.TRAIL}>")})
    for step in range(1, steps + 1):
        predicted = model.transform(now.withColumns(inputs())).select(*own, "_reported", "_trails", F.greatest("prediction", F.lit(0.0)).alias("_raw"))
        previous = F.coalesce(F.try_element_at("_reported", F.lit(-1)), F.try_element_at("u", F.lit(-1)))
        mean_3 = F.expr("if(size(u) > 0, aggregate(slice(u, -least(3, size(u)), least(3, size(u))), 0D, (a, x) -> a + x) / least(3, size(u)), 0D)")

        def limited(raw: Column, before: Column) -> Column:
            return F.when(before > 0, F.least(raw, before * (1 + growth_limit(horizon)))).otherwise(raw)

        def fed(units: Column, mean: Column, first: bool = step == 1) -> Column:
            mixed = F.greatest(F.lit(0.0), cfg.recursive_alpha * units + (1 - cfg.recursive_alpha) * mean)
            return units if first else F.when(mean > 0, mixed).otherwise(units)

        path = let(F.col("_raw"), lambda raw: let(let(previous, lambda p: limited(raw, p)), lambda units: let(mean_3, lambda m: F.array(raw, units, fed(units, m)))))
        predicted = predicted.withColumn("_path", path)
        raw, units, back = (F.get("_path", F.lit(k)) for k in range(3))
        entries = [F.struct(F.lit(rule).alias("rule"), a.alias("before"), b.alias("after")) for rule, a, b in (("guardrail", raw, units), ("feedback", units, back))]
        trail = F.filter(F.array(*entries), lambda e: e["before"] != e["after"]).cast(baselines.TRAIL)
        now = predicted.withColumns({"_reported": F.concat("_reported", F.array(units)), "_trails": F.concat("_trails", F.array(trail)), "u": F.concat("u", F.array(back))}).select(*own, "_reported", "_trails")
    each = now.select("entity", F.posexplode(F.arrays_zip(F.col("_reported").alias("units"), F.col("_trails").alias("trail"))).alias("place", "r"))
    return each.select("entity", (F.col("place") + 1).alias("step"), "r.units", "r.trail")


def recursive_forecast(model: Transformer, histories: DataFrame, end: date, steps: int, cfg: Adjustments = Adjustments()) -> DataFrame:
    """(entity, month, step, units, lower, upper) as the recursion reports them, without further corrections."""
    rows = recursion(model, histories, steps, cfg=cfg).withColumn("month", F.add_months(F.lit(end), F.col("step")))
    return baselines.bounded(rows.withColumn("units", F.round("units", 4))).select("entity", "month", "step", "units", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"))


def dispatched(forecasts: DataFrame, histories: DataFrame, segments: DataFrame, best: DataFrame, models: dict[str, Transformer], horizon: int, cfg: Adjustments | None = Adjustments()) -> DataFrame:
    """Each series' forecast by the model chosen for its segment, formulas and learnt models alike, with bounds and a trail.

    A branch a learnt model, with only the series that take it; the branches are united and corrected together. A chosen model that isn't at hand gives
    way to the seasonal naive. forecasts: baselines.forecast(); histories: state(); models: fitted pipelines by name. Without settings the corrections
    after the model are left out (the recursion's own stay).
    """
    rows = baselines.chosen(forecasts, segments, best, models)
    none = F.array().cast(baselines.TRAIL)
    out = baselines.by_formula(rows.where(~F.col("model").isin(*models))).withColumns({"learnt": F.lit(False), "trail": none})
    steps = horizon
    for name, model in models.items():
        own = rows.where((F.col("model") == name) & (F.col("step") <= steps))
        said = recursion(model, histories.join(own.select("entity").distinct(), "entity", "left_semi"), horizon, steps, cfg or Adjustments())
        out = out.unionByName(own.join(said, ["entity", "step"]).withColumn("learnt", F.lit(True)))
    return baselines.bounded(out if cfg is None else baselines.adjusted(out, cfg))


def walk_forward(name: str, panel: DataFrame, end: date, folds: Folds, attributes: DataFrame | None = None, iterations: int | None = None) -> DataFrame:
    """(entity, fold, origin, month, step, actual, horizon, model, predicted): a model of each fold, learnt from what was known at its origin.

    Features look only back, so one table of them serves all origins, each of which learns from its months; it is written, so that it has as many
    partitions as its size asks for (every job of a tree runs over all of them), and stays in memory while the folds learn, at most AT_ONCE at a time, in threads of this session. Forecasts feed on themselves as in production, and never see a month after their origin.
    """
    categories = tuple(c for c in attributes.columns if c != "entity") if attributes is not None else ()
    whole = state(panel, attributes)
    rows = kept(training_rows(whole, folds.horizon), "training").persist()
    starts = list(enumerate(origins(end, folds), 1))

    def learn(origin: date) -> PipelineModel:
        return train(name, rows.where(F.col("month") <= F.lit(origin)), folds.horizon, categories, iterations)

    try:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            models = list(pool.map(inheritable_thread_target(panel.sparkSession)(learn), [origin for _, origin in starts]))
    finally:
        rows.unpersist()
    parts = []
    for (fold, origin), model in zip(starts, models):
        age = f"(year(date'{origin}') - year(first)) * 12 + month(date'{origin}') - month(first) + 1"
        known = whole.withColumn("_age", F.expr(age)).where((F.col("_age") >= folds.least) & (F.col("_age") < F.size("u")))
        ahead = recursion(model, known.withColumn("u", F.expr("slice(u, 1, _age)")).drop("_age"), folds.horizon)
        parts.append(ahead.select("entity", "step", F.lit(fold).alias("fold"), F.lit(origin).alias("origin"), F.col("units").alias("predicted")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("month", F.expr("add_months(origin, step)")).join(panel.select("entity", "month", F.col("units").alias("actual")), ["entity", "month"])
    return out.select("entity", "fold", "origin", "month", "step", "actual", F.lit(folds.horizon).alias("horizon"), F.lit(name).alias("model"), "predicted")


def run(panel: DataFrame, segments: DataFrame, best: DataFrame, attributes: DataFrame, end: date, horizon: int, folder: str, cfg: Adjustments | None = Adjustments(), iterations: int | None = None) -> DataFrame:
    """Learn and save those global models that were chosen for a segment, load them again and forecast with them: dispatched() rows.

    Each learns from its segment's series up to `end`. best: segment, horizon, best_model (a row a segment: the only rows that come to the driver).
    """
    categories = tuple(c for c in attributes.columns if c != "entity")
    whole = state(panel, attributes)
    wanted = best.where(F.col("horizon") == horizon)
    paths = {}
    for row in wanted.where(F.col("best_model").isin(*TREES)).select("segment", "best_model").collect():
        own = segments.where(F.col("segment") == row["segment"]).select("entity")
        rows = kept(training_rows(whole.join(own, "entity", "left_semi"), horizon), "training")
        paths |= save_models({(row["best_model"], horizon): train(row["best_model"], rows, horizon, categories, iterations)}, folder)
    models = load_models(paths, horizon)
    return dispatched(baselines.forecast(panel, end, horizon), whole, segments, wanted, models, horizon, cfg)
