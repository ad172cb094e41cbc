"""Dense monthly panels, demand segments, and the features of a month's history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import Features, Segments
from weftline.functions import clipped, ratio
from weftline.operators.ranking import placed
from weftline.sources.versions import unique


def demand_by(gold: DataFrame, products: DataFrame, entity: str) -> DataFrame:
    """Units and revenue by entity (sku, color or style) and month; rows without the entity stand alone and are left out."""
    if entity == "sku":
        return gold.select(F.col("sku").alias("entity"), "month", "units", "revenue")
    if entity in gold.columns:  # the fact knows it already
        mapped = gold.withColumn("entity", F.col(entity)).where("entity is not null")
    else:
        mapped = gold.join(products.select("sku", F.col(entity).alias("entity")), "sku").where("entity is not null")
    return mapped.groupBy("entity", "month").agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))


def series(demand: DataFrame, end: date, measures: tuple[str, ...] = ("units",)) -> DataFrame:
    """(entity, first, u and other measures): every month from an entity's first sale to `end` as an array, zero where it sold nothing.

    One grouping by entity: the months without sales are filled in between its sales, never joined, so only sales are shuffled. The calendar
    bounds an array. `u` are the units.
    """
    known = demand.where((F.col("month") <= F.lit(end)) & F.col("entity").isNotNull()).repartition("entity")  # both groupings are within an entity
    known = known.groupBy("entity", F.trunc("month", "MM").alias("month")).agg(*(F.sum(m).alias(m) for m in measures))
    at = (F.year("month") * 12 + F.month("month")).alias("at")
    sold = known.groupBy("entity").agg(F.min("month").alias("first"), F.array_sort(F.collect_list(F.struct(at, *measures))).alias("_sold"))
    return _filled(sold, end, measures)


def series_of(facts: DataFrame, end: date) -> DataFrame:
    """series() by sku of etl.packed() rows: nothing is shuffled."""
    each = F.expr(f"array_sort(filter(transform(months, (m, i) -> struct(year(m) * 12 + month(m) as at, get(units, i) as units, m as month)), x -> x.month <= date'{end}'))")
    known = facts.where(F.col("sku").isNotNull() & F.expr(f"coalesce(array_min(months) <= date'{end}', false)"))
    sold = known.select(F.col("sku").alias("entity"), each.alias("_sold"))
    return _filled(sold.withColumn("first", F.expr("_sold[0].month")), end, ("units",))


def _filled(sold: DataFrame, end: date, measures: tuple[str, ...]) -> DataFrame:
    def dense(measure: str) -> Column:
        gap = "if(i = 0, 0, x.at - get(s, i - 1).at - 1)"
        months = f"transform(s, (x, i) -> concat(array_repeat(0D, {gap}), array(coalesce(double(x.{measure}), 0D))))"
        return F.expr(_let("_sold", "s", f"concat(flatten({months}), array_repeat(0D, {end.year * 12 + end.month} - element_at(s, -1).at))"))

    return sold.select("entity", "first", *(dense(m).alias("u" if m == "units" else m) for m in measures))


def _let(value: str, name: str, use: str) -> str:
    """functions.let() as text. A filter on what follows from a series is pushed down to where the series is made: each mention of it is one more making."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def build_panel(demand: DataFrame, end: date) -> DataFrame:
    """The rows of series(): entity, month, units and revenue of every month."""
    each = series(demand, end, ("units", "revenue")).select("entity", "first", "revenue", F.posexplode("u").alias("_place", "units"))
    return each.select("entity", F.add_months("first", F.col("_place")).alias("month"), "units", F.get("revenue", "_place").alias("revenue"))


def with_products(panel: DataFrame, products: DataFrame) -> DataFrame:
    """A sku panel with its product attributes, UNKNOWN where there is none; a sku that the products have twice makes reading fail instead of doubling its rows."""
    attributes = ["style", "color", "size"]
    joined = panel.join(unique(products.select(F.col("sku").alias("entity"), *attributes), "entity"), "entity", "left")
    return joined.na.fill("UNKNOWN", attributes)


def filled(rows: DataFrame, products: DataFrame, attributes: list[str]) -> DataFrame:
    """Rows of skus whose missing attributes come from the products, and are UNKNOWN where those lack them too."""
    known = products.select("sku", *(F.col(a).alias(f"_{a}") for a in attributes))
    joined = rows.join(known, "sku", "left")
    return joined.withColumns({a: F.coalesce(a, f"_{a}", F.lit("UNKNOWN")) for a in attributes}).drop(*(f"_{a}" for a in attributes))


def coerced(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a month, an entity and units of the right type, one row with the number of the others)."""
    typed = raw.select(F.col("entity").cast("string").alias("entity"), F.try_to_timestamp(F.col("month").cast("string")).cast("date").alias("month"), F.expr("try_cast(units as double)").alias("units"))
    bad = F.col("entity").isNull() | F.col("month").isNull() | F.col("units").isNull()
    return typed.where(~bad), typed.agg(F.count_if(bad).alias("n_dropped"))


def with_calendar(panel: DataFrame, months: DataFrame) -> DataFrame:
    joined = panel.join(F.broadcast(months), "month", "left")  # one row a month
    return joined.withColumns({"year": F.coalesce("year", F.year("month")), "quarter": F.coalesce("quarter", F.quarter("month")), "month_of_year": F.coalesce("month_of_year", F.month("month"))})


def segment(panel: DataFrame, end: date, rules: Segments = Segments()) -> DataFrame:
    """DEAD, INTERMITTENT or REGULAR, with the measures it follows from. panel: rows of build_panel(), or series() up to `end`, which need no grouping."""
    if "u" in panel.columns:
        return segmented(panel, end, rules).drop("u", "first")
    sold = F.when(F.col("units") > 0, F.col("units"))
    recent = F.col("month") > F.add_months(F.lit(end), -rules.trailing_months)
    measured = panel.groupBy("entity").agg(
        F.avg((F.col("units") == 0).cast("double")).alias("zero_ratio"),
        F.when(F.count(sold) > 1, F.stddev_pop(sold) / F.avg(sold)).alias("cv_nonzero"),
        F.sum(F.when(recent, F.col("units")).otherwise(0.0)).alias("trailing_sum"),
        F.count(sold).alias("active_months"),
        F.count("*").alias("total_months"),
        F.min("month").alias("first_sale"),
        F.max("month").alias("last_sale"),
    )
    return measured.withColumn("segment", _kind(rules))


def _kind(rules: Segments) -> Column:
    selling = F.when(F.col("zero_ratio") >= rules.zero_ratio, "INTERMITTENT").otherwise("REGULAR")  # nested: a filter on DEAD asks for the sum alone
    return F.when(F.col("trailing_sum") == 0, "DEAD").otherwise(selling)


def segmented(rows: DataFrame, end: date, rules: Segments = Segments()) -> DataFrame:
    """series() up to `end` with their segments and what those follow from, measured within the row."""
    n = rules.trailing_months
    out = rows.withColumn("_sold", F.expr("filter(u, x -> x > 0)"))
    out = out.withColumn("_mean", F.expr("if(size(_sold) > 0, aggregate(_sold, 0D, (a, x) -> a + x) / size(_sold), 0D)"))
    out = out.select(
        "entity",
        "first",
        "u",
        F.expr(_let("u", "v", "size(filter(v, x -> x = 0)) / size(v)")).alias("zero_ratio"),
        F.expr("if(size(_sold) > 1, sqrt(aggregate(_sold, 0D, (a, x) -> a + (x - _mean) * (x - _mean)) / size(_sold)) / _mean, null)").alias("cv_nonzero"),
        F.expr(_let("u", "v", f"aggregate(slice(v, -least({n}, size(v)), least({n}, size(v))), 0D, (a, x) -> a + x)")).alias("trailing_sum"),
        F.expr("bigint(size(_sold))").alias("active_months"),
        F.expr("bigint(size(u))").alias("total_months"),
        F.col("first").alias("first_sale"),
        F.lit(end).alias("last_sale"),
    )
    return out.withColumn("segment", _kind(rules))


def parentless(gold: DataFrame, products: DataFrame, parent: str = "color") -> DataFrame:
    """Rows of skus that have no parent to be allocated from."""
    return gold.join(products.where(F.col(parent).isNotNull()).select("sku"), "sku", "left_anti")


def standalone(gold: DataFrame, products: DataFrame, parent: str = "color") -> DataFrame:
    """Skus that sold but have no parent to be allocated from."""
    return parentless(gold.select("sku").distinct(), products, parent)


def features(panel: DataFrame, cfg: Features = Features()) -> DataFrame:
    """Lags, rolling statistics before the month, trend, momentum, growth and calendar waves: one window pass."""
    w = Window.partitionBy("entity").orderBy("month")
    columns = {f"lag_{k}": F.lag("units", k).over(w) for k in cfg.lags}
    for n in cfg.windows:
        before = w.rowsBetween(-n, -1)
        enough = F.count("units").over(before) >= max(1, n // 2)
        columns[f"rolling_mean_{n}"] = F.when(enough, F.avg("units").over(before))
        columns[f"rolling_std_{n}"] = F.when(enough, F.stddev_samp("units").over(before))
    columns["trend_index"] = F.row_number().over(w) - 1
    out = panel.withColumns(columns)
    growth = F.when(F.col("lag_24") != 0, ratio(F.col("lag_12"), F.col("lag_24")))
    angle = F.month("month") * 2 * 3.141592653589793 / 12
    return out.withColumns(
        {
            "momentum_3": clipped((F.col("lag_1") - F.col("lag_3")) / (F.col("lag_3") + 1), -cfg.momentum_clip, cfg.momentum_clip),
            "yoy_growth": clipped(growth, cfg.growth_low, cfg.growth_high),
            "month_sin": F.sin(angle),
            "month_cos": F.cos(angle),
        }
    )


def required(df: DataFrame, horizon: int, cfg: Features = Features()) -> DataFrame:
    """Rows that have what a model of the horizon needs."""
    return df.dropna(subset=list(dict(cfg.required)[horizon]))


def encoding(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the sorted different values from 0 on."""
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    return placed(values, [F.col("value")]).select("value", (F.col("place") - 1).cast("int").alias("code"))


def encoded(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """df with `<column>_enc`; -1 for values that the codes don't have."""
    joined = df.join(codes.withColumnsRenamed({"value": column, "code": f"{column}_enc"}), column, "left")
    return joined.na.fill(-1, [f"{column}_enc"])
