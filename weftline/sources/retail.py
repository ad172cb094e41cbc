"""Orders, order lines, products and months in the domain's terms, from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import Calendar
from weftline.functions import month_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sku, style, color, brand, size, item, price; sku is unique.

    The hint goes with it to whatever it is joined with: a compressed file looks small, but its rows grow with the catalogue and must not be
    broadcast through the driver.
    """
    return table(spark, sf_dir, "part").hint("shuffle_hash").select(
        F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_type").alias("style"),
        F.concat_ws("|", "p_type", "p_brand").alias("color"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_name").alias("item"),
        F.col("p_retailprice").alias("price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their demand month, quantities, revenue and flags."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_linenumber").alias("line_number"),
        F.concat_ws("|", "l_orderkey", "l_linenumber").alias("line_key"),
        F.col("l_partkey").cast("string").alias("sku"),
        month_of("l_shipdate").alias("month"),
        F.col("l_quantity").alias("shipped_qty"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_return"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
        (F.col("l_quantity") <= 0).cast("int").alias("is_zero_ship"),
    )


def dim_date(spark: SparkSession, calendar: Calendar = Calendar()) -> DataFrame:
    """Every month with its split."""
    months = spark.sql(f"select explode(sequence(date'{calendar.first_month}', date'{calendar.last_month}', interval 1 month)) as month")
    split = F.when(F.col("month") <= F.lit(calendar.train_end), "TRAIN").when(F.col("month").isin(*calendar.holdout), "HOLDOUT").otherwise("FORECAST")
    return months.select("month", F.year("month").alias("year"), F.month("month").alias("month_of_year"), F.quarter("month").alias("quarter"), split.alias("split"))


SPLIT_COLUMNS = ("Split", "TrainHoldout", "DataSplit", "DatasetSplit", "Set")  # fixed values: names under which a calendar tells its splits


def _split(months: DataFrame) -> Column | None:
    """The calendar's split in capitals, from the first of the known columns that names a holdout month, else from is_train."""
    names = {c.lower().replace("_", ""): c for c in months.columns}
    found = [names[c.lower()] for c in SPLIT_COLUMNS if c.lower() in names]
    if found:
        held = months.agg(*(F.count_if(F.upper(F.trim(F.col(c).cast("string"))) == "HOLDOUT").alias(c) for c in found)).first()
        return F.upper(F.trim(F.col(next((c for c in found if held[c]), found[0])).cast("string")))
    if "istrain" in names:
        return F.when(F.lower(F.trim(F.col(names["istrain"]).cast("string"))).isin("1", "true"), "TRAIN").otherwise("HOLDOUT")
    return None


def train_end(months: DataFrame, with_holdout: bool = False) -> object:
    """The last training month, of both splits that have actuals if asked for (one number: the only thing brought to the driver)."""
    split = _split(months)
    end = None if split is None else months.where(split.isin(*(["TRAIN", "HOLDOUT"] if with_holdout else ["TRAIN"]))).agg(F.max(month_of("month"))).first()[0]
    if end is None:
        raise ValueError("no training month")
    return end


def holdout(months: DataFrame, actuals: DataFrame | None = None) -> list:
    """The calendar's holdout months in order, those with actuals if a fact is given. actuals: month."""
    split = _split(months)
    found = months.where(F.lit(False) if split is None else split == "HOLDOUT").select(month_of("month").alias("month")).distinct()
    if actuals is not None:
        found = found.join(actuals.select("month").distinct(), "month", "left_semi")
    out = sorted(r["month"] for r in found.collect())  # a few months
    if not out:
        raise ValueError("no holdout month in Split, TrainHoldout, DataSplit, DatasetSplit, Set or is_train")
    return out


def phase_end(months: DataFrame, phase: int) -> object:
    """Where training ends: phase 1 keeps the holdout out, phase 2 takes it in to refit for production."""
    if phase not in (1, 2):
        raise ValueError(f"phase must be 1 or 2, not {phase}")
    return train_end(months, with_holdout=phase == 2)
