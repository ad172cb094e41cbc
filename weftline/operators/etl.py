"""From raw orders and lines to clean transactions, the monthly demand fact and its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import month_of, title
from weftline.sources.versions import unique

EXCLUDED_ITEMS = "FREIGHT|LTL|SHIPPING|MISC"  # fixed value: lines for charges, not for goods


def clean_orders(raw: DataFrame, renames: dict[str, str], dates: list[str], numbers: list[str], key: str = "order_number") -> DataFrame:
    """Rename, parse dates and numbers without failing on bad ones, trim the key, add the order month."""
    out = raw.withColumnsRenamed(renames)
    out = out.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")).cast("date") for c in dates} | {c: F.expr(f"try_cast(`{c}` as double)") for c in numbers} | {key: F.trim(F.col(key).cast("string"))})
    return out.withColumn("order_month", month_of("order_date")) if "order_date" in out.columns else out


def accounting_month(year: str, period: str) -> Column:
    """The first day of an accounting period, null where the two are no month."""
    y, p = F.expr(f"try_cast(`{year}` as int)"), F.expr(f"try_cast(`{period}` as int)")
    return F.when(p.between(1, 12), F.make_date(y, p, F.lit(1)))


def clean_lines(raw: DataFrame, renames: dict[str, str], quantities: list[str]) -> DataFrame:
    """Lines with demand month (of the invoice, or else the accounting period), composite key and flags."""
    out = raw.withColumnsRenamed(renames)
    out = out.withColumns({q: F.coalesce(F.expr(f"try_cast(`{q}` as double)"), F.lit(0.0)) for q in quantities})
    accounting = accounting_month("acct_year", "acct_period")
    invoice = F.try_to_timestamp(F.col("invoice_date").cast("string")).cast("date")
    return out.withColumns(
        {
            "demand_month": F.coalesce(month_of(invoice), accounting),
            "item_category": title(F.trim("item_category")),
            "line_key": F.concat_ws("|", "order_number", "line_number", "bo_number"),
            "is_substituted": F.coalesce(F.col("item_number") != F.col("original_item"), F.lit(False)).cast("int"),
            "is_return": (F.col("returned_qty") > 0).cast("int"),
            "is_cancelled": (F.col("cancel_qty") > 0).cast("int"),
            "is_zero_ship": (F.col("shipped_qty") <= 0).cast("int"),
        }
    )


def latest_headers(orders: DataFrame, key: str, by: list[str], tie: str) -> DataFrame:
    """One header for each order: the latest by the given columns, nulls losing."""
    w = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in by), F.col(tie).desc())
    return orders.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def with_headers(lines: DataFrame, headers: DataFrame, key: str = "order_number") -> DataFrame:
    """Lines with their header, if there is one; headers must be unique, so lines don't multiply."""
    marked = headers.withColumn("_matched", F.lit(1))
    clash = {c: f"{c}_order" for c in headers.columns if c in lines.columns and c != key}
    joined = lines.join(marked.withColumnsRenamed(clash), key, "left")
    return joined.withColumn("header_matched", F.coalesce("_matched", F.lit(0))).drop("_matched")


def is_goods(item: str = "item", quantity: str = "shipped_qty") -> Column:
    return (F.col(quantity) > 0) & ~F.coalesce(F.upper(F.col(item)).rlike(EXCLUDED_ITEMS), F.lit(False))


def gold_monthly(lines: DataFrame) -> DataFrame:
    """Units and revenue of goods by month and sku. lines: month, sku, item, shipped_qty, revenue."""
    goods = lines.where(is_goods())
    return goods.groupBy("month", "sku").agg(F.sum("shipped_qty").alias("units"), F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"))


def packed(gold: DataFrame) -> DataFrame:
    """(sku, months, units, revenue): the fact with a row a sku. The calendar bounds the arrays."""
    each = gold.groupBy("sku").agg(F.collect_list(F.struct("month", "units", "revenue")).alias("_rows"))
    return each.select("sku", F.col("_rows.month").alias("months"), F.col("_rows.units").alias("units"), F.col("_rows.revenue").alias("revenue"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The fact of packed() rows, with whatever else they have; all months of a sku come from one task, so sums by sku are nearly done before they are shuffled."""
    more = [c for c in rows.columns if c not in ("sku", "months", "units", "revenue")]
    each = rows.select("sku", "units", "revenue", *more, F.posexplode("months").alias("_place", "month"))
    return each.select("month", "sku", F.get("units", "_place").alias("units"), F.get("revenue", "_place").alias("revenue"), *more)


def excluded_audit(lines: DataFrame) -> DataFrame:
    """What the goods rule leaves out, by reason."""
    reason = F.when(F.col("shipped_qty") <= 0, "not shipped").when(~is_goods(), "charge")
    return lines.withColumn("reason", reason).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n_lines"), F.round(F.sum("revenue"), 2).alias("revenue"), F.count_distinct("sku").alias("n_skus"))


def month_gaps(months: DataFrame) -> DataFrame:
    """Months between the first and the last that have no rows. months: month."""
    ends = months.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    every = ends.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    return every.join(months.select("month").distinct(), "month", "left_anti")


def key_duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def union_profile(df: DataFrame, key: str, month: str, amount: str) -> DataFrame:
    """One row: counts, duplicate and null keys, date range, amounts and negatives."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        F.round(F.sum(amount), 2).alias("total"),
        F.count_if(F.col(amount) < 0).alias("negatives"),
    )


#: Columns of the product dimension, and the lookup that fills each.
DIMENSION = {
    "sku": "item", "item_name": "item", "item_categ": "item", "style_code": "item", "style_desc": "style", "style_code_desc": "style", "color_code": "item",
    "color_desc": "color", "size_code": "item", "size_desc": "size", "style_color_key": "item", "web_description": "style", "web_active": "style", "item_status": "style",
}


def dim_product(item: DataFrame, size: DataFrame, color: DataFrame, style: DataFrame, provenance: bool = False) -> DataFrame:
    """The product dimension: DIMENSION's columns, a row a sku.

    Items look up their size by the code's number ("01" is 1), their color by style and color together, and their style. Each lookup's key must be
    unique, or reading fails: a doubled key would multiply items. Items that come twice are one by the first in the order of their values. provenance: also
    `filled_by`, the lookups that had a row for the sku. item: sku, item_name, item_categ, style_code, color_code, size_code, style_color_key; size:
    size_code, size_desc; color: style_color_key, color_desc; style: style_code, style_desc, style_code_desc, web_description, web_active, item_status.
    """
    number = F.expr("try_cast(size_code as bigint)")
    lookups = [
        ("size", unique(size.select(number.alias("_number"), "size_desc").where("_number is not null"), "_number"), "_number"),
        ("color", unique(color.where("style_color_key is not null"), "style_color_key"), "style_color_key"),
        ("style", unique(style.where("style_code is not null"), "style_code"), "style_code"),
    ]
    out = item.withColumn("_number", number)
    for name, table, key in lookups:
        out = out.join(table.withColumn(f"_{name}", F.lit(name)), key, "left")
    columns = [F.col(c) for c in DIMENSION]
    filled = [F.concat_ws(",", F.lit("item"), *(f"_{name}" for name in ("size", "color", "style"))).alias("filled_by")] if provenance else []
    rest = F.struct(*(c for c in DIMENSION if c != "sku"), *(["filled_by"] if provenance else []))
    return out.select(*columns, *filled).groupBy("sku").agg(F.min(rest).alias("_rest")).select("sku", "_rest.*")
