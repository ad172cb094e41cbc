"""More demand queries: raw cleaning, table checks, and reports over versions and calibrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import calibrate, etl, panel, score, shares
from weftline.plans import catalog as c
from weftline.plans.sqltext import HOLDOUT, sql
from weftline.sources import retail

# Raw orders and lines, every value as text under names of another system


@c.query("select trim(o_orderkey::varchar) as order_number, o_orderdate::date as order_date, date_trunc('month', o_orderdate)::date as order_month, o_totalprice::double as total, o_orderstatus as status from orders")
def etl_clean_orders(spark, d):
    o = retail.table(spark, d, "orders")
    raw = o.select(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("Order#"), F.col("o_orderdate").cast("string").alias("Order Date"), F.col("o_totalprice").cast("string").alias("Total"), F.col("o_orderstatus").alias("Status"))
    names = {"Order#": "order_number", "Order Date": "order_date", "Total": "total", "Status": "status"}
    return etl.clean_orders(raw, names, ["order_date"], ["total"]).select("order_number", "order_date", "order_month", "total", "status")


@c.query("""select l_orderkey || '|' || l_linenumber || '|0' as line_key, date_trunc('month', case when l_orderkey % 5 = 0 then make_date(year(l_shipdate), month(l_shipdate), 1) else l_shipdate::date end)::date as demand_month,
    case when l_orderkey % 3 = 0 then 'Air Mail' else 'Truck' end as item_category, (l_partkey % 4 = 0)::int as is_substituted, (l_returnflag = 'R')::int as is_return, (l_linestatus = 'F' and l_returnflag = 'N')::int as is_cancelled, (l_quantity <= 0)::int as is_zero_ship, l_quantity::double as shipped_qty from lineitem""")
def etl_clean_lines_raw(spark, d):
    """The invoice date of every fifth order can't be read, so its lines take the accounting month."""
    x = retail.table(spark, d, "lineitem")
    unreadable = F.col("l_orderkey") % 5 == 0
    raw = x.select(
        F.col("l_orderkey").cast("string").alias("order_number"), F.col("l_linenumber").cast("string").alias("line_number"), F.lit("0").alias("bo_number"),
        F.when(unreadable, "n/a").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("Invoice Date"), F.year("l_shipdate").cast("string").alias("acct_year"), F.month("l_shipdate").cast("string").alias("acct_period"),
        F.when(F.col("l_orderkey") % 3 == 0, " AIR mail ").otherwise("TRUCK").alias("item_category"), F.col("l_partkey").cast("string").alias("item_number"),
        F.when(F.col("l_partkey") % 4 == 0, "other").otherwise(F.col("l_partkey").cast("string")).alias("original_item"), F.when(F.col("l_returnflag") == "R", "1").otherwise("none").alias("returned_qty"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), "2").alias("cancel_qty"), F.col("l_quantity").cast("string").alias("Shipped"),
    )
    clean = etl.clean_lines(raw.withColumnRenamed("Shipped", "shipped_qty"), {"Invoice Date": "invoice_date"}, ["shipped_qty", "returned_qty", "cancel_qty"])
    return clean.select("line_key", "demand_month", "item_category", "is_substituted", "is_return", "is_cancelled", "is_zero_ship", "shipped_qty")


QUARTILES = ", ".join(f"round(quantile_cont(o_totalprice, {q / 4}), 4) as q{q}_total" for q in (1, 2, 3))


@c.query("""select o_orderstatus as status, count(*) as n_rows, count(distinct o_orderkey) as n_keys, count(*) filter (o_orderkey is null) as null_keys, min(o_orderdate)::date as first_date, max(o_orderdate)::date as last_date, round(avg(o_totalprice), 4) as mean_total, round(stddev_samp(o_totalprice), 4) as std_total, round(min(o_totalprice), 4) as min_total, round(max(o_totalprice), 4) as max_total, count(*) filter (o_totalprice < 0) as negatives, """ + QUARTILES + " from orders group by 1")
def etl_order_profile(spark, d):
    o, t = retail.table(spark, d, "orders"), F.col("o_totalprice")
    return o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys"), F.count_if(F.col("o_orderkey").isNull()).alias("null_keys"), F.min(F.col("o_orderdate").cast("date")).alias("first_date"), F.max(F.col("o_orderdate").cast("date")).alias("last_date"),
        F.round(F.avg(t), 4).alias("mean_total"), F.round(F.stddev_samp(t), 4).alias("std_total"), F.round(F.min(t), 4).alias("min_total"), F.round(F.max(t), 4).alias("max_total"), F.count_if(t < 0).alias("negatives"),
        *(F.round(F.percentile(t, F.lit(q / 4)), 4).alias(f"q{q}_total") for q in (1, 2, 3)),
    )


@c.query(sql("""select year(month)::int as year, count(*) as n_rows, count(*) filter (coalesce(trim(sku), '') = '') as blank_items, round(avg((shipped_qty = 0)::int), 6) as zero_share, round(avg((shipped_qty < 0)::int), 6) as negative_share, sum(is_return)::bigint as returns, sum(is_open)::bigint as open
    from lines
    group by 1""", "lines"))
def etl_line_profile(spark, d):
    q = F.col("shipped_qty")
    return retail.order_lines(spark, d).groupBy(F.year("month").alias("year")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.coalesce(F.trim("sku"), F.lit("")) == "").alias("blank_items"), F.round(F.avg((q == 0).cast("int")), 6).alias("zero_share"), F.round(F.avg((q < 0).cast("int")), 6).alias("negative_share"), F.sum("is_return").alias("returns"), F.sum("is_open").alias("open"),
    )


@c.query(sql("select count(*) as n_rows, count(distinct (month, sku)) as n_keys, count(*) - count(distinct (month, sku)) as n_double, count(*) filter (month is null or sku is null) as n_null from gold", "gold"))
def etl_gold_grain(spark, d):
    keys = c.gold(spark, d).groupBy("month", "sku").agg(F.count("*").alias("n"))
    return keys.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), (F.sum("n") - F.count("*")).alias("n_double"), F.coalesce(F.sum(F.when(F.col("month").isNull() | F.col("sku").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))


@c.query(sql(f"select month, count(*) as n_skus, round(sum(units), 4) as units, (month in {HOLDOUT})::int as is_holdout from gold where month > date '2001-07-01' group by 1", "gold"))
def holdout_months(spark, d):
    """The months after training that have actuals, and which of them are held out."""
    g = c.gold(spark, d).where(F.col("month") > F.lit(c.CAL.train_end))
    return c.rounded(g.groupBy("month").agg(F.count("*").alias("n_skus"), F.sum("units").alias("units"))).withColumn("is_holdout", F.col("month").isin(*c.CAL.holdout).cast("int"))


# Versions


@c.query(sql(f"select variant, step, month, count(*) as n, {c.FLOOR1} from (" + " union all ".join(f"select '{v}' as variant, * from {c.scored_sql(**a)}" for v, a in c.VARIANT_ARGS.items()) + ") group by all", *c.SCORE_NEEDS))
@c.once
def same_population(spark, d):
    return c.rounded(score.same_population(c.variants_scored(spark, d, shares.VARIANTS)).select("variant", "step", "month", "n", "wmape"))


PIVOT = " , ".join(f"round(max(wmape) filter (month = date '2001-0{7 + s}-01'), 4) as wmape_{s}" for s in (1, 2))


@c.query(sql(f"select variant, level, {PIVOT} from (" + " union all ".join(f"""select '{v}' as variant, '{e}' as level, month, case when sum(a) > 0 then sum(abs(a - p)) * 100 / sum(a) end as wmape
    from (select month, {e}, sum(actual) as a, sum(predicted) as p
    from {c.scored_sql(**args)} join products using (sku)
    group by all)
    group by month""" for v, args in c.VARIANT_ARGS.items() for e in ("sku", "color", "style")) + ") group by variant, level", *c.SCORE_NEEDS))
@c.once
def variant_levels(spark, d):
    """WMAPE of variants by level, the months side by side."""
    rows = c.variants_scored(spark, d, shares.VARIANTS).join(retail.dim_product(spark, d).select("sku", "color", "style"), "sku")
    each = rows.select("variant", "month", "actual", "predicted", F.explode(F.array(*(F.struct(F.lit(e).alias("level"), F.col(e).alias("key")) for e in ("sku", "color", "style")))).alias("l"))
    sums = each.groupBy("variant", "l.level", "month", "l.key").agg(F.sum("actual").alias("a"), F.sum("predicted").alias("p"))
    wmape = F.when(F.sum("a") > 0, F.sum(F.abs(F.col("a") - F.col("p"))) * 100 / F.sum("a"))
    months = {str(m): f"wmape_{k}" for k, m in enumerate(c.CAL.holdout, 1)}
    return c.rounded(sums.groupBy("variant", "level").pivot("month", list(c.CAL.holdout)).agg(wmape).withColumnsRenamed(months))


LOWEST = f"(select * from (select *, row_number() over (partition by sku, month order by step) as place from {c.scored_sql()}) where place = 1)"


@c.query(sql(f"select month, count(*) as n, round(sum(actual), 4) as actual, round(sum(predicted), 4) as predicted, {c.FLOOR1} from {LOWEST} group by month", *c.SCORE_NEEDS))
@c.once
def error_lowest_step(spark, d):
    rows = score.lowest_step(c.sku_scored(spark, d))
    return c.rounded(rows.groupBy("month").agg(F.count("*").alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), (F.sum("abs_error") * 100 / F.greatest(F.lit(1.0), F.sum("actual"))).alias("wmape")))


# Calibration

HISTORY = f"""(select entity, h.horizon, count(*) as n, sum(actual) as total_actual, sum(predicted) as total_predicted, sum(actual) / nullif(sum(predicted), 0) as raw_factor, 'WEAK' as evidence, 1.0::double as factor
    from (values (1), (3)) h(horizon)
    join (select a.entity, k.horizon, a.units as actual, b.units as predicted
    from demand_style a join (values (1), (3)) k(horizon) on true join demand_style b on a.entity = b.entity and b.month = a.month - to_months(k.horizon)
    where a.month <= {c.END} and a.month > {c.END} - interval 24 month and b.month > {c.END} - interval 24 month and b.units > 0) x on x.horizon = h.horizon
    group by entity, h.horizon)"""
CV_SOLID = f"(select * from {c.CV_FACTORS} where evidence <> 'NONE')"


@c.query(sql(f"""select entity, horizon, n, round(total_actual, 4) as total_actual, evidence, round(factor, 4) as factor, source
    from (select entity, horizon, n, total_actual, evidence, factor, 'validation' as source
    from {CV_SOLID}
    union all select entity, horizon, n, total_actual, evidence, factor, 'history'
    from {HISTORY} h
    where not exists (select 1
    from {CV_SOLID} s
    where s.entity = h.entity and s.horizon = h.horizon))""", "panel_style", "demand_style"))
@c.once
def calib_merged(spark, d):
    """Factors from validation where it has evidence for the key, from history for the others."""
    first = c.cv_factors(spark, d).where("evidence <> 'NONE'").withColumn("source", F.lit("validation"))
    demand = c.demand(spark, d, "style")
    history = score.union_all([calibrate.history_factors(demand, c.CAL.train_end, h) for h in (1, 3)]).withColumn("source", F.lit("history"))
    return c.rounded(calibrate.first_of(first, history, ["entity", "horizon"]).select("entity", "horizon", "n", "total_actual", "evidence", "factor", "source"))


@c.query(sql(f"""select f.parent as entity, f.month, f.step, round(greatest(f.units * coalesce(t.factor, 1), 0) + 1e-9::double, 4) as units, round(coalesce(t.factor, 1), 4) as calibration_factor, 'weftline-1+global' as model_version
    from {c.STYLE_FC} f
    left join (select horizon, case when accepted = 1 then factor else 1 end as factor
    from {c.GLOBAL_SQL}) t on t.horizon = f.step""", "panel_style", "forecast_style", "demand_style"))
@c.once
def calib_apply_global(spark, d):
    f = c.parent_forecast(spark, d).withColumnRenamed("parent", "entity").withColumns({"horizon": F.col("step"), "model_version": F.lit(c.MODEL_VERSION)})
    return c.rounded(calibrate.apply_factors(f, c.gated(spark, d), ["horizon"], "+global", factor="applied_factor").select("entity", "month", "step", "units", "calibration_factor", "model_version"))


@c.query(sql(f"""select coalesce(p.style, 'UNKNOWN') as style, coalesce(p.color, 'UNKNOWN') as color, a.step, count(*) as n_skus, round(sum(a.units), 4) as units
    from {c.sku_alloc_sql()} a
    left join products p on p.sku = a.child
    group by all""", *c.ALLOC_NEEDS))
@c.once
def production_filled(spark, d):
    """Attributes of production rows: what the forecast lacks comes from the product dimension, else UNKNOWN."""
    f = c.sku_alloc(spark, d).withColumnRenamed("child", "sku").withColumns({"style": F.lit(None).cast("string"), "color": F.when(F.col("step") == 1, F.col("parent"))})
    filled = panel.filled(f, retail.dim_product(spark, d), ["style", "color"])
    return c.rounded(filled.groupBy("style", "color", "step").agg(F.count("*").alias("n_skus"), F.sum("units").alias("units")))


@c.query(sql(f"select horizon, source, count(*) as n, round(sum(predicted), 4) as predicted, round(sum(actual), 4) as actual from {c.EVIDENCE_SQL} group by all", "panel_style", "forecast_style", "demand_style"))
@c.once
def calib_global_evidence(spark, d):
    """What the global factors rest on."""
    rows = calibrate.global_evidence(c.tested(spark, d), c.gate_rows(spark, d), c.CAL.holdout[0])
    return c.rounded(rows.groupBy("horizon", "source").agg(F.count("*").alias("n"), F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual")))
