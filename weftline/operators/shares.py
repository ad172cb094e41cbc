"""Splitting a parent's forecast: one share operator with its rules as settings, parent profiles, allocation, reconciliation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import Profiles, Shares
from weftline.functions import months_ago, settled

ZERO_UNSEEN = Shares(unseen="zero")
BASELINE = Shares()
RECENCY = Shares(recency=True)
SMOOTHED = Shares(smoothing=0.3)
CAPPED = Shares(cap=1.5)
GRID = ((3.0, 2.0, 1.0), (4.0, 2.0, 1.0), (5.0, 2.0, 1.0), (6.0, 2.0, 1.0), (5.0, 3.0, 1.0), (6.0, 3.0, 1.0), (4.0, 3.0, 1.0), (5.0, 1.0, 1.0), (6.0, 1.0, 1.0))  # fixed values: weights of recent, middle and old months
VARIANTS = {"baseline": BASELINE, "recency_only": RECENCY, "smoothing_only": SMOOTHED, "caps_only": CAPPED}


def child_sums(demand: DataFrame, children: DataFrame, end: date, cfgs: Iterable[Shares]) -> DataFrame:
    """(parent, child, units and whether sold in each stretch of months, the parent's months with sales in each window).

    demand: child, month, units (sparse); children: parent, child, unique by child. The stretches are bounded by the windows and recency steps of
    all settings, so any of them follows from these sums; demand is aggregated by child before anything is joined. A child's months with sales are
    bits, by the months they are ago, so a parent's are their union.
    """
    cfgs = list(cfgs)
    known = demand.where(F.col("month") <= F.lit(end))
    ago = months_ago("month", F.lit(end))
    stretches = []
    for low, high in _stretches(cfgs):
        inside = (ago >= low) & (ago <= high) if high is not None else ago >= low
        stretches += [F.sum(F.when(inside, F.col("units")).otherwise(0.0)).alias(f"u{low}"), F.max(inside.cast("int")).alias(f"s{low}")]
    windows = sorted({c.window for c in cfgs})
    blocks = range(0, windows[-1], 60)
    bits = [F.bit_or(F.when((ago >= b) & (ago < b + 60), F.call_function("shiftleft", F.lit(1).cast("long"), ago - b)).otherwise(0)).alias(f"_bits{b}") for b in blocks]
    by_child = known.groupBy("child").agg(*stretches, *bits)
    w = Window.partitionBy("parent")

    def months(window: int) -> Column:
        within = [(b, (1 << min(60, window - b)) - 1) for b in blocks if window > b]
        return sum((F.bit_count(F.coalesce(F.bit_or(f"_bits{b}").over(w), F.lit(0)).bitwiseAND(F.lit(mask))) for b, mask in within), F.lit(0))

    joined = children.join(by_child, "child", "left")
    return joined.withColumns({f"m{n}": months(n) for n in windows}).drop(*(f"_bits{b}" for b in blocks))


def _stretches(cfgs: list[Shares]) -> list[tuple[int, int | None]]:
    ends = sorted({c.window - 1 for c in cfgs} | {most for c in cfgs for most, _ in c.recency_steps})
    starts = [0, *(e + 1 for e in ends)]
    return list(zip(starts, [*ends, None]))


def setting(cfg: Shares, cfgs: list[Shares]) -> Column:
    """One choice of rules as a value: weights of the stretches, which of them are in the window, and the rest."""
    weights, inside = [], []
    for low, high in _stretches(cfgs):
        weight = next((w for most, w in cfg.recency_steps if high is not None and high <= most), cfg.recency_rest) if cfg.recency else 1.0
        weights.append(F.lit(float(weight)).alias(f"w{low}"))
        inside.append(F.lit(1 if high is not None and high < cfg.window else 0).alias(f"i{low}"))
    return F.struct(
        *weights,
        *inside,
        F.lit(cfg.window).alias("window"),
        F.lit(cfg.least_months).alias("least_months"),
        F.lit(cfg.smoothing).alias("smoothing"),
        F.lit(cfg.cap).alias("cap"),
        F.lit(cfg.unseen == "equal").alias("unseen_equal"),
    )


def split(rows: DataFrame, cfgs: list[Shares], by: list[str]) -> DataFrame:
    """(by, child, units, share, used_window) of child_sums rows that have a column `rule` (see setting). `by` ends with the parent.

    A parent takes its window's months if enough of them have sales, else its whole history, else equal shares. Then, in this
    order and as set: recency weights, smoothing towards equal shares, caps, and normalising.
    """
    w = Window.partitionBy(*by)
    lows = [low for low, _ in _stretches(cfgs)]
    rule = F.col("rule")
    units = {low: F.coalesce(F.col(f"u{low}"), F.lit(0.0)) for low in lows}
    rows = rows.withColumns(
        {
            "_recent": sum((units[low] * rule[f"i{low}"] for low in lows), F.lit(0.0)),
            "_all": sum(units.values(), F.lit(0.0)),
            "_recent_weighted": sum((units[low] * rule[f"w{low}"] * rule[f"i{low}"] for low in lows), F.lit(0.0)),
            "_all_weighted": sum((units[low] * rule[f"w{low}"] for low in lows), F.lit(0.0)),
            "_seen": F.greatest(*(F.coalesce(F.col(f"s{low}"), F.lit(0)) * rule[f"i{low}"] for low in lows)),
            "_ever": F.greatest(*(F.coalesce(F.col(f"s{low}"), F.lit(0)) for low in lows)),
            "_months": F.coalesce(*(F.when(rule["window"] == n, F.col(f"m{n}")) for n in sorted({c.window for c in cfgs})), F.lit(0)),
            "equal_share": 1.0 / F.count("*").over(w),
        }
    )
    window = F.when((F.col("_months") >= rule["least_months"]) & (F.sum("_recent").over(w) > 0), "primary").when(F.sum("_all").over(w) > 0, "full_history").otherwise("equal")
    rows = rows.withColumn("used_window", window)
    own = F.when((F.col("used_window") == "primary") & (F.col("_seen") == 1), F.col("_recent_weighted")).when((F.col("used_window") == "full_history") & (F.col("_ever") == 1), F.col("_all_weighted"))
    rows = rows.withColumn("units", own)
    unseen = F.when(rule["unseen_equal"], F.col("equal_share")).otherwise(0.0)
    share = F.when(F.col("used_window") == "equal", F.col("equal_share")).otherwise(F.coalesce(F.try_divide(F.col("units"), F.sum("units").over(w)), unseen))
    share = F.when(rule["smoothing"] > 0, (1 - rule["smoothing"]) * share + rule["smoothing"] * F.col("equal_share")).otherwise(share)
    rows = rows.withColumn("_share", share)
    rows = rows.withColumn("weighted", F.when(rule["cap"] > 0, F.least(F.col("_share"), rule["cap"] * F.col("equal_share"))).otherwise(F.col("_share")))
    final = F.coalesce(F.try_divide(F.col("weighted"), F.sum("weighted").over(w)), F.col("equal_share"))
    return rows.select(*by, "child", F.coalesce("units", F.lit(0.0)).alias("units"), final.alias("share"), "used_window")


def compute_shares(demand: DataFrame, children: DataFrame, end: date, cfg: Shares = BASELINE) -> DataFrame:
    """(parent, child, units, share, used_window): shares of each parent's children, which sum to 1."""
    return split(child_sums(demand, children, end, [cfg]).withColumn("rule", setting(cfg, [cfg])), [cfg], ["parent"])


def variant_shares(demand: DataFrame, children: DataFrame, end: date, variants: dict[str, Shares]) -> DataFrame:
    """The same with a column `variant`: demand is summed once, and every variant weighs the sums."""
    cfgs = list(variants.values())
    rules = F.array(*(F.struct(F.lit(name).alias("variant"), setting(cfg, cfgs).alias("rule")) for name, cfg in variants.items()))
    rows = child_sums(demand, children, end, cfgs).withColumn("_each", F.explode(rules)).select("*", F.col("_each.variant").alias("variant"), F.col("_each.rule").alias("rule"))
    return split(rows, cfgs, ["variant", "parent"])


def size_shares(demand: DataFrame, children: DataFrame, end: date) -> DataFrame:
    """Shares by size within a parent, copied to every child of the size and normalised again; sizes match null to null.

    children: parent, child, size.
    """
    sizes = children.select("parent", F.concat_ws("#", "parent", F.coalesce("size", F.lit("(null)"))).alias("child")).distinct()
    keyed = children.select("parent", F.col("child").alias("own"), F.concat_ws("#", "parent", F.coalesce("size", F.lit("(null)"))).alias("child"))
    by_size = demand.withColumnRenamed("child", "own").join(keyed.drop("parent"), "own").groupBy("child", "month").agg(F.sum("units").alias("units"))
    shares = compute_shares(by_size, sizes, end, ZERO_UNSEEN)
    w = Window.partitionBy("parent")
    copied = keyed.join(shares.drop("parent"), "child").select("parent", F.col("own").alias("child"), "units", "share", "used_window")
    return copied.withColumn("share", F.coalesce(F.try_divide(F.col("share"), F.sum("share").over(w)), 1.0 / F.count("*").over(w)))


def profiles(demand: DataFrame, children: DataFrame, end: date, cfg: Profiles = Profiles(), window: int = 12) -> DataFrame:
    """What kind of parent each is, with the measures it follows from, over the window's months."""
    ago = months_ago("month", F.lit(end))
    known = demand.where((F.col("month") <= F.lit(end)) & (ago < window)).join(children, "child")
    cells = known.groupBy("parent", "child", "month").agg(F.sum("units").alias("units"))
    totals = cells.groupBy("parent", "month").agg(F.sum("units").alias("total")).where("total > 0")
    by_parent = cells.groupBy("parent").agg(
        F.sum("units").alias("total_units"),
        F.sum(F.when(months_ago("month", F.lit(end)) < cfg.recent_months, F.col("units")).otherwise(0.0)).alias("recent_units"),
        F.count_distinct(F.when(F.col("units") > 0, F.col("month"))).alias("nonzero_months"),
        F.count_distinct(F.when(F.col("units") > 0, F.col("child"))).alias("active_children"),
        F.count_if(F.col("units") > 0).alias("filled"),
    )
    n = children.groupBy("parent").agg(F.count("*").alias("n_children"))
    by_child = cells.groupBy("parent", "child").agg(F.sum("units").alias("units"))
    dominant = by_child.groupBy("parent").agg(F.max("units").alias("largest"))
    # Monthly shares of all children on the months with sales; absent ones have 0. Only sums of squares are needed for that.
    share = cells.join(totals, ["parent", "month"]).withColumn("share", F.col("units") / F.col("total"))
    months = totals.groupBy("parent").agg(F.count("*").alias("m"))
    spread = share.groupBy("parent", "child").agg(F.sum("share").alias("s"), F.sum(F.col("share") * F.col("share")).alias("q")).join(months, "parent")
    deviation = F.sqrt(F.greatest(F.lit(0.0), (F.col("q") - F.col("s") * F.col("s") / F.col("m")) / (F.col("m") - 1)))
    volatile = spread.where("m >= 3").groupBy("parent").agg(F.sum(deviation).alias("deviations"))
    rows = n.join(by_parent, "parent", "left").join(dominant, "parent", "left").join(volatile, "parent", "left").na.fill(0)
    rows = rows.withColumns(
        {
            "dominant_share": F.coalesce(F.try_divide(F.col("largest"), F.col("total_units")), F.lit(0.0)),
            "volatility": F.coalesce(F.col("deviations"), F.lit(0.0)) / F.col("n_children"),
            "sparsity": 1 - F.coalesce(F.try_divide(F.col("filled"), F.col("n_children") * F.col("nonzero_months")), F.lit(0.0)),
            "child_months": F.col("filled") / F.col("n_children"),
        }
    )
    kind = (
        F.when((F.col("total_units") <= cfg.near_dead_units) | ((F.col("recent_units") <= 0) & (F.col("nonzero_months") <= cfg.near_dead_months)), "DEAD_OR_NEAR_DEAD")
        .when((F.col("sparsity") > cfg.sparsity) | (F.col("child_months") < cfg.child_months), "SPARSE")
        .when(F.col("dominant_share") >= cfg.dominant, "DOMINANT")
        .when(F.col("volatility") <= cfg.stable, "STABLE")
        .otherwise("HIGH_VOLUME")
    )
    return rows.withColumn("profile", kind).select("parent", "profile", "total_units", "recent_units", "nonzero_months", "active_children", "n_children", "dominant_share", "volatility", "sparsity", "child_months")


#: Settings for each profile; the dead share equally.
STRATEGIES = {"STABLE": BASELINE, "DOMINANT": BASELINE, "HIGH_VOLUME": RECENCY, "SPARSE": Shares(smoothing=0.20), "DEAD_OR_NEAR_DEAD": Shares(smoothing=1.0)}


def segmented_shares(demand: DataFrame, children: DataFrame, end: date, kinds: DataFrame) -> DataFrame:
    """Each parent's shares by its profile's settings, in one pass. kinds: parent, profile."""
    cfgs = list(STRATEGIES.values())
    rule = F.coalesce(*(F.when(F.col("profile") == profile, setting(cfg, cfgs)) for profile, cfg in STRATEGIES.items()))
    rows = child_sums(demand, children, end, cfgs).join(kinds.select("parent", "profile"), "parent").withColumn("rule", rule)
    return split(rows, cfgs, ["profile", "parent"])


def weight_grid() -> dict[str, Shares]:
    """The recency weights that are tried over half a year, after the baseline over a whole one; a repeated setting is tried once."""
    found = {"baseline_L12_3_2_1": RECENCY}
    for recent, mid, old in GRID:
        cfg = Shares(window=6, least_months=3, recency=True, recency_steps=((2, recent), (5, mid)), recency_rest=old)
        if cfg not in found.values():
            found[f"L6_{recent:g}_{mid:g}_{old:g}"] = cfg
    return found


def allocate(forecasts: DataFrame, shares: DataFrame) -> DataFrame:
    """Parents' forecasts times their children's shares. forecasts: parent, month, step, units, lower, upper; shares may come in variants."""
    variant = ["variant"] if "variant" in shares.columns else []
    # Forecasts have a row a parent and month, shares one a child and variant, though their size is guessed small: these must not be broadcast.
    joined = forecasts.hint("shuffle_hash").join(shares.select(*variant, "parent", "child", "share"), "parent", "left")
    share = F.coalesce("share", F.lit(0.0))
    values = {c: settled(F.greatest(F.col(c) * share, F.lit(0.0))) for c in ("units", "lower", "upper")}
    return joined.select(*variant, "parent", "child", "month", "step", *(v.alias(c) for c, v in values.items()))


def reconcile(forecasts: DataFrame, allocated: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """For each parent, month and step: the parent's units, its children's, their difference and ratio, and whether they agree: in units, in ratio (ten times the tolerance), and without negatives."""
    sums = allocated.groupBy("parent", "month", "step").agg(F.sum("units").alias("children_units"), F.count_if(F.col("units") < 0).alias("negatives"))
    joined = forecasts.select("parent", "month", "step", F.col("units").alias("parent_units")).join(sums, ["parent", "month", "step"], "left").na.fill(0)
    out = joined.withColumns({"difference": F.abs(F.col("parent_units") - F.col("children_units")), "ratio": F.try_divide("children_units", "parent_units")})
    agrees = F.coalesce(F.abs(F.col("ratio") - 1) <= 10 * tolerance, F.lit(True))  # nothing to be in ratio to
    return out.withColumns({"ratio_passed": agrees.cast("int"), "passed": ((F.col("difference") < tolerance) & agrees & (F.col("negatives") == 0)).cast("int")})


def reconcile_summary(forecasts: DataFrame, allocated: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One row: the largest difference of reconcile(), whether sums, ratios and signs pass, and how many parents, children and groups were checked. Without groups all pass."""
    groups = reconcile(forecasts, allocated, tolerance).agg(
        F.count("*").alias("n_groups"),
        F.count_distinct("parent").alias("n_parents"),
        F.max("difference").alias("max_abs_diff"),
        F.count_if(F.col("difference") >= tolerance).alias("sums_failed"),
        F.count_if(F.col("ratio_passed") == 0).alias("ratios_failed"),
    )
    children = allocated.agg(F.count_distinct("child").alias("n_children"), F.count_if(F.col("units") < 0).alias("negatives"))
    one = groups.crossJoin(children)  # one row each
    passed = [(F.col(failed) == 0).cast("int").alias(name) for failed, name in (("sums_failed", "sum_check_passed"), ("ratios_failed", "share_check_passed"), ("negatives", "no_negatives"))]
    return one.select("n_groups", "n_parents", "n_children", "max_abs_diff", *passed)


def coverage(gold: DataFrame, products: DataFrame) -> DataFrame:
    """One row: how many skus, colors and styles there are, sold, and can be allocated."""
    sold = gold.select("sku").distinct().select("sku", F.lit(1).alias("sold"))
    both = products.select("sku", "color", "style", F.lit(1).alias("known")).join(sold, "sku", "full")
    n = F.count_if
    return both.agg(
        F.count("known").alias("dim_skus"),
        F.count_distinct("color").alias("colors"),
        F.count_distinct("style").alias("styles"),
        n(F.col("known").isNotNull() & (F.col("style").isNull() | F.col("color").isNull())).alias("skus_without_parent"),
        F.count("sold").alias("sold_skus"),
        n(F.col("sold").isNotNull() & F.col("known").isNotNull()).alias("sold_with_dim"),
        n(F.col("sold").isNotNull() & F.col("style").isNotNull()).alias("sold_with_style"),
        n(F.col("sold").isNotNull() & F.col("style").isNull()).alias("standalone_skus"),
    )
