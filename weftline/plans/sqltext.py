"""DuckDB SQL of the catalogue, put together from named parts."""

from __future__ import annotations

END = "date '2001-07-01'"
HOLDOUT = "(date '2001-08-01', date '2001-09-01')"
AGO = f"((year({END}) - year(month)) * 12 + month({END}) - month(month))"


def _panel(entity: str) -> str:
    return f"""with first_ as (select entity, min(month) as a from demand_{entity} where month <= {END} group by entity),
        grid as (select entity, unnest(generate_series(a, {END}, interval 1 month))::date as month from first_)
        select g.entity, g.month, coalesce(d.units, 0)::double as units, coalesce(d.revenue, 0)::double as revenue from grid g left join demand_{entity} d on d.entity = g.entity and d.month = g.month"""


def _segment(entity: str) -> str:
    return f"""select entity, avg((units = 0)::int::double) as zero_ratio, case when count(*) filter (units > 0) > 1 then stddev_pop(units) filter (units > 0) / avg(units) filter (units > 0) end as cv_nonzero,
        coalesce(sum(units) filter (month > {END} - interval 12 month), 0)::double as trailing_sum, count(*) filter (units > 0) as active_months, count(*) as total_months, min(month) as first_sale, max(month) as last_sale,
        case when coalesce(sum(units) filter (month > {END} - interval 12 month), 0) = 0 then 'DEAD' when avg((units = 0)::int::double) >= 0.4 then 'INTERMITTENT' else 'REGULAR' end as segment from panel_{entity} group by entity"""


def _forecast(entity: str) -> str:
    return f"""with h as (select entity, list(units order by month) as u from panel_{entity} group by entity),
        s as (select *, unnest([1, 2, 3]) as step, len(u) as n from h)
        select entity, ({END} + to_months(step))::date as month, step, 0.0::double as zero,
            greatest(0, list_avg(u[greatest(1, n - 2):])) as ma_3, greatest(0, list_avg(u[greatest(1, n - 11):])) as ma_12,
            case when n + step - 12 >= 1 then u[n + step - 12] else 0 end::double as seasonal_naive,
            coalesce(list_avg(list_filter([case when n + step - 12 >= 1 then u[n + step - 12] end, case when n + step - 24 >= 1 then u[n + step - 24] end, case when n + step - 36 >= 1 then u[n + step - 36] end], lambda x: x is not null)), 0)::double as seasonal_avg3y,
            list_avg(u[greatest(1, n - 2):]) as trail_3, list_sum(u[greatest(1, n - 11):]) as sum_12, coalesce(list_filter(u, lambda x: x > 0)[-1], 0) as last_sold from s"""


def _croston(entity: str) -> str:
    return f"""with recursive places as (select entity, units, row_number() over (partition by entity order by month) as i from panel_{entity}),
        ranked as (select entity, i, units, row_number() over (partition by entity order by i) as r from places where units > 0),
        st as (select entity, r, i, units::double as q, 1.0::double as p from ranked where r = 1
            union all select n.entity, n.r, n.i, 0.2::double * n.units + 0.8::double * s.q, 0.2::double * (n.i - s.i) + 0.8::double * s.p from st s join ranked n on n.entity = s.entity and n.r = s.r + 1),
        last_ as (select entity, arg_max(q, r) as q, arg_max(p, r) as p from st group by entity)
        select e.entity, coalesce(q / p, 0) as croston, coalesce(q / p * 0.9::double, 0) as croston_sba from (select distinct entity from panel_{entity}) e left join last_ l on l.entity = e.entity"""


def _croston_at(entity: str, origins: str) -> str:
    """Croston's method on the series as they were at each origin: entity, origin, sba."""
    return f"""(with recursive o(origin) as (values {origins}), places as (select p.entity, o.origin, p.units, row_number() over (partition by p.entity, o.origin order by p.month) as i from panel_{entity} p join o on p.month <= o.origin),
        ranked as (select entity, origin, i, units, row_number() over (partition by entity, origin order by i) as r from places where units > 0),
        st as (select entity, origin, r, i, units::double as q, 1.0::double as p from ranked where r = 1
            union all select n.entity, n.origin, n.r, n.i, 0.2::double * n.units + 0.8::double * s.q, 0.2::double * (n.i - s.i) + 0.8::double * s.p from st s join ranked n on n.entity = s.entity and n.origin = s.origin and n.r = s.r + 1)
        select entity, origin, arg_max(q, r) / arg_max(p, r) * 0.9::double as sba from st group by entity, origin)"""


def months_before(months: int) -> str:
    return f"({END} - interval {months} month)::date"


FOLDS = {1: (6, 3, 24), 3: (4, 3, 24), 12: (3, 12, 36)}


def walk(entity: str, horizon: int, count: int, step: int, least: int) -> str:
    """Rows of walk-forward validation for one horizon."""
    folds = ", ".join(f"({count - k}, {months_before(horizon + k * step)})" for k in range(count))
    origins = ", ".join(f"({months_before(horizon + k * step)})" for k in range(count))

    def before(h: int, y: int) -> str:
        k = 12 * y - h
        return f"lag(units, {k}) over w" if k > 0 else "units"

    parts = []
    for h in range(1, horizon + 1):
        parts.append(f"""select entity, month, age, ma_3, ma_12, {h} as step, a{h} as actual, coalesce(s{h}_1, 0) as seasonal_naive,
            coalesce(list_avg(list_filter([s{h}_1, s{h}_2, s{h}_3], lambda x: x is not null)), 0) as seasonal_avg3y from r""")
    columns = ", ".join(f"lead(units, {h}) over w as a{h}, " + ", ".join(f"{before(h, y)} as s{h}_{y}" for y in (1, 2, 3)) for h in range(1, horizon + 1))
    return f"""(with r as (select entity, month, greatest(0, avg(units) over (w rows between 2 preceding and current row)) as ma_3, greatest(0, avg(units) over (w rows between 11 preceding and current row)) as ma_12,
            row_number() over w as age, {columns} from panel_{entity} window w as (partition by entity order by month)),
        f(fold, origin) as (values {folds}), x as ({" union all ".join(parts)})
        select x.entity, f.fold, f.origin, (f.origin + to_months(x.step))::date as month, x.step, {horizon} as horizon, x.actual, x.ma_3, x.ma_12, x.seasonal_naive::double as seasonal_naive, x.seasonal_avg3y::double as seasonal_avg3y, coalesce(cr.sba, 0)::double as croston_sba, 0.0::double as zero
        from x join f on x.month = f.origin left join {_croston_at(entity, origins)} cr on cr.entity = x.entity and cr.origin = f.origin where x.age >= {least} and x.actual is not null)"""


def shares(parent: str, child: str, recency: bool = False, smoothing: float = 0.0, cap: float = 0.0, unseen: str = "equal", where: str = "true", prefix: str = "", window: int = 12, least: int = 6, weights: tuple[float, float, float] = (3.0, 2.0, 1.0)) -> str:
    weight = f"case when {AGO} <= 2 then {weights[0]} when {AGO} <= 5 then {weights[1]} else {weights[2]} end::double" if recency else "1.0::double"
    unseen_sql = "equal_share" if unseen == "equal" else "0.0::double"
    weighted = f"case when used_window = 'equal' then equal_share else coalesce(units / nullif(sum(units) over (partition by parent), 0), {unseen_sql}) end"
    if smoothing:
        weighted = f"({1 - smoothing}::double * ({weighted}) + {smoothing}::double * equal_share)"
    capped = f"least(weighted, {cap}::double * equal_share)" if cap else "weighted"
    return f"""(with kids as (select distinct {parent} as parent, {child} as child from products where {where}),
        d as (select k.parent, k.child, g.month, g.units, {weight} as w, {AGO} < {window} as recent from demand_{child} g join kids k on g.entity = k.child where g.month <= {END}),
        c as (select parent, child, sum(case when recent then units * w else 0 end) as recent_weighted, sum(units * w) as all_weighted, sum(case when recent then units else 0 end) as recent_units, sum(units) as all_units, max(recent::int) as seen_recently from d group by all),
        m as (select parent, count(distinct month) as n_months from d where recent group by parent),
        r as (select k.parent, k.child, c.*exclude(parent, child), n_months, 1.0::double / count(*) over p as equal_share, sum(recent_units) over p as pr, sum(all_units) over p as pa from kids k left join c on c.parent = k.parent and c.child = k.child left join m on m.parent = k.parent window p as (partition by k.parent)),
        u as (select *, case when coalesce(n_months, 0) >= {least} and pr > 0 then 'primary' when pa > 0 then 'full_history' else 'equal' end as used_window from r),
        x as (select *, case when used_window = 'primary' and seen_recently = 1 then recent_weighted when used_window = 'full_history' then all_weighted end as units from u),
        y as (select *, {weighted} as weighted from x), z as (select *, {capped} as final from y)
        select parent, child, coalesce(units, 0)::double as units, coalesce(final / nullif(sum(final) over (partition by parent), 0), equal_share) as share, used_window {prefix} from z)"""


PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "products": ("select p_partkey::varchar as sku, p_type as style, p_type || '|' || p_brand as color, p_size::varchar as size, p_name as item, p_retailprice as price from part", ()),
    "lines": (
        """select l_orderkey as order_number, l_linenumber as line_number, l_orderkey || '|' || l_linenumber as line_key, l_partkey::varchar as sku, date_trunc('month', l_shipdate)::date as month, l_quantity as shipped_qty,
        l_extendedprice * (1 - l_discount) as revenue, (l_returnflag = 'R')::int as is_return, (l_linestatus = 'O')::int as is_open, (l_quantity <= 0)::int as is_zero_ship from lineitem""",
        (),
    ),
    "goods": ("select l.*, p.item from lines l join products p using (sku) where shipped_qty > 0 and not regexp_matches(upper(item), 'FREIGHT|LTL|SHIPPING|MISC')", ("lines", "products")),
    # Every tenth sku's demand once more, under a sku that has no dimension row.
    "gold_new": ("select month, sku, units, revenue from gold union all select month, 'new-' || sku, units, revenue from gold where sku::int % 10 = 0", ("gold",)),
    "demand_new": ("select sku as entity, month, units, revenue from gold_new", ("gold_new",)),
    "gold": ("select month, sku, sum(shipped_qty) as units, sum(revenue) as revenue from goods group by all", ("goods",)),
    "demand_sku": ("select sku as entity, month, units, revenue from gold", ("gold",)),
    **{f"demand_{e}": (f"select p.{e} as entity, g.month, sum(g.units) as units, sum(g.revenue) as revenue from gold g join products p using (sku) where p.{e} is not null group by all", ("gold", "products")) for e in ("color", "style")},
    **{f"panel_{e}": (_panel(e), (f"demand_{e}",)) for e in ("sku", "color", "style", "new")},
    **{f"segment_{e}": (_segment(e), (f"panel_{e}",)) for e in ("sku", "color", "style", "new")},
    **{f"forecast_{e}": (_forecast(e), (f"panel_{e}",)) for e in ("sku", "color", "style", "new")},
    **{f"croston_{e}": (_croston(e), (f"panel_{e}",)) for e in ("sku", "color", "style", "new")},
}


def sql(query: str, *needs: str) -> str:
    """The query after the parts it needs, and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in PARTS[name][1]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    recursive = "recursive " if any("with recursive" in PARTS[n][0] for n in order) else ""
    return f"with {recursive}" + ",\n".join(f"{n} as materialized ({PARTS[n][0]})" for n in order) + "\n" + query
