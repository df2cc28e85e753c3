"""The three passes over the item rows behind the customer features.

Each pass reads only its own columns, places them by customer (one shuffle of narrow
rows) and then does all of its grouping without another one, because every grouping
key starts with the customer. For a hot customer the rows are not placed together and
the same groupings run as partial plus final aggregation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from buyerscope.functions.exprs import grouped, sql_days, sql_midnight, sql_ratio, with_columns
from buyerscope.settings import LOOKBACK_DAYS, RETURN_LOOKBACK_DAYS, FeatureSettings

Place = Callable[[DataFrame], DataFrame]


KEPT = "is_returned = 0"
RETURNED = "is_returned = 1"

# Attribute columns and the names their features carry.
TOP_SHARE_NAMES = {
    "prod_brand": ("top_brand_share", "n_unique_brands"),
    "prod_color": ("top_color_share", "n_unique_colors"),
    "prod_season": ("top_season_share", "n_unique_seasons"),
}
CORE_ATTRIBUTES = (
    "prod_brand",
    "prod_color",
    "prod_type_1",
    "prod_type_3",
    "prod_type_4",
    "prod_type_5",
    "prod_season",
)
DETAIL_ATTRIBUTES = (
    "prod_heel",
    "prod_material",
    "prod_insole",
    "prod_print",
    "prod_comfort_sole",
    "prod_comfort_wear",
    "prod_clasp",
)
RECENT_ATTRIBUTES = (
    "prod_brand",
    "prod_color",
    "prod_type_1",
    "prod_type_3",
    "prod_type_4",
    "prod_type_5",
)
MATERIAL_MAIN = "material_main"


def share_name(attribute: str) -> str:
    return TOP_SHARE_NAMES.get(attribute, (f"{attribute}_dominant_share",))[0]


def distinct_name(attribute: str) -> str:
    names = TOP_SHARE_NAMES.get(attribute)
    return names[1] if names else f"{attribute}_n_unique"


def in_window(settings: FeatureSettings, days: int) -> str:
    """Closed at both midnights: later on the last day is already outside."""
    end = sql_midnight(settings.reference_date)
    return f"order_date between {end} - interval {days - 1} days and {end}"


def _sum_if(cond: str, x: str) -> str:
    return f"coalesce(sum(case when {cond} then {x} end), 0D)"


def _pop_std(n: str, total: str, squares: str, unit: int = 1) -> str:
    """Population deviation from count, sum and sum of squares of whole numbers, ``unit`` of them to one.

    Both products are whole decimals of 38 digits, so nothing cancels however many rows
    there are: n * squares stays below 10^38 for 10^10 rows of values up to 10^9.
    """
    n_, total_, squares_ = (f"cast({v} as decimal(38, 0))" for v in (n, total, squares))
    return f"sqrt(cast({n_} * {squares_} - {total_} * {total_} as double)) / nullif({n} * {unit}L, 0)"


#: Sizes are squared as whole millionths.
SIZE_UNIT = 1_000_000
SIZE_UNITS = f"try_cast(prod_size * {SIZE_UNIT} as decimal(18, 0))"


SALE_COLUMNS = (
    "cust_id",
    "sale_id",
    "order_date",
    "sale_revenue",
    "sale_discount_applied",
    "prod_size",
    "prod_web_only",
    "prod_outlet",
    "is_returned",
    "days_to_pack",
)


def _flag_sums(flag: str, cond: str, tail: str) -> dict[str, str]:
    picked = f"case when {cond} then {flag} end"
    return {f"{flag}_sum_{tail}": f"sum({picked})", f"{flag}_cnt_{tail}": f"count({picked})"}


FLAGS = ("prod_web_only", "prod_outlet")


def sale_level(items: DataFrame, settings: FeatureSettings, place: Place) -> DataFrame:
    """One row per customer and sale with everything that adds up over items."""
    rev, disc = "sale_revenue", "abs(sale_discount_applied)"
    aggs = {
        "rows_all": "count(*)",
        "rows_returned": "sum(is_returned)",
        "first_ts": "min(order_date)",
        "last_ts": "max(order_date)",
        "rows_kept": f"count_if({KEPT})",
        "rev_kept": _sum_if(KEPT, rev),
        "disc_kept": _sum_if(KEPT, disc),
        "disc_cnt": f"count(case when {KEPT} then {disc} end)",
        "disc_max": f"max(case when {KEPT} then {disc} end)",
        "discounted": f"count_if({KEPT} and {disc} > 0)",
        "pack_n": f"count(case when {KEPT} then days_to_pack end)",
        "pack_sum": f"sum(case when {KEPT} then days_to_pack end)",
        "pack_sq": f"sum(case when {KEPT} then days_to_pack * days_to_pack end)",
        "pack_max": f"max(case when {KEPT} then days_to_pack end)",
        "size_n": "count(prod_size)",
        "size_sum": "sum(prod_size)",
        "units_n": f"count({SIZE_UNITS})",
        "units_sum": f"sum({SIZE_UNITS})",
        "units_sq": f"sum({SIZE_UNITS} * {SIZE_UNITS})",
        "size_lo": "min(prod_size)",
        "size_hi": "max(prod_size)",
        "rev_returned": f"sum(case when {RETURNED} then {rev} end)",
        "last_return_ts": f"max(case when {RETURNED} then order_date end)",
    }
    for flag in FLAGS:
        aggs |= _flag_sums(flag, "true", "all") | _flag_sums(flag, KEPT, "kept")
    for d in RETURN_LOOKBACK_DAYS:
        aggs[f"returned_{d}"] = f"count_if({RETURNED} and {in_window(settings, d)})"
    for d in LOOKBACK_DAYS:
        w = f"{KEPT} and {in_window(settings, d)}"
        aggs |= {
            f"rows_{d}": f"count_if({w})",
            f"rev_{d}": _sum_if(w, rev),
            f"disc_{d}": _sum_if(w, disc),
            f"discounted_{d}": f"count_if({w} and {disc} > 0)",
        }
        for flag in FLAGS:
            aggs |= _flag_sums(flag, w, str(d))
    return grouped(place(items.select(*SALE_COLUMNS)), ["cust_id", "sale_id"], aggs)


def _basket_ratio(disc: str, rev: str) -> str:
    return sql_ratio(disc, f"{rev} + {disc}")


def sale_features(items: DataFrame, settings: FeatureSettings, place: Place) -> DataFrame:
    """Counts, revenue, recency, sizes, flags, returns, windows and baskets."""
    named = "sale_id is not null"
    sold = f"{named} and rows_kept > 0"

    def when(cond: str, x: str) -> str:
        return f"case when {cond} then {x} end"

    def sums(*names: str) -> dict[str, str]:
        return {n: f"sum({n})" for n in names}

    aggs = {
        "n_items": f"coalesce(sum({when(named, 'rows_all')}), 0)",
        "n_sales": "count(sale_id)",
        "n_returns": "sum(rows_returned)",
        "first_purchase": "min(first_ts)",
        "last_purchase": "max(last_ts)",
        "n_items_non_returned": f"sum({when(named, 'rows_kept')})",
        "n_sales_non_returned": f"count_if({sold})",
        "max_discount_per_item": "max(disc_max)",
        "max_days_to_pack": "max(pack_max)",
        "size_min": "min(size_lo)",
        "size_max": "max(size_hi)",
        "last_return_ts": "max(last_return_ts)",
        "avg_discount_per_sale": f"avg({when(sold, 'disc_kept')})",
        "avg_sale_discount_ratio": f"avg({when(sold, _basket_ratio('disc_kept', 'rev_kept'))})",
        "avg_items_per_sale": f"avg({when(sold, 'rows_kept')})",
        **sums("rows_kept", "rev_kept", "disc_kept", "disc_cnt", "discounted", "rev_returned"),
        **sums("pack_n", "size_n", "size_sum", "units_n"),
        **{n: f"sum(cast({n} as decimal(28, 0)))" for n in ("pack_sum", "pack_sq", "units_sum")},
        "units_sq": "sum(units_sq)",
        **sums(*[f"{f}_{k}_{part}" for f in FLAGS for k in ("sum", "cnt") for part in ("all", "kept")]),
    }
    for d in RETURN_LOOKBACK_DAYS:
        aggs[f"n_returns_last_{d}d"] = f"coalesce(sum({when(named, f'returned_{d}')}), 0)"
    for d in LOOKBACK_DAYS:
        live = f"{named} and rows_{d} > 0"
        aggs |= {
            f"n_items_last_{d}d": f"coalesce(sum({when(named, f'rows_{d}')}), 0)",
            f"n_sales_last_{d}d": f"count_if({live})",
            f"revenue_last_{d}d": f"sum(rev_{d})",
            f"discount_last_{d}d": f"sum(disc_{d})",
            f"avg_basket_value_last_{d}d": f"avg({when(live, f'rev_{d}')})",
            f"std_basket_value_last_{d}d": f"stddev_pop({when(live, f'rev_{d}')})",
            f"avg_items_per_sale_last_{d}d": f"avg({when(live, f'rows_{d}')})",
            f"avg_sale_discount_ratio_last_{d}d": f"avg({when(live, _basket_ratio(f'disc_{d}', f'rev_{d}'))})",
            **sums(f"rows_{d}", f"discounted_{d}"),
            **sums(*[f"{f}_{k}_{d}" for f in FLAGS for k in ("sum", "cnt")]),
        }
    sales = sale_level(items, settings, place)
    return _derive_sale_features(grouped(sales, ["cust_id"], aggs), settings)


def _derive_sale_features(agg: DataFrame, settings: FeatureSettings) -> DataFrame:
    ref = sql_midnight(settings.reference_date)
    first = {
        "total_revenue_net": "case when rows_kept > 0 then rev_kept end",
        "total_discount": "case when rows_kept > 0 then disc_kept end",
        "customer_lifetime_days": sql_days("first_purchase", "last_purchase"),
        "days_since_last_purchase": sql_days("last_purchase", ref),
        "days_from_first_purchase_to_reference": sql_days("first_purchase", ref),
        "share_web_only": sql_ratio("prod_web_only_sum_all", "prod_web_only_cnt_all"),
        "share_outlet": sql_ratio("prod_outlet_sum_all", "prod_outlet_cnt_all"),
        "share_discounted_items": sql_ratio("discounted", "rows_kept"),
        "returned_revenue_sum": "abs(rev_returned)",
    }
    for d in LOOKBACK_DAYS:
        s = f"last_{d}d"
        first[f"share_discounted_items_{s}"] = sql_ratio(f"discounted_{d}", f"rows_{d}")
        first[f"share_outlet_{s}"] = sql_ratio(f"prod_outlet_sum_{d}", f"prod_outlet_cnt_{d}")
        first[f"share_web_only_{s}"] = sql_ratio(f"prod_web_only_sum_{d}", f"prod_web_only_cnt_{d}")
    second = {
        "total_revenue_gross": "total_revenue_net + total_discount",
        "observation_days_total": "days_from_first_purchase_to_reference + 1",
        "avg_revenue_per_day_last_90d": "revenue_last_90d / 90",
        "avg_rev_per_sale": sql_ratio("total_revenue_net", "n_sales_non_returned"),
        "avg_days_between_purchases": sql_ratio("customer_lifetime_days", "n_sales"),
        "avg_revenue_per_day_total": sql_ratio(
            "total_revenue_net", "days_from_first_purchase_to_reference + 1"
        ),
    }
    ratios = {
        "avg_rev_per_item": ("total_revenue_net", "n_items_non_returned"),
        "monetary_per_item": ("total_revenue_net", "n_items_non_returned"),
        "return_rate": ("n_returns", "n_items"),
        "discount_ratio": ("total_discount", "total_revenue_gross"),
        "days_since_last_vs_avg": ("days_since_last_purchase", "avg_days_between_purchases"),
        "recency_ratio": ("customer_lifetime_days", "days_from_first_purchase_to_reference"),
        "purchase_frequency": ("n_sales_non_returned", "customer_lifetime_days + 1"),
        "items_per_sale": ("n_items_non_returned", "n_sales_non_returned"),
        "avg_days_to_pack": ("cast(pack_sum as double)", "pack_n"),
        "size_mean": ("size_sum", "size_n"),
        "share_web_only_non_returned": ("prod_web_only_sum_kept", "prod_web_only_cnt_kept"),
        "share_outlet_non_returned": ("prod_outlet_sum_kept", "prod_outlet_cnt_kept"),
        "avg_discount_per_item": ("disc_kept", "disc_cnt"),
        "revenue_last_30d_to_90d": ("revenue_last_30d", "revenue_last_90d"),
        "revenue_last_90d_to_365d": ("revenue_last_90d", "revenue_last_365d"),
        "n_sales_last_30d_to_90d": ("n_sales_last_30d", "n_sales_last_90d"),
        "n_sales_last_90d_to_365d": ("n_sales_last_90d", "n_sales_last_365d"),
        "avg_basket_value_last_30d_to_total": ("avg_basket_value_last_30d", "avg_rev_per_sale"),
        "avg_basket_value_last_90d_to_total": ("avg_basket_value_last_90d", "avg_rev_per_sale"),
        "revenue_velocity": ("avg_revenue_per_day_last_90d", "avg_revenue_per_day_total"),
        "returned_revenue_ratio": ("returned_revenue_sum", "total_revenue_gross"),
    }
    third = {name: sql_ratio(a, b) for name, (a, b) in ratios.items()}
    third |= {
        "std_days_to_pack": _pop_std("pack_n", "pack_sum", "pack_sq"),
        "size_std": _pop_std("units_n", "units_sum", "units_sq", SIZE_UNIT),
        "days_since_last_return": sql_days("last_return_ts", ref),
    }
    for share in ("share_discounted_items", "share_outlet", "share_web_only"):
        third[f"{share}_last_90d_delta"] = f"{share}_last_90d - {share}"
    return with_columns(with_columns(with_columns(agg, first), second), third)


def order_features(items: DataFrame, settings: FeatureSettings, place: Place) -> DataFrame:
    """Gaps between order dates and the calendar features, over kept items.

    Rows are first brought to one per customer and calendar day, so the window below
    never holds more rows than there are days. Two different times on one day are less
    than a day apart, which is a gap of 0 whole days; those gaps only need counting,
    and just the gap to the day before has to be looked at.
    """
    kept = items.where(f"{KEPT} and order_date is not null").select("cust_id", "order_date")
    stamps = grouped(
        place(kept),
        {"cust_id": "cust_id", "day": "cast(order_date as date)", "order_date": "order_date"},
        {"rows": "count(*)"},
    )
    days = grouped(
        stamps,
        ["cust_id", "day"],
        {
            "rows": "sum(rows)",
            "stamps": "count(*)",
            "first_ts": "min(order_date)",
            "last_ts": "max(order_date)",
        },
    )
    by_day = "over (partition by cust_id order by day)"
    steps = with_columns(
        days,
        {
            "gap": sql_days(f"lag(last_ts) {by_day}", "first_ts"),
            "new_month": f"coalesce(trunc(day, 'month') <> lag(trunc(day, 'month')) {by_day}, true)",
        },
    )
    steps = with_columns(steps, {"latest": "if(stamps > 1, 0, gap)"})
    steps = with_columns(
        steps,
        {
            "second": f"case when stamps > 2 then 0 when stamps = 2 then gap else lag(latest) {by_day} end"
        },
    )
    months = range(1, 13)
    agg = grouped(
        steps,
        ["cust_id"],
        {
            "stamps": "sum(stamps)",
            "rows": "sum(rows)",
            "gap_sum": "coalesce(sum(gap), 0)",
            "gap_sq": "coalesce(sum(gap * gap), 0)",
            "min_days_between_orders": "cast(min(if(stamps > 1, 0, gap)) as bigint)",
            "max_days_between_orders": "cast(max(coalesce(gap, if(stamps > 1, 0, null))) as bigint)",
            "fast": "sum(stamps - 1 + if(gap <= 60, 1, 0))",
            "last_row": "max_by(struct(latest, second), day)",
            "n_active_months": "count_if(new_month)",
            **{f"m{m}": f"sum(if(month(day) = {m}, rows, 0))" for m in months},
        },
    )

    def entropy(parts: list[str]) -> str:
        return " + ".join(f"if({p} > 0, -{p} * ln({p}), 0D)" for p in parts)

    shares = {f"sm{m}": f"m{m} / rows" for m in months}
    quarters = {
        f"purchase_share_q{q}": f"({' + '.join(f'm{m}' for m in range(3 * q - 2, 3 * q + 1))}) / rows"
        for q in range(1, 5)
    }
    means = {
        "avg_days_between_orders": "gap_sum / nullif(stamps - 1, 0)",
        "std_days_between_orders": _pop_std("(stamps - 1)", "gap_sum", "gap_sq"),
        "last_days_between_orders": "cast(last_row.latest as bigint)",
        "avg_last_2_gaps": "(last_row.latest + coalesce(last_row.second, last_row.latest)) / 2D",
        "share_fast_repeat_60d": "fast / stamps",
    }
    finals = {
        "top_month_share": f"greatest({', '.join(shares)})",
        "n_active_purchase_months": " + ".join(f"cast(m{m} > 0 as bigint)" for m in months),
        "month_purchase_entropy": entropy(list(shares)),
        "top_quarter_share": f"greatest({', '.join(quarters)})",
        "quarter_purchase_entropy": entropy(list(quarters)),
        "last_vs_avg_days_between_orders": sql_ratio("last_days_between_orders", "avg_days_between_orders"),
        "gap_cv": sql_ratio("std_days_between_orders", "avg_days_between_orders"),
        "recent_gap_trend": sql_ratio("avg_last_2_gaps", "avg_days_between_orders"),
    }
    return with_columns(with_columns(agg, shares | quarters | means), finals)


def attribute_features(
    items: DataFrame,
    settings: FeatureSettings,
    place: Place,
    attributes: tuple[str, ...] = CORE_ATTRIBUTES + DETAIL_ATTRIBUTES,
    with_size: bool = True,
    with_product: bool = False,
) -> DataFrame:
    """Dominant shares and distinct counts, from (customer, attribute, value) counts.

    The category matrix is never spread out. An attribute's rows inside the last 90
    days are counted next to all rows, and the newest kept date of a value tells in
    which of the nested windows it occurs.
    """
    names = list(attributes)
    columns = {a: a for a in names}
    if MATERIAL_MAIN in columns:
        columns[MATERIAL_MAIN] = "trim(split_part(prod_material, ',', 1))"
    if with_size:
        names.append("prod_size")
        columns["prod_size"] = "cast(prod_size as string)"
    if with_product:
        names.append("prod_id")
        columns["prod_id"] = "cast(prod_id as string)"
    code = {a: i for i, a in enumerate(names)}

    end = sql_midnight(settings.reference_date)
    narrow = items.selectExpr(
        "cust_id",
        f"case when {KEPT} and order_date <= {end} then order_date end as kept_ts",
        f"{RETURNED} as returned",
        *[f"{columns[a]} as {a}" for a in names],
    )
    pairs = ", ".join(f"named_struct('attr', cast({code[a]} as tinyint), 'value', {a})" for a in names)
    long = place(narrow).selectExpr("cust_id", "kept_ts", "returned", f"inline(array({pairs}))")
    starts = {d: f"{end} - interval {d - 1} days" for d in LOOKBACK_DAYS}
    counts = grouped(
        long.where("value is not null"),
        ["cust_id", "attr", "value"],
        {
            "n": "count(*)",
            "n90": f"count_if(kept_ts >= {starts[90]})",
            "kept_ts": "max(kept_ts)",
            "returned": "max(returned)",
        },
    )
    per_attribute = grouped(
        counts,
        ["cust_id", "attr"],
        {
            "share": "max(n) / sum(n)",
            "share90": "max(n90) / nullif(sum(n90), 0)",
            "distinct_values": "count(*)",
            "distinct_returned": "count_if(returned)",
            **{f"distinct_{d}": f"count_if(kept_ts >= {starts[d]})" for d in LOOKBACK_DAYS},
        },
    )

    def of(a: str, column: str) -> str:
        return f"max(case when attr = {code[a]} then {column} end)"

    aggs = {distinct_name(a): of(a, "distinct_values") for a in names}
    later = {}
    for a in attributes:
        aggs[share_name(a)] = of(a, "share")
        if a in RECENT_ATTRIBUTES:
            recent = f"{share_name(a)}_last_90d"
            aggs[recent] = of(a, "share90")
            later[f"{recent}_delta"] = f"{recent} - {share_name(a)}"
    if "prod_brand" in code:
        for d in LOOKBACK_DAYS:
            aggs[f"n_unique_brands_last_{d}d"] = of("prod_brand", f"distinct_{d}")
        aggs["n_brands_returned"] = of("prod_brand", "distinct_returned")
        later["n_unique_brands_last_90d_to_total"] = sql_ratio("n_unique_brands_last_90d", "n_unique_brands")
    out = with_columns(grouped(per_attribute, ["cust_id"], aggs), later)
    if with_size:
        out = out.withColumnRenamed("prod_size_n_unique", "size_n_unique")
    if with_product:
        out = out.withColumnRenamed("prod_id_n_unique", "n_unique_products")
    return out
