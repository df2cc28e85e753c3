"""The customer feature store: one row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerscope.features import passes
from buyerscope.features.medians import basket_medians, size_medians
from buyerscope.functions.exprs import days_between, sql_ratio, with_columns
from buyerscope.operators.skew import HotSplit
from buyerscope.schema import numeric_columns
from buyerscope.settings import LOOKBACK_DAYS, RETURN_LOOKBACK_DAYS, FeatureSettings

# Names, order and drop list of the published feature table.
_BASE = [
    "n_items", "n_sales", "n_returns", "first_purchase", "last_purchase",
    "n_items_non_returned", "n_sales_non_returned", "total_revenue_net", "total_discount",
    "total_revenue_gross", "customer_lifetime_days", "recency_days", "avg_rev_per_item",
    "avg_rev_per_sale", "return_rate", "discount_ratio", "avg_days_between_purchases",
    "monetary_per_item", "days_since_last_purchase", "days_since_last_vs_avg",
    "days_from_first_purchase_to_reference", "recency_ratio", "purchase_frequency",
    "items_per_sale",
]
_GAPS = [
    "avg_days_between_orders", "std_days_between_orders", "min_days_between_orders",
    "max_days_between_orders", "last_days_between_orders", "last_vs_avg_days_between_orders",
    "gap_cv", "avg_last_2_gaps", "recent_gap_trend", "share_fast_repeat_60d",
]
_PACK = ["avg_days_to_pack", "std_days_to_pack", "max_days_to_pack"]
_VARIETY = [
    "top_brand_share", "n_unique_brands", "n_unique_products", "top_color_share",
    "n_unique_colors", "prod_type_1_dominant_share", "prod_type_1_n_unique",
    "prod_type_3_dominant_share", "prod_type_3_n_unique", "prod_type_4_dominant_share",
    "prod_type_4_n_unique", "prod_type_5_dominant_share", "prod_type_5_n_unique",
]
_SIZE = ["size_mean", "size_std", "size_min", "size_max", "size_median", "size_n_unique"]
_CALENDAR = [
    "top_season_share", "n_unique_seasons", "n_active_months", "active_month_ratio",
    "top_month_share", "n_active_purchase_months", "month_purchase_entropy",
    "top_quarter_share", "quarter_purchase_entropy", "purchase_share_q1",
    "purchase_share_q2", "purchase_share_q3", "purchase_share_q4",
]
_ORDER_CALENDAR = [n for n in _CALENDAR[2:] if n != "active_month_ratio"]
_DISCOUNT = [
    "avg_discount_per_item", "max_discount_per_item", "share_discounted_items",
    "avg_discount_per_sale", "avg_sale_discount_ratio", "avg_items_per_sale",
]
_WINDOW_PARTS = [
    "n_items", "n_sales", "revenue", "discount", "n_unique_brands", "share_discounted_items",
    "share_outlet", "share_web_only", "avg_basket_value", "median_basket_value",
    "std_basket_value", "avg_items_per_sale", "avg_sale_discount_ratio",
]
_RATIOS = [
    "revenue_last_30d_to_90d", "revenue_last_90d_to_365d", "n_sales_last_30d_to_90d",
    "n_sales_last_90d_to_365d", "avg_basket_value_last_30d_to_total",
    "avg_basket_value_last_90d_to_total", "share_discounted_items_last_90d_delta",
    "share_outlet_last_90d_delta", "share_web_only_last_90d_delta",
    "n_unique_brands_last_90d_to_total", "avg_revenue_per_day_last_90d",
    "observation_days_total", "avg_revenue_per_day_total", "revenue_velocity",
]
_RETURNS = ["n_brands_returned", "returned_revenue_sum", "days_since_last_return"]
REDUNDANT = [
    "observation_days_total", "days_since_last_purchase", "monetary_per_item",
    "avg_items_per_sale", "avg_revenue_per_day_last_90d", "median_basket_value_last_30d",
    "median_basket_value_last_90d", "median_basket_value_last_180d",
    "n_sales_last_30d_to_90d", "median_basket_value_last_365d", "n_sales_last_90d_to_365d",
    "avg_last_2_gaps", "avg_sale_discount_ratio", "prod_type_5_dominant_share_last_90d",
    "prod_type_3_dominant_share_last_90d", "top_color_share_last_90d", "size_median",
    "avg_basket_value_last_30d", "n_unique_products", "avg_items_per_sale_last_30d",
    "prod_type_1_dominant_share_last_90d",
]


def catalogue() -> list[str]:
    """All feature names in published order, redundant ones included."""
    windows = [f"{part}_last_{d}d" for d in LOOKBACK_DAYS for part in _WINDOW_PARTS]
    shifts = []
    for a in passes.RECENT_ATTRIBUTES:
        name = f"{passes.share_name(a)}_last_90d"
        shifts += [name, f"{name}_delta"]
    details = []
    for a in passes.DETAIL_ATTRIBUTES:
        details += [passes.share_name(a), passes.distinct_name(a)]
    return [
        *_BASE, *_GAPS, *_PACK, *_VARIETY, "share_web_only", "share_web_only_non_returned",
        *_SIZE, *_CALENDAR, "share_outlet", "share_outlet_non_returned", *_DISCOUNT,
        *windows, *_RATIOS, *_RETURNS, *[f"n_returns_last_{d}d" for d in RETURN_LOOKBACK_DAYS],
        "returned_revenue_ratio", *shifts, *details,
    ]


def kept_features() -> list[str]:
    return [name for name in catalogue() if name not in REDUNDANT]


def hot_split(items: DataFrame, settings: FeatureSettings) -> HotSplit:
    return HotSplit.detect(items, "cust_id", settings.hot_share, settings.hot_floor)


def cutoff_scalar(items: DataFrame):
    """One day after the newest order of the whole table, as a scalar subquery."""
    return items.agg((F.max("order_date") + F.expr("interval 1 day")).alias("cutoff")).scalar()


def with_recency(df: DataFrame, items: DataFrame) -> DataFrame:
    return df.withColumn("recency_days", days_between("last_purchase", cutoff_scalar(items)))


def fill_numeric(df: DataFrame) -> DataFrame:
    """0 for missing numbers; missing dates stay missing."""
    return df.fillna(0, subset=numeric_columns(df))


def _source(name: str) -> str:
    """Which pass computes a feature."""
    if name in _GAPS or name in _ORDER_CALENDAR:
        return "orders"
    if name.startswith("median_") or name == "size_median":
        return "medians"
    if name == "active_month_ratio":
        return "sales+orders"
    if name.startswith("n_unique") or name in ("size_n_unique", "n_brands_returned"):
        return "attributes"
    if "dominant_share" in name or name.endswith("_n_unique"):
        return "attributes"
    if name.startswith(("top_brand", "top_color", "top_season")):
        return "attributes"
    return "sales"


def _attributes_for(names: list[str]) -> tuple[str, ...]:
    """The attribute columns the wanted features are made from."""
    everything = passes.CORE_ATTRIBUTES + passes.DETAIL_ATTRIBUTES + (passes.MATERIAL_MAIN,)
    brand = any(n.startswith("n_unique_brands") or n == "n_brands_returned" for n in names)
    return tuple(
        a
        for a in everything
        if (a == "prod_brand" and brand)
        or any(n.startswith(passes.share_name(a)) or n == passes.distinct_name(a) for n in names)
    )


def columns_read(names: list[str]) -> list[str]:
    """The columns of typed transactions that the named features are made from."""
    wanted = {passes.MATERIAL_MAIN: "prod_material"}
    read = [*passes.SALE_COLUMNS, *(wanted.get(a, a) for a in _attributes_for(names))]
    if "n_unique_products" in names:
        read.append("prod_id")
    return list(dict.fromkeys(read))


def select_features(
    items: DataFrame,
    settings: FeatureSettings,
    names: list[str],
    split: HotSplit | None = None,
) -> DataFrame:
    """``cust_id`` plus the named features, running only the passes they need.

    Every customer of ``items`` gets a row. The pass over sales sees them all; without it
    they are listed by one more grouping, and those without a value get 0.
    """
    split = split or hot_split(items, settings)
    sources = {part for n in names for part in _source(n).split("+")}
    attributes = _attributes_for(names)

    def job(rows: DataFrame, place) -> DataFrame:
        parts = []
        if "sales" in sources:
            parts.append(passes.sale_features(rows, settings, place))
        if "orders" in sources:
            parts.append(passes.order_features(rows, settings, place))
        if "attributes" in sources:
            parts.append(
                passes.attribute_features(
                    rows,
                    settings,
                    place,
                    attributes=attributes,
                    with_size="size_n_unique" in names,
                    with_product="n_unique_products" in names,
                )
            )
        out = parts[0]
        how = "left" if "sales" in sources else "full"
        for part in parts[1:]:
            out = out.join(part, "cust_id", how)
        if "active_month_ratio" in names:
            span = "(nullif(days_from_first_purchase_to_reference, 0) + 1) / 30D"
            out = with_columns(out, {"active_month_ratio": sql_ratio("n_active_months", span)})
        return out

    wide = split.run(items, job)
    if "sales" not in sources:
        wide = items.select("cust_id").distinct().join(wide, "cust_id", "left")
    if "recency_days" in names:
        wide = with_recency(wide, items)
    if any(n.startswith("median_") for n in names):
        wide = wide.join(basket_medians(items, settings), "cust_id", "left")
    if "size_median" in names:
        wide = wide.join(size_medians(items), "cust_id", "left")
    return fill_numeric(wide.select("cust_id", *names))


def customer_features(
    items: DataFrame, settings: FeatureSettings = FeatureSettings(), split: HotSplit | None = None
) -> DataFrame:
    """The whole feature table of typed transactions, one row per ``cust_id``.

    Three passes, each placed by customer, joined on the layout they already share.
    """
    names = catalogue() if settings.keep_redundant else kept_features()
    return select_features(items, settings, names, split)
