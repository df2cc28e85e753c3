"""Registered queries of the feature store, one per feature family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buyerscope.features import preferences, store
from buyerscope.features.passes import CORE_ATTRIBUTES, DETAIL_ATTRIBUTES, RECENT_ATTRIBUTES
from buyerscope.features.passes import distinct_name, share_name
from buyerscope.plans.features_check import feature_check, feature_tables
from buyerscope.plans.shape import shaped, sql_num
from buyerscope.sources import retail_view as view
from buyerscope.sources.staging import staged

_W = (30, 90, 180, 365)


def _per_window(*parts: str) -> list[str]:
    return [f"{p}_last_{d}d" for d in _W for p in parts]


FAMILIES: dict[str, list[str]] = {
    "base_counts": [
        "n_items", "n_sales", "n_returns", "first_purchase", "last_purchase",
        "n_items_non_returned", "n_sales_non_returned",
    ],
    "revenue_features": [
        "total_revenue_net", "total_discount", "total_revenue_gross", "avg_rev_per_item",
        "monetary_per_item", "avg_rev_per_sale", "return_rate", "discount_ratio", "items_per_sale",
    ],
    "lifetime_recency": [
        "customer_lifetime_days", "avg_days_between_purchases", "days_since_last_purchase",
        "days_since_last_vs_avg", "days_from_first_purchase_to_reference", "recency_ratio",
        "purchase_frequency",
    ],
    "recency_cutoff": ["last_purchase", "recency_days"],
    "order_gaps": [
        "avg_days_between_orders", "std_days_between_orders", "min_days_between_orders",
        "max_days_between_orders", "last_days_between_orders",
        "last_vs_avg_days_between_orders", "gap_cv",
    ],
    "recent_gap_trend": ["avg_last_2_gaps", "recent_gap_trend"],
    "fast_repeat": ["share_fast_repeat_60d"],
    "pack_features": ["avg_days_to_pack", "std_days_to_pack", "max_days_to_pack"],
    "attr_shares": [
        n for a in CORE_ATTRIBUTES for n in (share_name(a), distinct_name(a))
    ] + ["n_unique_products"],
    "attr_shares_extra": [
        n for a in DETAIL_ATTRIBUTES for n in (share_name(a), distinct_name(a))
    ] + preferences.MATERIAL,
    "flag_shares": [
        "share_web_only", "share_web_only_non_returned", "share_outlet", "share_outlet_non_returned",
    ],
    "size_stats": ["size_mean", "size_std", "size_min", "size_max", "size_median", "size_n_unique"],
    "calendar_features": [
        "n_active_months", "active_month_ratio", "purchase_share_q1", "purchase_share_q2",
        "purchase_share_q3", "purchase_share_q4",
    ],
    "calendar_entropy": [
        "top_month_share", "n_active_purchase_months", "month_purchase_entropy",
        "top_quarter_share", "quarter_purchase_entropy",
    ],
    "discount_features": ["avg_discount_per_item", "max_discount_per_item", "share_discounted_items"],
    "sale_level_features": ["avg_discount_per_sale", "avg_sale_discount_ratio", "avg_items_per_sale"],
    "window_activity": _per_window("n_items", "n_sales", "revenue", "discount", "n_unique_brands"),
    "window_shares": _per_window("share_discounted_items", "share_outlet", "share_web_only"),
    "window_baskets": _per_window(
        "avg_basket_value", "median_basket_value", "std_basket_value", "avg_items_per_sale",
        "avg_sale_discount_ratio",
    ),
    "window_ratios": [
        "revenue_last_30d_to_90d", "revenue_last_90d_to_365d", "n_sales_last_30d_to_90d",
        "n_sales_last_90d_to_365d", "avg_basket_value_last_30d_to_total",
        "avg_basket_value_last_90d_to_total", "share_discounted_items_last_90d_delta",
        "share_outlet_last_90d_delta", "share_web_only_last_90d_delta",
        "n_unique_brands_last_90d_to_total",
    ],
    "revenue_velocity": [
        "avg_revenue_per_day_last_90d", "observation_days_total", "avg_revenue_per_day_total",
        "revenue_velocity",
    ],
    "returns_features": [
        "n_brands_returned", "returned_revenue_sum", "returned_revenue_ratio",
        "days_since_last_return", "n_returns_last_90d", "n_returns_last_180d", "n_returns_last_365d",
    ],
    "preference_shift": [
        f"{share_name(a)}_last_90d{tail}" for a in RECENT_ATTRIBUTES for tail in ("", "_delta")
    ],
    "customer_features": store.kept_features(),
}

# Families fed by more than one pass read a staged table, so that the joins behind the
# transactions run once.
_SEVERAL_PASSES = {"calendar_features", "window_activity", "window_ratios", "customer_features", "returns_features"}


def _table(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Staged transactions with the columns that the named features are made from."""
    return staged(view.transactions(spark, sf_dir).select(*store.columns_read(names)), "items")


def _family(name: str, names: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        items = _table(spark, sf_dir, names) if name in _SEVERAL_PASSES else view.transactions(spark, sf_dir)
        return shaped(store.select_features(items, view.FEATURES, names))

    return run


def _customer_features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, store.catalogue())
    return shaped(store.customer_features(items, view.FEATURES.with_(keep_redundant=True)))


def _hot_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the busiest customers sent down the hot path."""
    items = _table(spark, sf_dir, store.kept_features())
    settings = view.FEATURES.with_(hot_share=0.001, hot_floor=0)
    split = store.hot_split(items, settings)
    return shaped(store.customer_features(items, settings, split))


def _season_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(preferences.season_shares(view.transactions(spark, sf_dir)))


def _share_high_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(preferences.high_revenue_share(view.transactions(spark, sf_dir)))


def _first_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*preferences.FIRST_TABLE, *preferences.MATERIAL, "top_season_share"]  # the season for its shares
    return shaped(preferences.first_table(_table(spark, sf_dir, names), view.FEATURES))


QUERIES = {name: _family(name, cols) for name, cols in FAMILIES.items()}
QUERIES["customer_features_full"] = _customer_features_full
QUERIES["customer_features_hot_path"] = _hot_path
QUERIES["season_shares"] = _season_shares
QUERIES["share_high_revenue"] = _share_high_revenue
QUERIES["first_feature_table"] = _first_table

_SEASON = """seasons AS (SELECT cust_id, regexp_extract(prod_season, '^([A-Z]+)', 1) AS code FROM tx),
season_shares AS (SELECT cust_id,
  avg(CASE WHEN code = 'Z' THEN 1.0 ELSE 0.0 END) AS share_summer_items,
  avg(CASE WHEN code = 'W' THEN 1.0 ELSE 0.0 END) AS share_winter_items,
  avg(CASE WHEN code IN ('NOS', 'CONS') THEN 1.0 ELSE 0.0 END) AS share_other_season_items,
  avg(CASE WHEN code IN ('Z', 'W') THEN 1.0 ELSE 0.0 END) AS share_season_type_main,
  avg(CASE WHEN code IN ('MZ', 'MW') THEN 1.0 ELSE 0.0 END) AS share_season_type_mid_season,
  avg(CASE WHEN code IN ('SZ', 'SW') THEN 1.0 ELSE 0.0 END) AS share_season_type_special,
  avg(CASE WHEN code IN ('NOS', 'CONS') THEN 1.0 ELSE 0.0 END) AS share_season_type_other
  FROM seasons GROUP BY 1),
luxury AS (SELECT cust_id, avg(CASE WHEN sale_revenue > e THEN 1.0 ELSE 0.0 END) AS share_high_revenue_items
  FROM tx, (SELECT quantile_cont(sale_revenue, 0.6) AS e FROM tx) GROUP BY 1)"""


def _nums(names: list[str]) -> str:
    return ", ".join(sql_num(n, n) for n in names)


def _first_table_check() -> str:
    body = feature_check(preferences.FIRST_TABLE + preferences.MATERIAL)
    head, tail = body.rsplit("\nSELECT ", 1)
    extra = _nums(preferences.SEASON_SHARES + ["share_high_revenue_items"])
    cols, _ = tail.rsplit(" FROM feat", 1)
    return (
        f"{head},\n{_SEASON}\nSELECT {cols}, {extra} FROM feat "
        "LEFT JOIN season_shares USING (cust_id) LEFT JOIN luxury USING (cust_id)"
    )


ORACLE = {
    name: feature_check(cols) for name, cols in FAMILIES.items()
}
ORACLE["customer_features_full"] = feature_check(store.catalogue())
ORACLE["customer_features_hot_path"] = feature_check(store.kept_features())
ORACLE["season_shares"] = (
    f"{feature_tables()},\n{_SEASON}\nSELECT cast(cust_id as bigint) AS cust_id, "
    f"{_nums(preferences.SEASON_SHARES)} FROM season_shares"
)
ORACLE["share_high_revenue"] = (
    f"{feature_tables()},\n{_SEASON}\nSELECT cast(cust_id as bigint) AS cust_id, "
    f"{_nums(['share_high_revenue_items'])} FROM luxury"
)
ORACLE["first_feature_table"] = _first_table_check()
