"""Registered queries for the profiling tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from buyerscope.operators import profile
from buyerscope.plans.shape import shaped, sql_int, sql_num, sql_time
from buyerscope.schema import TRANSACTIONS
from buyerscope.settings import TARGET
from buyerscope.sources import retail_view as view

QUERIES: dict = {}
ORACLE: dict = {}
WITH = view.oracle_tables()
COLUMNS = TRANSACTIONS.fieldNames()
NOMINAL = [c for c in COLUMNS if c not in ("order_date", "pack_date", "sale_revenue", "sale_discount_applied")]
METRIC = ["sale_revenue", "sale_discount_applied", "prod_size"]


def _add(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return keep


def _per_column(columns, body) -> str:
    return WITH + "\n" + "\nUNION ALL ".join(body(c) for c in columns)


@_add(
    "profile_missing",
    _per_column(
        COLUMNS,
        lambda c: f"SELECT '{c}' AS column_name, {sql_int(f'count(*) - count({c})', 'n_missing')}, "
        f"{sql_num(f'(count(*) - count({c})) * 100.0 / count(*)', 'pct_missing')} FROM alltx",
    ),
)
def profile_missing(spark, d):
    return shaped(profile.missing(view.all_transactions(spark, d), COLUMNS))


@_add(
    "profile_nunique",
    _per_column(NOMINAL, lambda c: f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM alltx"),
)
def profile_nunique(spark, d):
    out = profile.distinct_counts(view.all_transactions(spark, d), NOMINAL)
    return shaped(out.select("column_name", "n_unique"))


@_add(
    "profile_nunique_null",
    _per_column(
        NOMINAL,
        lambda c: f"SELECT '{c}' AS column_name, "
        f"{sql_int(f'count(DISTINCT {c}) + max(case when {c} is null then 1 else 0 end)', 'n_unique_with_null')} FROM alltx",
    ),
)
def profile_nunique_null(spark, d):
    out = profile.distinct_counts(view.all_transactions(spark, d), NOMINAL)
    return shaped(out.select("column_name", "n_unique_with_null"))


def _describe_sql(columns: dict[str, str], source: str, probs) -> str:
    def one(n):
        e = columns[n]
        qs = ", ".join(sql_num(f"quantile_cont({e}, {p})", f"p{round(p * 100)}") for p in probs)
        return (
            f"SELECT '{n}' AS column_name, count({e}) AS n, {sql_num(f'avg({e})', 'mean')}, "
            f"{sql_num(f'stddev_samp({e})', 'std')}, {sql_num(f'min({e})', 'min')}, {sql_num(f'max({e})', 'max')}, "
            f"{qs} FROM {source}"
        )

    return WITH + "\n" + "\nUNION ALL ".join(one(n) for n in columns)


@_add("describe_numeric", _describe_sql({c: c for c in METRIC}, "alltx", (0.25, 0.5, 0.75)))
def describe_numeric(spark, d):
    items = view.all_transactions(spark, d)
    return shaped(profile.describe(items, {c: F.col(c) for c in METRIC}))


@_add(
    "describe_log",
    _describe_sql(
        {TARGET: TARGET, "log1p": f"ln(1 + {TARGET})"}, "train", (0.5, 0.9, 0.95, 0.99)
    ),
)
def describe_log(spark, d):
    labels = view.train_labels(spark, d)
    cols = {TARGET: F.col(TARGET), "log1p": F.log1p(TARGET)}
    return shaped(profile.describe(labels, cols, (0.5, 0.9, 0.95, 0.99)))


def _dates_sql(c: str) -> str:
    e = f"date_diff('second', timestamp '1970-01-01', {c})"
    return (
        f"SELECT '{c}' AS column_name, count({c}) AS n, {sql_time(f'min({c})', 'first')}, {sql_time(f'max({c})', 'last')}, "
        f"{sql_num(f'avg({e})', 'mean_epoch', 2)}, {sql_num(f'median({e})', 'median_epoch', 2)} FROM alltx"
    )


@_add("describe_dates", _per_column(["order_date", "pack_date"], _dates_sql))
def describe_dates(spark, d):
    return shaped(profile.describe_dates(view.all_transactions(spark, d), ["order_date", "pack_date"]), 2)


@_add(
    "describe_category",
    _per_column(
        NOMINAL,
        lambda c: f"(SELECT '{c}' AS column_name, cast(sum(m) over () as bigint) AS n, count(*) over () AS n_unique, "
        f"v AS top, m AS freq FROM (SELECT cast({c} as varchar) AS v, count(*) AS m FROM alltx WHERE {c} IS NOT NULL GROUP BY 1) "
        "ORDER BY m DESC, v LIMIT 1)",
    ),
)
def describe_category(spark, d):
    return shaped(profile.describe_categories(view.all_transactions(spark, d), NOMINAL))


# The columns whose values are listed.
_LISTED = ("prod_season", "prod_color", "prod_type_1", "prod_type_3", "prod_type_5", "prod_material", "prod_brand")


@_add(
    "value_counts",
    _per_column(
        _LISTED,
        lambda c: f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM alltx WHERE {c} IS NOT NULL GROUP BY {c}",
    ),
)
def value_counts(spark, d):
    counts = profile.long_counts(view.all_transactions(spark, d), list(_LISTED))
    return shaped(counts.where(F.col("value").isNotNull()))


@_add(
    "distinct_values",
    _per_column(_LISTED, lambda c: f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM alltx"),
)
def distinct_values(spark, d):
    items = view.all_transactions(spark, d)
    each = [
        profile.distinct_values(items, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"))
        for c in _LISTED
    ]
    return shaped(reduce(DataFrame.unionByName, each))


@_add(
    "zero_share",
    f"{WITH}\nSELECT count({TARGET}) AS n, {sql_num(f'avg(case when {TARGET} = 0 then 1.0 else 0.0 end) * 100', 'pct_zero')} FROM train",
)
def zero_share(spark, d):
    return shaped(profile.zero_share(view.train_labels(spark, d), TARGET))


@_add(
    "duplicate_rows",
    f"{WITH}\nSELECT {sql_int('sum(n - 1)', 'n_duplicates')}, {sql_num('sum(n - 1) * 100.0 / sum(n)', 'pct_duplicates')} "
    "FROM (SELECT *, count(*) AS n FROM alltx GROUP BY ALL)",
)
def duplicate_rows(spark, d):
    items = view.all_transactions(spark, d)
    return shaped(profile.duplicate_rows(items))


def _fence_sql(tail: str) -> str:
    def one(c):
        return (
            f"SELECT '{c}' AS column_name, {tail.format(c=c)} FROM alltx, (SELECT quantile_cont({c}, 0.25) AS a, "
            f"quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS b FROM alltx) GROUP BY a, m, b"
        )

    return _per_column(METRIC, one)


_OUT = "count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a))"
_IN = "FILTER ({c} >= a - 1.5 * (b - a) AND {c} <= b + 1.5 * (b - a))"


@_add(
    "iqr_outliers",
    _fence_sql(
        f"{sql_num('a', 'q1')}, {sql_num('b', 'q3')}, {_OUT} AS n_outliers, {sql_num(_OUT + ' * 100.0 / count(*)', 'pct_outliers')}"
    ),
)
def iqr_outliers(spark, d):
    return shaped(profile.iqr_outliers(view.all_transactions(spark, d), METRIC))


@_add(
    "boxplot_stats",
    _fence_sql(
        f"{sql_num('a', 'q1')}, {sql_num('m', 'median')}, {sql_num('b', 'q3')}, "
        f"{sql_num('min({c}) ' + _IN, 'whisker_low')}, {sql_num('max({c}) ' + _IN, 'whisker_high')}"
    ),
)
def boxplot_stats(spark, d):
    return shaped(profile.boxplot_stats(view.all_transactions(spark, d), METRIC))


@_add(
    "basket_products",
    f"{WITH}\nSELECT num_products, count(*) AS n_sales, cast(num_products > 1 as bigint) AS multiple_products "
    "FROM (SELECT sale_id, count(DISTINCT prod_id) AS num_products FROM alltx GROUP BY 1) GROUP BY 1",
)
def basket_products(spark, d):
    return shaped(profile.basket_products(view.all_transactions(spark, d)))


@_add(
    "sale_consistency",
    f"{WITH}\nSELECT cast(nd = 1 as bigint) AS order_date_consistent, cast(nc = 1 as bigint) AS customer_id_consistent, "
    "count(*) AS n_sales FROM (SELECT sale_id, count(DISTINCT order_date) AS nd, count(DISTINCT cust_id) AS nc "
    "FROM alltx GROUP BY sale_id) GROUP BY 1, 2",
)
def sale_consistency(spark, d):
    return shaped(profile.sale_consistency(view.all_transactions(spark, d)))


def _histogram_sql(e: str) -> str:
    return f"""{WITH}, v AS (SELECT {e} AS x FROM train), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT cast(least(floor((x - lo) / ((hi - lo) / 60)) + 1, 60) as bigint) AS bin, count(*) AS n FROM v, b GROUP BY 1"""


@_add("histogram", _histogram_sql(TARGET))
def histogram(spark, d):
    return shaped(profile.histogram(view.train_labels(spark, d), F.col(TARGET)))


@_add("histogram_log", _histogram_sql(f"ln(1 + {TARGET})"))
def histogram_log(spark, d):
    return shaped(profile.histogram(view.train_labels(spark, d), F.log1p(TARGET)))
