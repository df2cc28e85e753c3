"""Registered queries for RFM and lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from buyerscope.features import store
from buyerscope.lifetime import value
from buyerscope.lifetime.rfm import repeaters, rfm_summary
from buyerscope.plans.shape import shaped, sql_int, sql_num
from buyerscope.sources import retail_view as view
from buyerscope.sources.staging import staged

QUERIES: dict = {}
ORACLE: dict = {}

# Parameters under which scoring is compared; fits have their own queries.
PURCHASES = value.PurchaseModel(r=0.8, alpha=60.0, a=1.7, b=3.1)
SPEND = value.SpendModel(p=6.2, q=3.7, v=15.4)
HORIZON = 24.0

END = f"date '{view.REFERENCE_DATE.isoformat()}'"
WITH = f"""{view.oracle_tables()},
dd AS (SELECT cust_id, cast(order_date as date) AS day, sum(sale_revenue) AS v FROM tx WHERE order_date IS NOT NULL GROUP BY 1, 2),
nn AS (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY day) AS i FROM dd),
rfm AS (SELECT cust_id, count(*) - 1 AS frequency, date_diff('day', min(day), max(day)) AS recency,
  date_diff('day', min(day), {END}) AS t, coalesce(avg(v) FILTER (i > 1), 0) AS monetary_value FROM nn GROUP BY 1)"""
_P, _S = PURCHASES, SPEND
_ODDS = f"({_P.a} / ({_P.b} + greatest(frequency, 1) - 1)) * pow(({_P.alpha} + t) / ({_P.alpha} + recency), {_P.r} + frequency)"
_ALIVE = f"case when frequency = 0 then 1.0 else 1.0 / (1.0 + {_ODDS}) end"
_PX = f"({_P.r} + frequency)"
_AVERAGE = (
    f"case when frequency > 0 and monetary_value > 0 then greatest((1 - {_S.p} * frequency / ({_S.p} * frequency + {_S.q} - 1)) "
    f"* {_S.v} * {_S.p} / ({_S.q} - 1) + {_S.p} * frequency / ({_S.p} * frequency + {_S.q} - 1) * monetary_value, 0) else 0 end"
)
_TERM = (
    f"exp(lgamma({_P.r} + frequency + n) - lgamma({_P.r} + frequency) + lgamma({_P.b} + frequency + n) - lgamma({_P.b} + frequency) "
    f"- lgamma({_P.a} + {_P.b} + frequency - 1 + n) + lgamma({_P.a} + {_P.b} + frequency - 1) - lgamma(n + 1) "
    f"+ n * ln({HORIZON} / ({_P.alpha} + t + {HORIZON})))"
)
_EXPECTED = f"""terms AS (SELECT cust_id, sum({_TERM}) AS f FROM rfm, range(0, 400) g(n) GROUP BY 1),
expected AS (SELECT cust_id, ({_P.a} + {_P.b} + frequency - 1) / ({_P.a} - 1)
  * (1 - f * pow(({_P.alpha} + t) / ({_P.alpha} + t + {HORIZON}), {_P.r} + frequency))
  / (1 + case when frequency > 0 then {_ODDS} else 0 end) AS e FROM rfm JOIN terms USING (cust_id))"""


def _add(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def _rfm(spark, d):
    return rfm_summary(view.transactions(spark, d), view.LIFETIME)


_ID = sql_int("cust_id", "cust_id")


@_add(
    "rfm_summary",
    f'{WITH}\nSELECT {_ID}, {sql_int("frequency", "frequency")}, {sql_int("recency", "recency")}, '
    f'{sql_int("t", chr(34) + "T" + chr(34))}, {sql_num("monetary_value", "monetary_value")} FROM rfm',
)
def rfm_query(spark, d):
    return shaped(_rfm(spark, d))


@_add(
    "rfm_repeaters",
    f"{WITH}\nSELECT {_ID}, {sql_int('frequency', 'frequency')}, {sql_num('monetary_value', 'monetary_value')} "
    "FROM rfm WHERE frequency > 0 AND monetary_value > 0",
)
def rfm_repeaters(spark, d):
    return shaped(repeaters(_rfm(spark, d)).select("cust_id", "frequency", "monetary_value"))


@_add("prob_alive", f"{WITH}\nSELECT {_ID}, {sql_num(_ALIVE, 'prob_alive')} FROM rfm")
def prob_alive(spark, d):
    return shaped(_rfm(spark, d).select("cust_id", PURCHASES.prob_alive().alias("prob_alive")))


@_add("expected_avg_sales", f"{WITH}\nSELECT {_ID}, {sql_num(_AVERAGE, 'expected_avg_sales')} FROM rfm")
def expected_avg_sales(spark, d):
    return shaped(_rfm(spark, d).select("cust_id", SPEND.expected_average().alias("expected_avg_sales")))


@_add("expected_purchases", f"{WITH}, {_EXPECTED}\nSELECT {_ID}, {sql_num('e', 'pred_num_purchases')} FROM expected")
def expected_purchases(spark, d):
    return shaped(
        _rfm(spark, d).select("cust_id", PURCHASES.expected_purchases(HORIZON).alias("pred_num_purchases"))
    )


@_add(
    "join_enrichment",
    f"{WITH}, {_EXPECTED}, base AS (SELECT cust_id, count(sale_id) AS n_items FROM tx GROUP BY 1)\n"
    f"SELECT {_ID}, {sql_int('n_items', 'n_items')}, {sql_num(f'coalesce({_ALIVE}, 0)', 'prob_alive')}, "
    f"{sql_num('coalesce(e, 0)', 'pred_num_purchases')}, {sql_num(f'coalesce({_AVERAGE}, 0)', 'expected_avg_sales')} "
    "FROM base LEFT JOIN rfm USING (cust_id) LEFT JOIN expected USING (cust_id)",
)
def join_enrichment(spark, d):
    items = view.transactions(spark, d)
    scored = value.score(_rfm(spark, d), PURCHASES, SPEND, HORIZON)
    return shaped(value.join_enrichment(store.select_features(items, view.FEATURES, ["n_items"]), scored))


@_add("bgnbd_fit")
def bgnbd_fit(spark, d):
    rfm = staged(_rfm(spark, d), "rfm")
    m = value.fit_purchases(rfm, view.LIFETIME)
    return shaped(
        rfm.agg(F.count("*").alias("n_customers")).select(
            "n_customers", F.lit(m.r).alias("r"), F.lit(m.alpha).alias("alpha"),
            F.lit(m.a).alias("a"), F.lit(m.b).alias("b"),
        )
    )


@_add("gamma_gamma_fit")
def gamma_gamma_fit(spark, d):
    rfm = staged(_rfm(spark, d), "rfm")
    m = value.fit_spend(rfm, view.LIFETIME)
    return shaped(
        repeaters(rfm).agg(F.count("*").alias("n_repeaters")).select(
            "n_repeaters", F.lit(m.p).alias("p"), F.lit(m.q).alias("q"), F.lit(m.v).alias("v")
        )
    )


@_add("enriched_features")
def enriched_features(spark, d):
    items = staged(view.transactions(spark, d).select(*store.columns_read(store.kept_features())), "items")
    return shaped(value.enrich(store.customer_features(items, view.FEATURES), items, view.LIFETIME))
