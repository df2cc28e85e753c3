"""The order tables of the test data seen as a retail transaction log.

The expressions are valid in Spark SQL and in DuckDB alike, so the check queries are
built from the same text. The remainders plant the NULLs, odd tokens and unreadable
text that the tables lack; no row is left out.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.schema import type_transactions
from buyerscope.settings import FeatureSettings, LifetimeSettings, TARGET

REFERENCE_DATE = date(2000, 7, 31)
TARGET_DAYS = 366

FEATURES = FeatureSettings(reference_date=REFERENCE_DATE)
LIFETIME = LifetimeSettings(period_end=REFERENCE_DATE)

RAW_COLUMNS = {
    "cust_id": "o_custkey",
    "sale_id": "l_orderkey",
    "order_date": "o_orderdate",
    "pack_date": "case when (l_orderkey + l_linenumber) % 11 = 0 then null else l_shipdate end",
    "sale_revenue": "case when l_returnflag = 'R' then 0.0 else l_extendedprice * (1 - l_discount) end",
    "sale_discount_applied": "-(l_extendedprice * l_discount)",
    "prod_id": "l_partkey",
    "prod_title": "p_name",
    "prod_brand": "case when p_partkey % 17 = 0 then null else p_brand end",
    "prod_color": "split_part(p_name, ' ', 1)",
    "prod_type_1": "p_type",
    "prod_type_3": "concat(split_part(p_name, ' ', 2), ', ', p_type)",
    "prod_type_4": "case when p_partkey % 3 = 0 then null else split_part(p_name, ' ', 2) end",
    "prod_type_5": "case when p_partkey % 5 = 0 then null else p_type end",
    "prod_material": "concat(split_part(p_name, ' ', 1), ' , ', split_part(p_name, ' ', 2))",
    "prod_season": (
        "case p_partkey % 9 when 0 then 'Z17' when 1 then 'W16' when 2 then 'MZ17' "
        "when 3 then 'MW16' when 4 then 'SZ16' when 5 then 'SW17' when 6 then 'NOS' "
        "when 7 then 'CONS' else null end"
    ),
    "prod_size": "case when p_partkey % 13 = 0 then 'n/a' else cast(p_size as string) end",
    "prod_web_only": (
        "case p_partkey % 7 when 0 then 'True' when 1 then ' yes' when 2 then '1' "
        "when 3 then '1.0' when 4 then null else 'False' end"
    ),
    "prod_outlet": (
        "case p_partkey % 6 when 0 then 'true' when 1 then 'NO' when 2 then null else '0' end"
    ),
    "prod_heel": "case when p_partkey % 4 = 0 then cast(p_size % 3 as string) end",
    "prod_insole": "case when p_partkey % 4 = 1 then cast(p_size % 4 as string) end",
    "prod_print": "case when p_partkey % 4 = 2 then cast(p_size % 5 as string) end",
    "prod_comfort_sole": "case when p_partkey % 8 = 3 then cast(p_size % 2 as string) end",
    "prod_comfort_wear": "case when p_partkey % 8 = 5 then cast(p_size % 3 as string) end",
    "prod_clasp": "case when p_partkey % 2 = 0 then cast(p_size % 6 as string) end",
    "returned_to_shop_id": "case when l_returnflag = 'R' then l_suppkey end",
}


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All item rows, both before and after the reference date, still untyped.

    The joins carry no hint: Spark broadcasts a side only when its size estimate is
    below ``spark.sql.autoBroadcastJoinThreshold``. What depends on the product alone is
    computed once per product, before the join.
    """
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    of_part = [n for n, sql in RAW_COLUMNS.items() if not {"l_", "o_"} & set(_prefixes(sql))]
    products = part.selectExpr("p_partkey", *[f"{RAW_COLUMNS[n]} as {n}" for n in of_part])
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        products, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.selectExpr(
        *[n if n in of_part else f"{sql} as {n}" for n, sql in RAW_COLUMNS.items()]
    )


def _prefixes(sql: str) -> list[str]:
    """Table prefixes of the columns an expression reads."""
    return re.findall(r"\b([lop]_)[a-z]+", sql)


def observed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.lit(REFERENCE_DATE.isoformat()).cast("timestamp_ntz")
    return raw_transactions(spark, sf_dir).where(F.col("order_date") <= ref)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions up to the reference date."""
    return type_transactions(observed_raw(spark, sf_dir))


def all_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions of all dates, for what needs no reference date."""
    return type_transactions(raw_transactions(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known customer; some have no transactions."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("cust_id"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue in the year after the reference date for every observed customer."""
    ref = F.lit(REFERENCE_DATE.isoformat()).cast("timestamp_ntz")
    end = ref + F.expr(f"interval {TARGET_DAYS} days")
    typed = raw_transactions(spark, sf_dir).select("cust_id", "order_date", "sale_revenue")
    future = (F.col("order_date") > ref) & (F.col("order_date") <= end)
    return (
        typed.where(F.col("order_date") <= end)
        .groupBy("cust_id")
        .agg(
            F.count_if(F.col("order_date") <= ref).alias("n_seen"),
            F.coalesce(F.sum(F.when(future, F.col("sale_revenue"))), F.lit(0.0)).alias(TARGET),
        )
        .where("n_seen > 0")
        .select("cust_id", TARGET)
    )


def train_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).where("cust_id % 5 <> 0")


def test_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).where("cust_id % 5 = 0").select("cust_id")


def oracle_tables() -> str:
    """WITH clause for DuckDB: raw (all rows), alltx (typed), tx (typed, observed), lab, train, test."""
    cols = ",\n  ".join(f"{sql} as {name}" for name, sql in RAW_COLUMNS.items())
    ref = f"timestamp '{REFERENCE_DATE.isoformat()}'"
    token = (
        "case lower(trim({c})) when 'true' then 1 when '1' then 1 when 'yes' then 1 "
        "when 'false' then 0 when '0' then 0 when 'no' then 0 end"
    )
    return f"""WITH raw AS (
  SELECT {cols}
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN part p ON l_partkey = p_partkey
), alltx AS (
  SELECT * REPLACE (try_cast(prod_size AS double) AS prod_size,
      {token.format(c='prod_web_only')} AS prod_web_only,
      {token.format(c='prod_outlet')} AS prod_outlet),
    case when returned_to_shop_id is null then 0 else 1 end AS is_returned,
    cast(floor(date_diff('microsecond', order_date, pack_date) / 86400000000.0) as bigint) AS days_to_pack,
    abs(sale_discount_applied) AS disc
  FROM raw
), tx AS (SELECT * FROM alltx WHERE order_date <= {ref}
), lab AS (
  SELECT cust_id, coalesce(sum(sale_revenue) FILTER (order_date > {ref}), 0.0) AS revenue_2018_2019
  FROM raw WHERE order_date <= {ref} + interval {TARGET_DAYS} day
  GROUP BY cust_id HAVING count(*) FILTER (order_date <= {ref}) > 0
), train AS (SELECT * FROM lab WHERE cust_id % 5 <> 0
), test AS (SELECT cust_id FROM lab WHERE cust_id % 5 = 0
)"""
