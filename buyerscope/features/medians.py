"""Per-customer medians, only needed when the redundant columns are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerscope.features.passes import KEPT, in_window
from buyerscope.functions.exprs import grouped
from buyerscope.operators.quantiles import grouped_quantiles
from buyerscope.settings import LOOKBACK_DAYS, FeatureSettings


def basket_medians(items: DataFrame, settings: FeatureSettings) -> DataFrame:
    """Median sale revenue inside each look-back window."""
    days = list(LOOKBACK_DAYS)
    longest = f"{KEPT} and {in_window(settings, max(days))} and sale_id is not null"
    sales = grouped(
        items.where(longest),
        ["cust_id", "sale_id"],
        {
            f"w{d}": f"case when count_if({in_window(settings, d)}) > 0 then "
            f"coalesce(sum(case when {in_window(settings, d)} then sale_revenue end), 0D) end"
            for d in days
        },
    )
    long = sales.select(
        "cust_id",
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("days"), F.col(f"w{d}").alias("rev")) for d in days])
        ).alias("w"),
    ).select("cust_id", F.col("w.days").alias("days"), F.col("w.rev").alias("rev"))
    medians = grouped_quantiles(long, ["cust_id", "days"], "rev", [0.5])
    return medians.groupBy("cust_id").agg(
        *[
            F.max(F.when(F.col("days") == d, F.col("q"))).alias(f"median_basket_value_last_{d}d")
            for d in days
        ]
    )


def size_medians(items: DataFrame) -> DataFrame:
    return grouped_quantiles(items, ["cust_id"], "prod_size", [0.5], out="size_median").drop("prob")
