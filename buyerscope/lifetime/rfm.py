"""Frequency, recency, age and mean value per customer, by calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerscope.settings import LifetimeSettings


def rfm_summary(items: DataFrame, settings: LifetimeSettings = LifetimeSettings()) -> DataFrame:
    """``cust_id, frequency, recency, T, monetary_value``; ages in days.

    Purchases of one day count once. The first day counts neither for the frequency nor
    for the mean value. Days after the end of the period are left out. All items count
    unless the settings ask for kept ones only.

    Items collapse to customer-days before anything is placed by customer, so one
    customer brings at most one row per day of the period.
    """
    end = F.lit(settings.period_end.isoformat()).cast("date")
    rows = items.select("cust_id", F.to_date("order_date").alias("day"), "sale_revenue", "is_returned")
    if settings.only_kept_items:
        rows = rows.where("is_returned = 0")
    days = (
        rows.where(F.col("day") <= end)
        .groupBy("cust_id", "day")
        .agg(F.coalesce(F.sum("sale_revenue"), F.lit(0.0)).alias("value"))
    )
    per = days.groupBy("cust_id").agg(
        F.count("*").alias("days"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.sum("value").alias("total"),
        F.min_by("value", "day").alias("first_value"),
    )
    repeats = F.col("days") - 1
    mean = (F.col("total") - F.col("first_value")) / F.nullif(repeats, F.lit(0))
    return per.select(
        "cust_id",
        repeats.alias("frequency"),
        F.datediff("last", "first").cast("long").alias("recency"),
        F.datediff(end, "first").cast("long").alias("T"),
        F.coalesce(mean, F.lit(0.0)).alias("monetary_value"),
    )


def repeaters(rfm: DataFrame) -> DataFrame:
    """Customers that came back and spent something when they did."""
    return rfm.where("frequency > 0 and monetary_value > 0")
