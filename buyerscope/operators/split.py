"""Stratified split with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PRIME = 2_147_483_647
BUCKETS = 65_536


def mixed(key: Column, seed: int) -> Column:
    """A fixed pseudo-random order of ids: below 2^31, the same on every engine."""
    first = F.pmod(F.pmod(key, F.lit(PRIME)) + F.lit(seed), F.lit(PRIME)) * F.lit(48_271)
    second = F.pmod(first, F.lit(PRIME)) * F.lit(69_621) + F.lit(12_345)
    return F.pmod(second, F.lit(PRIME))


def _placed(df: DataFrame, groups: list[str], key: str, seed: int) -> DataFrame:
    """Adds ``_pos``, the place (from 1) of a row in the hashed order of its group, and ``_size``.

    The hash range is cut into fixed buckets; the bucket sizes say how many rows come
    before each, and only the place inside a bucket needs a window, so a group is never
    sorted as a whole. The bucket table has at most 65 536 rows per group, which bounds
    its broadcast for the one or two groups this is made for.
    """
    marked = df.withColumn("_h", mixed(F.col(key).cast("long"), seed)).withColumn(
        "_b", F.floor(F.col("_h") / F.lit(PRIME // BUCKETS + 1)).cast("int")
    )
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        marked.groupBy(*groups, "_b")
        .agg(F.count("*").alias("_n"))
        .withColumns(
            {
                "_below": F.coalesce(F.sum("_n").over(before), F.lit(0)),
                "_size": F.sum("_n").over(Window.partitionBy(*groups)),
            }
        )
        .drop("_n")
    )
    inside = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    return marked.join(sizes, [*groups, "_b"]).withColumn(
        "_pos", F.col("_below") + F.row_number().over(inside)
    )


def stratified_split(
    df: DataFrame, stratum: str, key: str = "cust_id", share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_validation``: exactly round(share * n) rows of every stratum."""
    want = F.floor(F.col("_size") * F.lit(share) + F.lit(0.5))
    return (
        _placed(df, [stratum], key, seed)
        .withColumn("is_validation", (F.col("_pos") <= want).cast("int"))
        .select(*df.columns, "is_validation")
    )


def hashed_positions(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Adds ``position`` 1..n in a pseudo-random order of the keys."""
    one = df.withColumn("_one", F.lit(0))
    return _placed(one, ["_one"], key, seed).select(*df.columns, F.col("_pos").alias("position"))
