"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerscope.sources.staging import drop_staged, staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("m").alias("a"), "b").where("a <> b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of these."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a < b) but the roots; root is the least node.

    Each round writes its links, so neither the plan nor what a lost executor must
    redo grows; it ends when a round changes nothing. The driver reads two numbers.
    """
    now, seen = staged(links.select("a", "b").distinct(), "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        stars = staged(_small_star(_large_star(now)).distinct(), "links")
        drop_staged(now)
        now, seen = stars, mark
