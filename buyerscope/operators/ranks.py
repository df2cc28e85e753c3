"""Average ranks and the metrics built on them, without a whole-table sort window.

Ranks are taken over distinct values: counts per value, offsets per coarse bucket, and
a running count inside each bucket, or inside its parts where it holds too many values.
Ties share their mean rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.operators.quantiles import MOST_VALUES, bucket_offsets, scale_bucket, with_start


def rank_counts(counts: DataFrame, keys: list[str], most: int = MOST_VALUES) -> DataFrame:
    """Adds ``rank`` (mean rank of the ties) and ``total`` to per-value counts.

    ``counts`` has ``keys``, ``value`` and ``n``. Keys and buckets together place the
    rows, so a window sees one bucket at a time, or one part of a bucket with more than
    ``most`` values.
    """
    bucketed = counts.withColumn("bucket", scale_bucket(F.col("value")))
    placed = with_start(bucketed, bucket_offsets(bucketed, keys).drop("in_bucket"), keys, most=most)
    return placed.withColumn("rank", F.col("start") + (F.col("n") + 1) / 2.0).drop(
        "bucket", "below", "n_values", "start"
    )


def with_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds the centred average rank of ``value`` (rank minus the mean rank) to every row.

    A value shared by many rows, such as a revenue of 0, is one row of the table of ranks;
    adaptive execution cuts its side of the join into several tasks. NULL values drop out.
    """
    counts = (
        df.groupBy(F.col(value).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
        .withColumn("_one", F.lit(0))
    )
    ranks = rank_counts(counts, ["_one"]).select(
        F.col("value").alias(value), (F.col("rank") - (F.col("total") + 1) / 2.0).alias(out)
    )
    return df.join(ranks, value).select(*df.columns, out)


def grid_metrics(
    df: DataFrame, keys: list[str], y: str, y_rank: str, prediction: str, extra: list[Column] = ()
) -> DataFrame:
    """MAE, Spearman and row count per key, in two groupings.

    Rows first collapse per (key, predicted value); both metrics come from that table,
    so no rank is ever joined back. ``y_rank`` is the centred rank of ``with_rank``.
    Undefined correlations (a constant prediction) are 0. ``extra`` are sums to carry.
    """
    p = F.col(prediction).cast("double")
    names = [f"_x{i}" for i in range(len(extra))]
    counts = df.groupBy(*keys, p.alias("value")).agg(
        F.count("*").alias("n"),
        F.sum(F.abs(F.col(y) - p)).alias("err"),
        F.sum(y_rank).alias("ry"),
        F.sum(F.col(y_rank) * F.col(y_rank)).alias("ryy"),
        *[F.sum(x).alias(n) for x, n in zip(extra, names)],
    )
    own = keys or ["_one"]
    ranked = rank_counts(counts if keys else counts.withColumn("_one", F.lit(0)), own)
    centred = F.col("rank") - (F.col("total") + 1) / 2.0
    sums = ranked.groupBy(*own).agg(
        F.sum("n").alias("rows"),
        F.sum("err").alias("err"),
        F.sum(centred * F.col("ry")).alias("cov"),
        F.sum(centred * centred * F.col("n")).alias("vp"),
        F.sum("ryy").alias("vy"),
        *[F.sum(n).alias(n) for n in names],
    )
    corr = F.col("cov") / F.nullif(F.sqrt("vp") * F.sqrt("vy"), F.lit(0.0))
    return sums.select(
        *keys,
        "rows",
        (F.col("err") / F.col("rows")).alias("MAE"),
        F.coalesce(corr, F.lit(0.0)).alias("Spearman"),
        *names,
    )


def auc(df: DataFrame, keys: list[str], positive: str, score: str) -> DataFrame:
    """Exact ROC AUC per key from the rank sum; NULL where one class is missing."""
    counts = df.groupBy(*keys, F.col(score).cast("double").alias("value")).agg(
        F.count("*").alias("n"), F.sum(F.col(positive).cast("long")).alias("pos")
    )
    own = keys or ["_one"]
    ranked = rank_counts(counts if keys else counts.withColumn("_one", F.lit(0)), own)
    sums = ranked.groupBy(*own).agg(
        F.sum("n").cast("double").alias("n"),
        F.sum("pos").cast("double").alias("p"),
        F.sum(F.col("rank") * F.col("pos")).alias("r"),
    )
    pairs = F.col("p") * (F.col("n") - F.col("p"))
    above = F.col("r") - F.col("p") * (F.col("p") + 1) / 2.0
    return sums.select(*keys, (above / F.nullif(pairs, F.lit(0.0))).alias("AUC"))
