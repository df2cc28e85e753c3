"""Exact quantiles without bringing a group, or the table, to one task.

A quantile with linear interpolation needs the values at two neighbouring ranks. To
find them the distinct values are counted, the counts are added up per coarse bucket
of an order-keeping scale, and only the buckets that hold a wanted rank are looked at
value by value. A bucket of too many distinct values is cut at their own quantiles, which
a sketch of bounded size estimates. No step holds more of one group than its buckets, or
the distinct values of one bucket or part, so one group may hold any share of the rows and
its values may lie close together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

STEPS_PER_OCTAVE = 256
#: Distinct values of a bucket that one task sorts; a larger bucket is cut into ``CUTS`` parts, so up to
#: ``CUTS`` times as many keep to this figure, and parts grow with the values beyond that.
MOST_VALUES = 1_000_000
CUTS = 1_000


def scale_bucket(x: Column) -> Column:
    """Order-keeping bucket number, about 0.3 percent wide, at most 600 000 of them.

    Works on any finite double: the magnitude goes through a logarithm and the sign is
    put back, so larger values never get a smaller bucket.
    """
    return (F.signum(x) * F.floor(F.log2(F.lit(1.0) + F.abs(x) * 1000) * STEPS_PER_OCTAVE)).cast("int")


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of every non-NULL value per group; repeats collapse before the shuffle."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", scale_bucket(F.col("value")))
    )


def bucket_offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per bucket: its rows and distinct values, the rows below it, and the rows of the group."""
    lower = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("in_bucket"), F.count(F.lit(1)).alias("n_values"))
        .withColumns(
            {
                "below": F.coalesce(F.sum("in_bucket").over(lower), F.lit(0)),
                "total": F.sum("in_bucket").over(Window.partitionBy(*keys)),
            }
        )
    )


def with_start(
    counts: DataFrame, offsets: DataFrame, keys: list[str], also: tuple[str, ...] = (),
    most: int = MOST_VALUES, cuts: int = CUTS,
) -> DataFrame:
    """Joins value counts to their buckets and adds ``start``, the rows of the group below a value.

    ``offsets`` has one row per keys, bucket and ``also``, from ``bucket_offsets``; counts of
    other buckets drop out.
    """
    at = [*keys, "bucket"]

    def below(by: list[str], order: str, n: str) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(w), F.lit(0))

    small = counts.join(offsets.where(F.col("n_values") <= most), at)
    small = small.withColumn("start", F.col("below") + below([*at, *also], "value", "n"))

    large = offsets.where(F.col("n_values") > most)
    shares = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    points = (
        counts.join(large.select(*at).distinct(), at, "left_semi")
        .groupBy(*at)
        .agg(F.percentile_approx("value", shares, F.lit(10 * cuts)).alias("points"))
    )
    cut = counts.join(points, at).withColumn("part", F.size(F.filter("points", lambda p: p < F.col("value"))))
    parts = (
        cut.groupBy(*at, "part")
        .agg(F.sum("n").alias("in_part"))
        .withColumn("part_below", below(at, "part", "in_part"))
        .drop("in_part")
    )
    placed = cut.drop("points").join(parts, [*at, "part"])
    placed = placed.withColumn("in_bucket_start", F.col("part_below") + below([*at, "part"], "value", "n"))
    placed = placed.join(large, at).withColumn("start", F.col("below") + F.col("in_bucket_start"))
    return small.unionByName(placed.select(*small.columns))


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], out: str = "q", most: int = MOST_VALUES
) -> DataFrame:
    """``keys, prob, q``: exact linear-interpolation quantiles of every group.

    With no keys the whole table is one group.
    """
    own = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    counts = value_counts(rows.select(*own, value), own, value)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    spans = (
        bucket_offsets(counts, own)
        .select("*", wanted)
        .withColumn("at", F.col("prob") * (F.col("total") - 1))
        .withColumns({"lo": F.floor("at"), "hi": F.ceil("at")})
        .where(
            (F.col("lo") < F.col("below") + F.col("in_bucket")) & (F.col("hi") >= F.col("below"))
        )
        .select(*own, "bucket", "prob", "at", "lo", "hi", "below", "n_values")
    )
    ranked = with_start(counts, spans, own, ("prob",), most).withColumn("upto", F.col("start") + F.col("n"))

    def at_rank(rank: str) -> Column:
        hit = (F.col(rank) >= F.col("start")) & (F.col(rank) < F.col("upto"))
        return F.max(F.when(hit, F.col("value")))

    picked = ranked.groupBy(*own, "prob").agg(
        at_rank("lo").alias("v_lo"),
        at_rank("hi").alias("v_hi"),
        F.first(F.col("at") - F.col("lo")).alias("part"),
    )
    return picked.select(
        *keys,
        "prob",
        (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("part")).alias(out),
    )


def quantile_row(df: DataFrame, value: str, probs: list[float], prefix: str = "q") -> DataFrame:
    """The quantiles of one column as one row ``q0, q1, ...`` in the order of ``probs``."""
    long = grouped_quantiles(df, [], value, probs)
    return long.agg(
        *[
            F.max(F.when(F.col("prob") == float(p), F.col("q"))).alias(f"{prefix}{i}")
            for i, p in enumerate(probs)
        ]
    )
