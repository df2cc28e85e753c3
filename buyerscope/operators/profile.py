"""Profiling tables. One pass per table, never one job per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from buyerscope.operators.quantiles import grouped_quantiles


def table_shape(df: DataFrame) -> DataFrame:
    """Rows and columns as one row."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def _as_text(df: DataFrame, columns: list[str]) -> Column:
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    ).alias("cv")


def long_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and value (NULL included), the base of the tables below.

    Frequent values collapse before the shuffle; the rest spreads over column and value.
    """
    return (
        df.select(_as_text(df, columns))
        .groupBy(F.col("cv.column_name").alias("column_name"), F.col("cv.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing count and percent per column from one aggregate row."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot(["_rows"], columns, "column_name", "n_missing").select(
        "column_name", "n_missing", (F.col("n_missing") * 100.0 / F.col("_rows")).alias("pct_missing")
    )


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Distinct values per column without and with NULL as a value."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return row.unpivot([], columns, "column_name", "n_unique")
    return (
        long_counts(df, columns)
        .groupBy("column_name")
        .agg(F.count("value").alias("n_unique"), F.count("*").alias("n_unique_with_null"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _numeric_long(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("column_name"), c.cast("double").alias("x")) for n, c in columns.items()]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.column_name", "p.x")
        .where(F.col("x").isNotNull())
    )


def describe(
    df: DataFrame, columns: dict[str, Column], probs: tuple[float, ...] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """count, mean, sample deviation, min, exact percentiles, max per column."""
    long = _numeric_long(df, columns)
    stats = long.groupBy("column_name").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quant = (
        grouped_quantiles(long, ["column_name"], "x", list(probs))
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("q"))).alias(f"p{round(p * 100)}") for p in probs])
    )
    return stats.join(quant, "column_name")


def describe_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, first, last, mean and median of timestamps, the last two in epoch seconds."""
    from buyerscope.functions.exprs import epoch_seconds

    out = describe(df, {c: epoch_seconds(c) for c in columns}, (0.5,))
    ends = df.agg(
        *[F.struct(F.min(c).alias("first"), F.max(c).alias("last")).alias(c) for c in columns]
    ).unpivot([], columns, "column_name", "ends")
    return out.join(ends, "column_name").select(
        "column_name", "n", F.col("ends.first").alias("first"), F.col("ends.last").alias("last"),
        F.col("mean").alias("mean_epoch"), F.col("p50").alias("median_epoch"),
    )


def describe_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, unique, most frequent value (the smallest of equals) and its count."""
    counts = long_counts(df, columns).where(F.col("value").isNotNull())
    per = counts.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("n_unique"),
        F.max("n").alias("freq"),
    )
    top = (
        counts.join(F.broadcast(per.select("column_name", "freq")), "column_name")
        .where(F.col("n") == F.col("freq"))
        .groupBy("column_name")
        .agg(F.min("value").alias("top"))
    )
    return per.join(top, "column_name").select("column_name", "n", "n_unique", "top", "freq")


def zero_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("n"), (F.avg((F.col(column) == 0).cast("double")) * 100).alias("pct_zero")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and their percent."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.sum(F.col("_n") - 1).alias("n_duplicates"),
        (F.sum(F.col("_n") - 1) * 100.0 / F.sum("_n")).alias("pct_duplicates"),
    )


def fences(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles and the 1.5 IQR fences per column: one row each."""
    long = _numeric_long(df, {c: F.col(c) for c in columns})
    q = (
        grouped_quantiles(long, ["column_name"], "x", [0.25, 0.5, 0.75])
        .groupBy("column_name")
        .agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("q"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.5, F.col("q"))).alias("median"),
            F.max(F.when(F.col("prob") == 0.75, F.col("q"))).alias("q3"),
        )
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return q.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})


def _with_fences(df: DataFrame, columns: list[str]) -> DataFrame:
    long = _numeric_long(df, {c: F.col(c) for c in columns})
    return long.join(F.broadcast(fences(df, columns)), "column_name")


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values outside the fences, as a percent of all rows of the table."""
    total = df.agg(F.count("*").alias("t")).scalar()
    x = F.col("x")
    return (
        _with_fences(df, columns)
        .groupBy("column_name", "q1", "q3")
        .agg(F.count_if((x < F.col("low")) | (x > F.col("high"))).alias("n_outliers"))
        .withColumn("pct_outliers", F.col("n_outliers") * 100.0 / total)
    )


def boxplot_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles and whiskers: the outermost values inside the fences."""
    inside = F.when((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")), F.col("x"))
    return (
        _with_fences(df, columns)
        .groupBy("column_name", "q1", "median", "q3")
        .agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
    )


def histogram(df: DataFrame, x: Column, bins: int = 60) -> DataFrame:
    """Equal-width bins from min to max; the largest value falls in the last bin."""
    values = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull())
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    # equal values lie in the middle of an interval of width 1
    half = F.when(ends["lo"] == ends["hi"], 0.5).otherwise(0.0)
    bin_of = F.width_bucket("x", ends["lo"] - half, ends["hi"] + half, F.lit(bins))
    placed = values.select(F.least(bin_of, F.lit(bins)).alias("bin"))
    return placed.groupBy("bin").agg(F.count("*").alias("n"))


def basket_products(items: DataFrame) -> DataFrame:
    """How many sales have how many different products.

    A sale's products are put in order, unknown ones last, and its last row has their number:
    a sort can go to disk in part, while tables of a task's pairs and sales stay in memory.
    """
    pairs = items.where("sale_id is not null").select("sale_id", "prod_id")
    ordered = Window.partitionBy("sale_id").orderBy(F.asc_nulls_last("prod_id"))
    per_sale = (
        pairs.withColumns({"_rank": F.dense_rank().over(ordered), "_follows": F.lead(F.lit(True)).over(ordered)})
        .where("_follows is null")
        .select((F.col("_rank") - F.col("prod_id").isNull().cast("int")).cast("long").alias("num_products"))
    )
    return (
        per_sale.groupBy("num_products")
        .agg(F.count("*").alias("n_sales"))
        .withColumn("multiple_products", F.col("num_products") > 1)
        .orderBy("num_products")
    )


def sale_consistency(items: DataFrame) -> DataFrame:
    """Sales by whether they have exactly one order date and exactly one customer.

    More than one shows as different smallest and largest values, so nothing has to be
    counted as distinct.
    """

    def single(c: str) -> Column:
        return F.coalesce(F.min(c) == F.max(c), F.lit(False))

    per_sale = items.where("sale_id is not null").groupBy("sale_id").agg(
        single("order_date").alias("order_date_consistent"),
        single("cust_id").alias("customer_id_consistent"),
    )
    return per_sale.groupBy("order_date_consistent", "customer_id_consistent").agg(
        F.count("*").alias("n_sales")
    )


def negative_values(df: DataFrame, column: str) -> DataFrame:
    """How many rows are below zero, and the lowest value."""
    return df.agg(
        F.count_if(F.col(column) < 0).alias("n_negative"), F.min(column).alias("lowest")
    )


def preview_negative(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The first few rows below zero, for looking at."""
    return df.where(F.col(column) < 0).limit(n)


def prediction_summary(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("n"), F.min(column).alias("min"), F.max(column).alias("max"),
        F.avg(column).alias("mean"),
    )


