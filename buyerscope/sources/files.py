"""File sources and sinks. Parquet is the store between jobs; CSV is the exchange format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from buyerscope.schema import LEADERBOARD, as_text, type_transactions
from buyerscope.settings import SCORED


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns of a CSV, found by their names in its header; nothing is inferred.

    Other columns are left out, a declared one that is missing fails, and so does a file
    whose header differs from the first one's.
    """
    reader = spark.read.option("header", True)
    declared = {f.name: f for f in schema}
    names = reader.csv(path).columns or schema.fieldNames()
    found = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in names])
    rows = reader.schema(found).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    return rows.select(*schema.fieldNames())


def read_csv_as_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same columns as plain text, for files with dirty values."""
    return read_csv(spark, path, as_text(schema))


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transactions from CSV: whatever columns the header names, read as text, then typed.

    Only the header decides which columns exist, so files lacking optional columns work.
    All files must have the same header: one with other names or another order fails.
    """
    reader = spark.read.option("header", True)
    names = reader.option("inferSchema", False).csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = reader.option("enforceSchema", False).schema(text).csv(path)
    return type_transactions(raw)


#: Rows of a compressed file, which one task has to read.
ROWS_A_FILE = 500_000


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """CSV with a header; compressed files can't be read in parts and so are kept short."""
    writer = df.write.mode(mode).option("header", True)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_A_FILE)
    writer.csv(path)


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def scored_customers(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """The fixed two-column result of a scoring run."""
    return df.select("cust_id", F.col(prediction).cast("double").alias(SCORED))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own Hadoop file system, so that any URI works."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)


def union_leaderboard_if_present(spark: SparkSession, results: DataFrame, path: str) -> DataFrame:
    """Append a published results table where there is one; absent columns become NULL."""
    if not path_exists(spark, path):
        return results
    other = spark.read.option("header", True).csv(path)
    typed = other.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in LEADERBOARD
            if f.name in other.columns
        ]
    )
    return results.unionByName(typed, allowMissingColumns=True)
