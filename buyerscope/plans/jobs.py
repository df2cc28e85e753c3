"""The end-to-end jobs: ingest, split, features, train and score.

Every job reads files and writes files, so each can be run and rerun on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.features.store import customer_features
from buyerscope.lifetime.value import enrich
from buyerscope.models.twostage import TwoStagePipeline, TwoStageRun
from buyerscope.operators.clean import clean
from buyerscope.operators.split import stratified_split
from buyerscope.schema import TEST_LABELS, TRAIN_LABELS
from buyerscope.settings import TARGET, FeatureSettings, LifetimeSettings, ModelSettings, Paths
from buyerscope.sources import files


def ingest(spark: SparkSession, csv_path: str, paths: Paths) -> DataFrame:
    """Transactions from CSV to a typed Parquet table."""
    files.write_table(files.read_transactions_csv(spark, csv_path), paths.transactions)
    return spark.read.parquet(paths.transactions)


def split_transactions(spark: SparkSession, paths: Paths, share: float = 0.2, seed: int = 42) -> None:
    """Cleaned transactions of the labelled customers as calibration and validation tables.

    The split is by customer and stratified by whether the customer buys again.
    """
    labels = files.read_csv(spark, paths.train, TRAIN_LABELS)
    marked = stratified_split(
        labels.withColumn("buyer", (F.col(TARGET) > 0).cast("int")), "buyer", share=share, seed=seed
    ).drop("buyer")
    items = clean(spark.read.parquet(paths.transactions))
    joined = items.join(marked, "cust_id")
    files.write_table(
        joined.withColumn("part", F.when(F.col("is_validation") == 1, "validation").otherwise("calibration")),
        f"{paths.output}/split_transactions",
        partition_by=["part"],
    )


def build_features(
    spark: SparkSession,
    paths: Paths,
    settings: FeatureSettings = FeatureSettings(),
    lifetime: LifetimeSettings | None = LifetimeSettings(),
) -> DataFrame:
    """The feature table, with the lifetime-value columns unless ``lifetime`` is None."""
    items = spark.read.parquet(paths.transactions)
    features = customer_features(items, settings)
    if lifetime is not None:
        features = enrich(features, items, lifetime)
    files.write_table(features, paths.features)
    return spark.read.parquet(paths.features)


def train_and_score(
    spark: SparkSession, paths: Paths, pipeline: TwoStagePipeline = TwoStagePipeline(ModelSettings())
) -> TwoStageRun:
    """Runs the two-stage pipeline and writes the scored customers as CSV."""
    run = pipeline.run(
        spark.read.parquet(paths.features),
        files.read_csv(spark, paths.train, TRAIN_LABELS),
        files.read_csv(spark, paths.test, TEST_LABELS),
    )
    files.write_csv(run.scored, f"{paths.output}/scored_{run.strategy}")
    return run
