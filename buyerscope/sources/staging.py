"""Cutting a plan where its result is read more than once.

The rows go to Parquet in the shared folder named by ``spark.checkpoint.dir``, so they
outlive any executor and later reads still prune columns. Only a local session, as in
tests, may leave the folder unnamed: one is made for it then.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder; raises on a cluster that names none."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="staging-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def staged_path(spark: SparkSession, label: str) -> str:
    """A new name below the shared folder."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    root = staging_root(spark)
    for file in df.inputFiles():
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if root.split(":")[-1].lstrip("/") in folder.toString():
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.delete(folder, True)
            return
