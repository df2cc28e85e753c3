"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from buyerscope.sources.staging import staging_root


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, made so that tasks can write into it."""
    uri = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return uri


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def attempt_name(part: int) -> str:
    """A file name that no other attempt at the same part uses; a lost attempt's file is never named again."""
    return f"{part:06d}-{uuid.uuid4().hex}"


def mapped(uri: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local, read otherwise."""
    where, path = opened(uri)
    if not where.get_file_info(path).size:
        return np.empty(0, kind)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with where.open_input_stream(path, compression=None) as file:
        return np.frombuffer(file.read(), kind)


def one_task_each(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table with each of its rows in a task of its own."""
    return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))
