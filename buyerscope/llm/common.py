"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of anything but ASCII white space; bytes.split() splits the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """Text as bytes; null becomes empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def word_count(column: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns of ``df`` without those of the given names (in any case), then the given ones."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        column = batch.column(text)
        size, start = 0, 0
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                size, start = 0, i
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
