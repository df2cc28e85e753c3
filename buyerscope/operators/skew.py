"""Keeping one heavy key from becoming one heavy task.

Per-customer jobs want all rows of a customer in one partition, which saves every later
shuffle but breaks down when one customer owns a large part of the table; ``HotSplit``
sends those few customers down the ordinary partial-aggregation path instead. Joins need
no such care: adaptive execution cuts heavy partitions of a plain join.

A key is heavy when it holds more than ``share`` of all rows, or ``CEILING`` of them. The
list of heavy keys is broadcast: 1 / share of them, and one more per ``CEILING`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

#: Rows that one task takes of a key at any size of the table.
CEILING = 20_000_000


def hot_keys(df: DataFrame, key: str, share: float, floor: int) -> list:
    """Keys above ``max(floor, share * rows)`` rows, or above ``CEILING`` if that is less.

    There can be no more than rows / bar of them.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    if top.total is None:
        return []
    bar = min(CEILING, max(floor, share * top.total))
    if top.largest <= bar:
        return []
    most = math.ceil(top.total / bar)
    return [r[0] for r in counts.where(F.col("n") > bar).select(key).take(most)]


@dataclass(frozen=True)
class HotSplit:
    """Runs a per-key job on cold keys co-located and on hot keys spread out."""

    key: str
    hot: tuple = ()

    @classmethod
    def detect(cls, df: DataFrame, key: str, share: float, floor: int) -> "HotSplit":
        return cls(key, tuple(hot_keys(df, key, share, floor)))

    def run(self, df: DataFrame, job: Callable[[DataFrame, Callable], DataFrame]) -> DataFrame:
        """``job(rows, place)`` calls ``place(columns)`` on what it is about to group."""
        if not self.hot:
            return job(df, self._co_locate)
        kind = T.StructType([T.StructField("_hot", df.schema[self.key].dataType)])
        listed = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in self.hot], kind))
        same = F.col(self.key).eqNullSafe(F.col("_hot"))
        cold_out = job(df.join(listed, same, "left_anti"), self._co_locate)
        hot_out = job(df.join(listed, same, "left_semi"), lambda rows: rows)
        return cold_out.unionByName(hot_out)

    def _co_locate(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.key)
