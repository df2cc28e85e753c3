"""Sharding by sampled splitters: shards of nearly equal bytes over the range of a key.

Keys are sampled with a chance that grows with the size of their rows; quantiles of the
sample split the key range, and rows are dealt to the ranges. Ranges that turn out
overfull are split again by a denser sample. The bytes of all ranges before it place
every range, the rows of a range are placed in key order, and a row's shard follows from
the bytes before it: no shard differs from the mean by more than its largest row.

The key is the text's hash, then doc_id, then a number: equal texts lie side by side,
and a group that passes a shard's share runs on into the next one.

Defined cases: a null text is empty (8 bytes); null doc_ids come last; repeated rows are
rows of their own; an empty table gives no rows. Columns named like the results give way.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from buyerscope.llm.common import utf8
from buyerscope.sources.staging import staged

SHARDS = 24
#: Ranges a shard has at least, and bytes that a range holds at most.
RANGES = 4
RANGE_BYTES = 1 << 30
#: Sampled keys for each range.
SAMPLED = 32
#: A range with more than this many times its share of bytes is split again.
OVERFULL = 2
ROUNDS = 3


def text_size(column: str = "text") -> Column:
    """UTF-8 bytes plus 8 for the record's frame."""
    return F.octet_length(utf8(column)).cast("long") + 8


def key(of: Column) -> Column:
    """A fixed-width string that sorts like the bits of a long; null last."""
    return F.coalesce(F.lpad(F.hex(of), 16, "0"), F.lit("~" * 16))


def _array(values: list, kind: str) -> Column:
    """A constant array that is parsed once for a plan."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _range_of(splitters: list[str]) -> Column:
    """Number of splitters up to a row's key, by bisection."""
    steps = [1 << b for b in reversed(range(len(splitters).bit_length()))]
    if not steps:
        return F.lit(0)
    known = _array(splitters, "string")
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(known, at + s - 1) <= F.col("key"), at + s).otherwise(at),
    )


def _sample(rows: DataFrame, every: float) -> list[tuple[str, int]]:
    """(key, size) with a chance of size / every."""
    u = (F.pmod(F.xxhash64(F.lit("splitters"), "key"), F.lit(1 << 30)) + 0.5) / F.lit(float(1 << 30))
    return [tuple(r) for r in rows.where(u * F.lit(every) < F.col("size")).select("key", "size").collect()]


def quantiles(sample: list[tuple[str, int]], every: float, parts: int) -> list[str]:
    """Keys that cut the sampled weight into equal parts; a sampled row stands for ``every`` bytes at least."""
    found, seen, total = [], 0.0, sum(max(every, s) for _, s in sample)
    for k, size in sorted(sample):
        seen += max(every, size)
        if len(found) < parts - 1 and seen >= (len(found) + 1) * total / parts:
            found.append(k)
    return sorted(set(found))


def _loads(rows: DataFrame, splitters: list[str]) -> list[tuple[int, int]]:
    """Exact bytes and rows of every range."""
    sums = rows.groupBy(_range_of(splitters).alias("part")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    by = {r.part: (r["size"], r.n) for r in sums.collect()}
    return [by.get(i, (0, 0)) for i in range(len(splitters) + 1)]


def _ranges(rows: DataFrame, total: int, shards: int) -> tuple[list[str], list[tuple[int, int]]]:
    """Splitters and the loads of their ranges, none far above its share."""
    parts = max(RANGES * shards, -(-total // RANGE_BYTES))
    share = total / parts
    splitters = quantiles(_sample(rows, share / SAMPLED), share / SAMPLED, parts)
    loads = _loads(rows, splitters)
    for n in range(1, ROUNDS + 1):
        full = [i for i, (size, rows_) in enumerate(loads) if size > OVERFULL * share and rows_ > 1]
        if not full:
            break
        every = share / SAMPLED / 8**n
        inside = F.array_contains(_array(full, "int"), _range_of(splitters))
        within: dict[int, list] = {}
        bounds = [*splitters, "\x7f"]
        for k, size in sorted(_sample(rows.where(inside), every)):
            at = next(i for i in full if k < bounds[i])
            within.setdefault(at, []).append((k, size))
        more = [k for i, keys in within.items() for k in quantiles(keys, every, -(-loads[i][0] // int(share)))]
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
        loads = _loads(rows, splitters)
    return splitters, loads


def shard(docs: DataFrame, shards: int = SHARDS, size: Column | None = None) -> DataFrame:
    """``docs`` with shard and slot (gapless from 0 in each shard, in key order)."""
    size = text_size() if size is None else size
    number = F.monotonically_increasing_id()
    keyed = docs.select(
        F.struct("*").alias("row"),
        size.alias("size"),
        F.concat(key(F.xxhash64("text")), key(F.col("doc_id").cast("long")), key(number)).alias("key"),
    )
    rows = staged(keyed, "keyed")
    narrow = rows.select("key", "size")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splitters, loads = _ranges(narrow, total, shards) if total else ([], [(0, 0)])
    bytes_before = [0, *accumulate(s for s, _ in loads)]
    rows_before = [0, *accumulate(n for _, n in loads)]

    def of(position: Column) -> Column:
        return F.least(F.lit(shards - 1), F.floor(position * shards / F.lit(float(max(1, total))))).cast("int")

    def placed(part: DataFrame) -> DataFrame:
        """Shard of each row and its number among all rows."""
        in_order = Window.partitionBy("part").orderBy("key")
        before = F.get(_array(bytes_before, "bigint"), F.col("part")) + F.sum("size").over(
            in_order.rowsBetween(Window.unboundedPreceding, 0)
        )
        number = F.get(_array(rows_before, "bigint"), F.col("part")) + F.row_number().over(in_order) - 1
        return part.withColumn("shard", of(before - F.col("size") / 2)).withColumn("number", number)

    ranged = _range_of(splitters).alias("part")
    cut = F.get(_array(bytes_before, "bigint"), F.col("part"))
    end = F.get(_array(bytes_before, "bigint"), F.col("part") + 1)
    edges = narrow.select("*", ranged).where(of(cut) != of(end))
    starts = {r.shard: r.first for r in placed(edges).groupBy("shard").agg(F.min("number").alias("first")).collect()}
    # a shard that begins at a range's edge: the first range that lies in it wholly
    for i, (b, n) in enumerate(zip(bytes_before, rows_before)):
        if i < len(loads) and loads[i][1]:
            k = min(shards - 1, int(b * shards / float(max(1, total))))
            starts[k] = min(starts.get(k, n), n)
    first = [starts.get(k, 0) for k in range(shards)]
    out = placed(rows.select("row", "size", "key", ranged))
    slot = F.col("number") - F.get(_array(first, "bigint"), F.col("shard"))
    taken = {"shard", "slot"}
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in taken]
    return out.select(*kept, "shard", slot.cast("long").alias("slot"))
