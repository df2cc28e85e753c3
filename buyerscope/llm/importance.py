"""Importance resampling towards a target: documents drawn by the gain of their hashed n-grams.

Features are all runs of 1 to ``longest`` consecutive words, hashed into buckets. A bucket's
gain compares its share in the target with its share in all documents; a document's weight
is the sum over its features, its score the weight with Gumbel noise that follows from
doc_id, and the highest scores are drawn (importance sampling without replacement).

Segments, here lines, are counted once however often they occur:

1.  Newlines separate words, so they cut a text into lines that share no word. Lines without
    a word are dropped, equal ones of a document counted together, and all are grouped: one
    row a distinct line, with its occurrences.
2.  The buckets of a distinct line's features are found once and written. Multiplied by
    occurrences they give the bucket totals; with the gains they give the line's weight.
3.  Features that run over a newline belong to no line. They are found in each document and
    added separately, to the totals and to its weight (none if ``longest`` is 1).
4.  A document's weight is the sum of its lines' weights, joined by a 128-bit hash of the line.

A line that a third of all documents hold is one row after partial aggregation in steps 1
and 2; in the join of step 4 it brings narrow rows on one side and a single row on the
other, which adaptive execution splits. Gains are ``buckets`` numbers, the only broadcast.
Ranks come from a range partitioning and the row counts of its partitions.

Defined cases: null and empty texts have no feature and weight 0; repeated rows are
documents of their own, in the order they were written; a null doc_id is hashed as empty
and comes last among equals; empty tables give no rows, and without target texts the
gains compare with an even target. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.sources.staging import drop_staged, staged

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bytes of text a task cuts at once, and words it remembers the buckets of.
AT_ONCE = 1 << 22
REMEMBERED = 1 << 20

#: A-Z become a-z; every other ASCII byte that is neither letter nor digit becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 10 if c == 10 else 32 for c in range(256)
)


class Hasher:
    """Buckets of words and of runs of words."""

    def __init__(self, buckets: int, longest: int) -> None:
        self.buckets, self.longest = buckets, longest
        self.known: dict[bytes, int] = {}

    def words(self, words: list[bytes]) -> list[int]:
        known, n = self.known, self.buckets
        if len(known) > REMEMBERED:
            known.clear()
        known.update([(w, zlib.crc32(w) % n) for w in set(words).difference(known)])
        return [known[w] for w in words]

    def line(self, words: list[bytes]) -> list[int]:
        """Buckets of all features of one line."""
        out = self.words(words)
        for k in range(2, self.longest + 1):
            out += [zlib.crc32(b" ".join(words[i : i + k])) % self.buckets for i in range(len(words) - k + 1)]
        return out

    def across(self, lines: list[list[bytes]]) -> list[int]:
        """Buckets of the features of a text that run over a newline."""
        words = [w for line in lines for w in line]
        ends = list(accumulate(len(line) for line in lines))[:-1]
        out, at, last = [], 0, len(ends)
        for i in range(len(words)):
            while at < last and ends[at] <= i:
                at += 1
            if at == last:
                break
            shortest = ends[at] - i + 1  # words that reach over the next line's begin
            for k in range(max(2, shortest), min(self.longest, len(words) - i) + 1):
                out.append(zlib.crc32(b" ".join(words[i : i + k])) % self.buckets)
        return out


def _lists(rows: list[list[int]]) -> pa.Array:
    flat = np.fromiter((x for r in rows for x in r), np.int32, sum(map(len, rows)))
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32), flat)


def _cut(texts: list[bytes]) -> list[list[list[bytes]]]:
    """The words of each line with a word, of each text."""
    return [[w for line in t.translate(_FOLD).split(b"\n") if (w := line.split())] for t in texts]


def _key(line: bytes) -> bytes:
    return hashlib.md5(line, usedforsecurity=False).digest()


def documents(rows: DataFrame, buckets: int, longest: int) -> DataFrame:
    """One row a document: row, doc_id, its distinct lines (key and count), and the features that cross lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part, at = Hasher(buckets, longest), TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", AT_ONCE):
            cut = _cut(b.column("text").to_pylist())
            counts = [Counter(map(b" ".join, lines)) for lines in cut]
            keys = [_key(line) for c in counts for line in c]
            times = [n for c in counts for n in c.values()]
            lines = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(times, pa.int64())], ["key", "n"])
            edge = np.r_[0, np.cumsum([len(c) for c in counts])].astype(np.int32)
            over = _lists([hasher.across(lines) if longest > 1 else [] for lines in cut])
            row = pa.array((part << 40) + at + np.arange(len(cut)))
            at += len(cut)
            columns = [row, b.column("doc_id"), pa.ListArray.from_arrays(edge, lines), over]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "lines", "across"])

    schema = "row long, doc_id long, lines array<struct<key:binary,n:bigint>>, across array<int>"
    return staged(rows.mapInArrow(run, schema), "cut")


def distinct_lines(rows: DataFrame, buckets: int, longest: int) -> DataFrame:
    """One row a distinct line of all texts: key, n (occurrences), n_words and the buckets of its features; written once."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", AT_ONCE):
            n = Counter(b" ".join(w) for lines in _cut(b.column("text").to_pylist()) for w in lines)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["line", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets, longest)
        for b in slices(batches, "line", AT_ONCE):
            lines = b.column("line").to_pylist()
            words = [line.split(b" ") for line in lines]
            found = [
                pa.array([_key(x) for x in lines], pa.binary()), b.column("n"),
                pa.array([len(w) for w in words], pa.int64()), _lists([hasher.line(w) for w in words]),
            ]
            yield pa.RecordBatch.from_arrays(found, ["key", "n", "n_words", "features"])

    lines = rows.select("text").mapInArrow(gather, "line binary, n long").groupBy("line").agg(F.sum("n").alias("n"))
    return staged(lines.mapInArrow(count, "key binary, n long, n_words long, features array<int>"), "lines")


def totals(lines: DataFrame, across: DataFrame, buckets: int) -> np.ndarray:
    """How often the features of all documents fall into each bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for b in batches:
            times = np.repeat(b.column("n").to_numpy(), pa.compute.list_value_length(b.column("features")).to_numpy())
            np.add.at(found, b.column("features").flatten().to_numpy(), times)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["bucket", "n"])

    both = lines.select("n", "features").unionAll(across.where(F.size("across") > 0).select(F.lit(1).cast("long"), "across"))
    out = np.zeros(buckets, np.int64)
    for r in both.mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed shares, rounded down."""
    s, t, k = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (source.sum() + k) / ((s + 1) * (target.sum() + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(rows: DataFrame, gain: np.ndarray, passed: list[str], features: str) -> DataFrame:
    """The passed columns, the number of features and the sum of their gains."""
    sent = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pa.compute.list_value_length(b.column(features)).to_numpy().astype(np.int64)
            upto = np.r_[0, np.cumsum(sent.value[b.column(features).flatten().to_numpy()])]
            edge = np.r_[0, np.cumsum(size)]
            columns = [*(b.column(c) for c in passed), pa.array(size), pa.array(upto[edge[1:]] - upto[edge[:-1]])]
            yield pa.RecordBatch.from_arrays(columns, [*passed, "n_features", "weight"])

    kept = rows.select(*passed, features)
    return kept.mapInArrow(run, kept.select(*passed).schema.add("n_features", "long").add("weight", "long"))


def noise(seed: int = SEED, key: str = "doc_id"):
    """Gumbel noise in thousandths, rounded down, from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Adds ``rank``: 1, 2, ... for the drawn, null for all others."""
    able = F.col("n_words") >= least_words
    most = scored.where(able).count() * percent // 100
    order = [(~able).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    dealt = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(dealt.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = scored.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part long, before long")
    found = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    rank = F.col("before") + inside + 1
    return found.withColumn("rank", F.when(able & (rank <= most), rank))


def scores(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; rank is null for those not drawn."""
    texts = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), utf8("text").alias("text"))
    cut, lines = documents(texts, buckets, longest), distinct_lines(texts, buckets, longest)
    target_cut, target_lines = documents(wanted, buckets, longest), distinct_lines(wanted, buckets, longest)
    gain = gains(totals(lines, cut, buckets), totals(target_lines, target_cut, buckets))

    of_line = _weighed(lines, gain, ["key", "n_words"], "features")
    held = cut.select("row", "doc_id", F.explode("lines").alias("line")).select("row", "doc_id", "line.key", "line.n")
    inside = held.join(of_line, "key").select(
        "row", "doc_id", *[(F.col("n") * F.col(c)).alias(c) for c in ("n_words", "n_features", "weight")]
    )
    across = _weighed(cut, gain, ["row", "doc_id"], "across").select("row", "doc_id", F.lit(0).cast("long"), "n_features", "weight")
    sums = [F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    summed = inside.unionAll(across).groupBy("row", "doc_id").agg(*sums)
    scored = staged(summed.withColumn("score", F.col("weight") + noise(seed)), "scored")
    for done in (cut, lines, target_cut, target_lines):
        drop_staged(done)
    return _ranked(scored, percent, least_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, scored: DataFrame) -> DataFrame:
    """The drawn documents with all their columns; rows with a doc_id of their own are asked for."""
    chosen = scored.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(chosen, F.col("doc_id").cast("long") == F.col("_drawn"), "left_semi")
