"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A token is a run of letters and digits (A-Z in lower case, all bytes beyond ASCII) or a run
of other marks. Features are tokens and pairs of neighbours, hashed into ``BUCKETS``; a pair
of equal tokens is one feature whatever the token. A text's vector holds the logarithm of
one plus each feature's count, scaled to length 1; its score is the logistic of the bias
plus the sparse dot product with the weights.

Training (FTRL-Proximal) keeps two sums a feature, z and n, from which its weight follows;
features whose |z| stays below the L1 penalty have weight 0. The training rows are dealt
to ``SHARDS`` fixed shards by a hash of doc_id. In each round every shard starts from the
common sums, takes its rows in a hashed order and returns its sums; their means are the
next common sums. They are added as integers, so the result depends neither on the cluster
nor on the order of tasks. The driver gets two numbers a bucket and shard, 34 MB a round.

Bounds: learns from about ``TRAIN_ROWS`` labelled documents at most, chosen by a hash of
doc_id, with whole texts. Scoring reads all texts whole, in one narrow pass.

Defined cases: null and empty texts have no feature and the score of the bias. Labels
without a document, with a null doc_id or a mark other than 0 and 1 teach nothing; a doc_id
labelled several times counts once, with its most frequent mark (1 if even), one stored
several times with the text of the least hash. Without both classes the score is the share
of good documents, 0.5 without any. Repeated rows are scored one by one, an empty table
gives no rows, and columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.sources.staging import drop_staged, staged

BUCKETS = 1 << 18
TRAIN_ROWS = 20_000
SHARDS = 8
ROUNDS = 4
THRESHOLD = 0.5
#: Settings of the updates.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.001, 0.001
#: z and n are added as whole multiples of this.
UNIT = 2.0**-32
#: Bytes of text that a task turns into features at once, and tokens it remembers.
AT_ONCE = 1 << 22
REMEMBERED = 1 << 20

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\s]+")


@dataclass
class Model:
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))


class Vectors:
    """Texts as sparse vectors: buckets, values and where each text begins."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def _hashes(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        known.update([(t, zlib.crc32(t)) for t in set(tokens).difference(known)])
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, how often each occurs, and where each text begins."""
        found = [_TOKEN.findall(t.lower()) for t in texts]
        size = np.array([len(f) for f in found], np.int64)
        one = self._hashes([t for f in found for t in f])
        of = np.repeat(np.arange(len(texts)), size)
        near = of[1:] == of[:-1]
        a, b = one[:-1][near], one[1:][near]
        two = np.where(a == b, np.uint64(1), a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = (np.r_[one, two] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        bucket = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        key, count = np.unique(np.r_[of, of[1:][near]] * BUCKETS + bucket, return_counts=True)
        return key % BUCKETS, count, np.searchsorted(key, np.arange(len(texts) + 1) * BUCKETS)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, values and where each text begins."""
        bucket, count, edge = self.counts(texts)
        value, text = np.log1p(count), np.repeat(np.arange(len(texts)), np.diff(edge))
        length = np.sqrt(np.bincount(text, value**2, len(texts)))
        return bucket, value / length[text], edge


@dataclass
class Sums:
    """z and n of every bucket, and of the bias at the end."""

    z: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1))
    n: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, bucket: np.ndarray, value: np.ndarray, good: float) -> None:
        """The update of one row; the bias is a feature of value 1."""
        at, x = np.append(bucket, BUCKETS), np.append(value, 1.0)
        w = self.weights(at)
        g = (_logistic(float(w @ x)) - good) * x
        old, new = self.n[at], self.n[at] + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
        self.n[at] = new


def _logistic(v: float) -> float:
    return 0.0 if v < -700 else 1.0 / (1.0 + math.exp(-v))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(shard, place, good, text) of about ``most`` labelled documents."""
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("good"))
    marked = marked.where(F.col("id").isNotNull() & F.col("good").isin(0, 1) & ~held_out("id"))
    marked = marked.groupBy("id").agg((F.avg("good") >= 0.5).cast("int").alias("good"))
    share = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 20))
    sample = marked.where(share * F.lit(marked.count()) < F.lit(most << 20))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), utf8("text").alias("text"))
    one = texts.join(F.broadcast(sample), "id").groupBy("id", "good").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    place = F.xxhash64("id", F.lit("place"))
    return one.select(F.pmod(place, F.lit(SHARDS)).cast("int").alias("shard"), place.alias("place"), "good", "text")


def packed(rows: DataFrame) -> DataFrame:
    """One row a shard, written once: the marks, buckets and counts of its documents, in hashed order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for b in slices(batches, "text", AT_ONCE):
            bucket, times, edge = vectors.counts(b.column("text").to_pylist())
            parts = [
                pa.array([x[i:j].astype(kind).tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())
                for x, kind in ((bucket, "<i4"), (times, "<u4"))
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *parts], ["shard", "place", "good", "bucket", "times"])

    def pack(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        bucket, times = (part.column(c).to_pylist() for c in ("bucket", "times"))
        size = np.array([len(x) // 4 for x in bucket], "<i8")
        columns = [part.column("good").to_numpy().astype("<i4").tobytes(), size.tobytes(), b"".join(bucket), b"".join(times)]
        return pa.table([pa.array([c], pa.binary()) for c in columns], ["good", "size", "bucket", "times"])

    each = rows.mapInArrow(count, "shard int, place long, good int, bucket binary, times binary")
    return staged(each.groupBy("shard").applyInArrow(pack, "good binary, size binary, bucket binary, times binary"), "quality")


def one_round(train: DataFrame, sums: Sums) -> Sums:
    """The means of the shards' sums after each has taken its rows once."""
    sent = train.sparkSession.sparkContext.broadcast(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own = Sums(sent.value.z.copy(), sent.value.n.copy())
                good, size, bucket, times = (np.frombuffer(row[c], k) for c, k in (("good", "<i4"), ("size", "<i8"), ("bucket", "<i4"), ("times", "<u4")))
                edge = np.r_[0, np.cumsum(size)].tolist()
                for mark, i, j in zip(good.tolist(), edge[:-1], edge[1:]):
                    value = np.log1p(times[i:j])
                    own.learn(bucket[i:j], value / np.sqrt(max(value @ value, 1e-300)), mark)
                moved = [np.rint((new - old) / UNIT).astype("<i8").tobytes() for new, old in ((own.z, sent.value.z), (own.n, sent.value.n))]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in moved], ["z", "n"])

    z, n = np.zeros((2, BUCKETS + 1), np.int64)
    for r in train.mapInArrow(run, "z binary, n binary").collect():
        z += np.frombuffer(r.z, "<i8")
        n += np.frombuffer(r.n, "<i8")
    sent.unpersist()
    return Sums(sums.z + z * (UNIT / SHARDS), sums.n + n * (UNIT / SHARDS))


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Learn from labelled documents."""
    train = packed(training_rows(docs, labels))
    marks = np.concatenate([np.empty(0, "<i4"), *(np.frombuffer(r.good, "<i4") for r in train.select("good").collect())])
    n, good = len(marks), int(marks.sum())
    if not n or good in (0, n):
        drop_staged(train)
        return Model(math.inf if n and good else -math.inf if n else 0.0)
    sums = Sums()
    for _ in range(rounds):
        sums = one_round(train, sums)
    drop_staged(train)
    weights = sums.weights()
    return Model(float(weights[-1]), weights[:-1])


def scorer(docs: DataFrame, model: Model):
    """A function that makes, within a task, a function from texts to scores."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model, vectors = sent.value, Vectors()

        def score(texts: list[bytes]) -> np.ndarray:
            bucket, value, edge = vectors(texts)
            upto = np.r_[0.0, np.cumsum(model.weights[bucket] * value)]
            dots = np.round(upto[edge[1:]] - upto[edge[:-1]], 9)  # alike whatever else is in the slice
            return np.array([_logistic(model.bias + d) for d in dots.tolist()])

        return score

    return make


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    make = scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for b in slices(batches, "text", AT_ONCE):
            found = pa.array(score(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), utf8("text").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
