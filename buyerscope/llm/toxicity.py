"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is a character n-gram of the text (3 to 5 code points, A-Z in lower case, hashed);
it counts once a text. Its value is the log ratio of its smoothed shares in toxic and in
other texts. Logistic regression learns the weights on the features that separate the
classes best.

Bounds: the classifier learns from at most about ``TRAIN_ROWS`` labelled rows, chosen
by a hash of doc_id, with whole texts; it keeps ``FEATURES`` features. Scoring reads all
texts whole.

Defined cases: null and empty texts have no feature and get the score of the
intercept. Labels without a document, with a null doc_id or a null mark teach nothing;
a doc_id that is labelled or stored twice counts each time. Without both classes the
score is the share of toxic rows, 0 without rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.sources.staging import drop_staged, staged

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
TRAIN_ROWS = 20_000
FEATURES = 8_192
LEAST_TEXTS = 3
#: Log ratios nearer to 0 say little and make the fit ill-conditioned.
LEAST_RATIO = 0.7
THRESHOLD = 0.3
#: Bytes of text that a task turns into arrays at once.
AT_ONCE = 1 << 21


@dataclass
class Model:
    """Chosen n-gram buckets and their weights; a text's score is the logistic of their sum."""

    bias: float = -math.inf
    buckets: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each code point."""
    h = np.zeros(max(0, len(points) - n + 1), np.uint32)
    for i in range(n):
        h = h * np.uint32(0x01000193) + points[i : i + len(h)]
    h = (h + np.uint32(n)) * np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BUCKETS.bit_length() + 1)


def present(texts: list[bytes], place: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text, which of ``width`` features it holds; ``place`` maps buckets to features or to ``width``.

    White space counts as a space; a space stands before and after the text.
    """
    framed = [b" %b " % t.lower().translate(_SPACES) for t in texts]
    points = np.frombuffer(b"".join(framed).decode().encode("utf-32-le"), np.uint32)
    size = [len(t.decode()) for t in framed]
    found = [place[_hashes(points, n)] for n in NGRAMS]
    at = 0
    for length in size:
        seen = np.zeros(width + 1, bool)
        for n, f in zip(NGRAMS, found):
            seen[f[at : max(at, at + length - n + 1)]] = True
        yield seen[:width]
        at += length


_SPACES = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


def may_teach(doc_id: str = "doc_id"):
    """Rows that labels may be learned from: those not held out."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(toxic, text) of labelled documents, about ``most`` at most, written once."""
    marked = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & may_teach("id"))
    total = marked.count()
    share = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 20))
    sample = marked.where(share * F.lit(total) < F.lit(most << 20))
    if sample.count() <= 2 * most:  # a label repeated very often may pass the bound
        sample = F.broadcast(sample)
    texts = docs.select("doc_id", utf8("text").alias("text"))
    return staged(texts.join(sample, F.col("doc_id") == F.col("id")).select("toxic", "text"), "train")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of a task hold each bucket."""
    counts, every = np.zeros((2, BUCKETS), np.int64), np.arange(BUCKETS)
    for b in slices(batches, "text", AT_ONCE):
        for toxic, seen in zip(b.column("toxic").to_pylist(), present(b.column("text").to_pylist(), every, BUCKETS)):
            counts[toxic, np.flatnonzero(seen)] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, counts[1, at], counts[0, at])], ["bucket", "pos", "neg"])


def _ratios(train: DataFrame, n_pos: int, n_neg: int) -> list:
    """(bucket, log-count ratio, texts with it) of the features that separate best."""
    counts = staged(
        train.mapInArrow(_count, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")),
        "ngrams",
    )
    all_pos, all_neg, n = counts.agg(F.sum("pos"), F.sum("neg"), F.count("*")).first()
    ratio = F.log((F.col("pos") + 1) / F.lit(float(all_pos + n))) - F.log((F.col("neg") + 1) / F.lit(float(all_neg + n)))
    pooled = (F.col("pos") + F.col("neg") + 1) / F.lit(n_pos + n_neg + 2.0)
    apart = F.abs(F.col("pos") / F.lit(float(n_pos)) - F.col("neg") / F.lit(float(n_neg))) / F.sqrt(pooled * (1 - pooled))
    best = counts.where((F.col("pos") + F.col("neg") >= LEAST_TEXTS) & (F.abs(ratio) >= LEAST_RATIO)).orderBy(apart.desc(), "bucket").limit(FEATURES)
    found = best.select("bucket", ratio.alias("ratio"), "pos", "neg").collect()
    drop_staged(counts)
    return found


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents; the driver sees the chosen features only."""
    train = training_rows(docs, labels)
    n_pos, n_neg = (int(x or 0) for x in train.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    if not n_pos or not n_neg:
        rate = n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.0
        return Model(math.inf if rate else -math.inf)
    ratios = _ratios(train, n_pos, n_neg)
    if not ratios:
        return Model(math.log(n_pos / n_neg))
    buckets, ratio = np.array([r.bucket for r in ratios]), np.array([r.ratio for r in ratios])
    shares = np.array([r.pos + r.neg for r in ratios]) / (n_pos + n_neg)
    ratio /= math.sqrt(shares @ ratio**2)  # texts have vectors of length 1 in the mean
    place, width = places(buckets), len(buckets)


    def vector(text: bytes) -> SparseVector:
        at = np.flatnonzero(next(present([bytes(text)], place, width)))
        return SparseVector(width, at, ratio[at])

    as_vector = F.udf(vector, VectorUDT())
    rows = staged(train.select(F.col("toxic").cast("double").alias("label"), as_vector("text").alias("features")), "vectors")
    learned = LogisticRegression(maxIter=60, regParam=1e-5, standardization=False).fit(rows)
    drop_staged(rows)
    drop_staged(train)
    return Model(float(learned.intercept), buckets, learned.coefficients.toArray() * ratio)


def places(buckets: np.ndarray) -> np.ndarray:
    """Feature of each bucket; the number of features for those that are none."""
    place = np.full(BUCKETS, len(buckets), np.int32)
    place[buckets] = np.arange(len(buckets))
    return place


def scorer(docs: DataFrame, model: Model):
    """A function that makes, within a task, a function from texts to scores."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value
        place, width = places(model.buckets), len(model.buckets)

        def score(texts: list[bytes]) -> list[float]:
            x = [model.bias + float(seen @ model.weights) for seen in present(texts, place, width)]
            return [0.0 if v < -700 else 1.0 / (1.0 + math.exp(-v)) for v in x]

        return score

    return make


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    make = scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for b in slices(batches, "text", AT_ONCE):
            found = pa.array(score(b.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), utf8("text").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_civil(docs: DataFrame, model: Model) -> DataFrame:
    """Rows that are not predicted toxic, with all their columns."""
    make = scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for whole in batches:
            texts = whole.column("text").cast(pa.binary()).fill_null(b"")
            one = pa.RecordBatch.from_arrays([texts], ["text"])
            found = [x for b in slices(iter([one]), "text", AT_ONCE) for x in score(b.column("text").to_pylist())]
            yield whole.filter(pa.array([x < THRESHOLD for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
