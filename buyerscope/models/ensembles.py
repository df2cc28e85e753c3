"""Boosted trees and forests on Spark, many models side by side.

Rows are binned to bytes once and written with fold, target and key. From there a set of
models is fitted in one of two ways that give the same trees, as both run ``trees`` on sums
that are exact:

* up to ``ONE_TASK`` rows and ``HELD`` bytes, models, or pieces of forests, are dealt to tasks.
  Few rows are broadcast; more than ``SENT`` are read by each task from where they are staged,
  so that they never meet in the driver, and held in the one form that its model needs;
* beyond, each level of all models is one job over all rows: tasks add up what a level
  needs of their rows, sums meet by model, node and feature, and the driver gets one row
  a node. Boosting writes its margins every ``REPLAYED`` rounds; in between, tasks replay
  the trees since then, so a lost executor costs its tasks only.

Models are driver-side objects, like MLlib's.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from buyerscope.models import trees
from buyerscope.models.trees import Asked, Found, Growth, Spec, Tree
from buyerscope.sources.staging import drop_staged, staged

#: Rows, and bytes of their bins, that a task may hold; random splits hold the bins twice.
ONE_TASK = 1 << 23
HELD = 700 << 20
#: Rows that are sent to all tasks; more are read by each task.
SENT = 1 << 17
#: Rows that cut points are taken from.
EDGE_ROWS = 20_000
#: Boosting rounds between two tables of margins.
REPLAYED = 25
#: Trees of a forest dealt as one piece, fewer where one takes long, and those grown together: histograms of best splits are large.
TREES_AT_ONCE = 25
LONG_TREES_AT_ONCE = 10
BEST_AT_ONCE = 3
#: Rows of a task above which trees are grown one by one.
ALONE = 1 << 15


# --- bins


@dataclass(frozen=True)
class Bins:
    """Cut points of each feature, and a value for each bin; both filled up with infinity."""

    edges: np.ndarray
    values: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        """The number of bins of each feature."""
        return np.isfinite(self.edges).sum(axis=1) + 1

    @staticmethod
    def of(x: np.ndarray) -> Bins:
        """Distinct values keep bins of their own while they fit; else bins of about equal size."""
        edges, values = np.full((x.shape[1], trees.BINS - 1), np.inf), np.full((x.shape[1], trees.BINS), np.inf)
        for f in range(x.shape[1]):
            u = np.unique(x[:, f])
            if len(u) > trees.BINS:
                e = np.unique(np.quantile(x[:, f], np.arange(1, trees.BINS) / trees.BINS, method="lower"))
                e = e[e < u[-1]]
                v = np.r_[(np.r_[u[0], e[:-1]] + e) / 2, (e[-1] + u[-1]) / 2] if len(e) else u[:1]
            else:
                e, v = (u[1:] + u[:-1]) / 2, u
            edges[f, : len(e)], values[f, : len(v)] = e, v
        return Bins(edges, values)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f in range(x.shape[1]):
            out[:, f] = np.searchsorted(self.edges[f], x[:, f], side="left")
        return out


def matrix(column: pa.Array) -> np.ndarray:
    """A column of number lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Block:
    """Some rows: key, fold, target and bytes."""

    key: np.ndarray
    fold: np.ndarray
    y: np.ndarray
    bins: np.ndarray

    @cached_property
    def columns(self) -> np.ndarray:
        """The bytes by feature; made once in a worker."""
        return np.ascontiguousarray(self.bins.T)

    @staticmethod
    def of(b: pa.RecordBatch | pa.Table) -> Block:
        raw = b.column("bins").to_pylist()
        width = len(raw[0]) if raw else 0
        return Block(
            b.column("key").to_numpy(), b.column("fold").to_numpy(), b.column("y").to_numpy(),
            np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), width),
        )

    @staticmethod
    def gathered(batches: Iterator[pa.RecordBatch], table: Binned, spec: Spec) -> Block:
        """All rows of a table, in the form that the model needs: by row, by feature, or as words."""
        n, width = table.n, table.width
        key, fold, y = np.empty(n, np.int64), np.empty(n, np.int32), np.empty(n)
        whole = spec.split == "best" and spec.n_features(width) == width and not (spec.adaptive and spec.classes)
        words = trees.Words(table.bins.sizes, n) if whole else None
        bins = words if words else np.empty((n, width), np.uint8, order="C" if spec.split == "random" else "F")
        at = 0
        for b in batches:
            own = Block.of(b)
            part = slice(at, at + len(own.y))
            if part.stop > n:
                break
            key[part], fold[part], y[part] = own.key, own.fold, own.y
            if words:
                words.fill(at, own.bins)
            else:
                bins[part] = own.bins
            at = part.stop
        if at != n:
            raise ValueError(f"staged rows are not the {n} that were counted")
        if spec.adaptive:  # sums of its weights depend on the order
            order = np.argsort(key, kind="stable")
            key, fold, y = key[order], fold[order], y[order]
            if words:
                words.reorder(order)
            else:
                bins = bins[order]
        return Block(key, fold, y, bins)


@dataclass(frozen=True)
class Binned:
    """Staged rows and what all models of them share."""

    rows: DataFrame
    bins: Bins
    n: int
    #: Rows and ones of each fold, for bases and class weights.
    folds: dict[int, tuple[int, float]]
    scale: float
    middle: float

    @property
    def width(self) -> int:
        return len(self.bins.edges)

    def in_one_task(self, specs: list[Spec]) -> bool:
        """Whether a task may hold all rows for any of the models."""
        times = 2 if any(s.split == "random" for s in specs) else 1
        return self.n <= ONE_TASK and self.n * self.width * times <= HELD

    def base(self, spec: Spec) -> float:
        """What boosting starts from: log odds, mean or median of the rows that teach."""
        if not spec.boosted:
            return 0.0
        n, s = (sum(v[i] for f, v in self.folds.items() if f != spec.held_out) for i in (0, 1))
        if spec.loss == "logistic":
            share = min(max(s / max(n, 1), 1e-9), 1 - 1e-9)
            return float(np.log(share / (1 - share)))
        return self.middle if spec.loss == "absolute" else s / max(n, 1)

    def weights(self, spec: Spec) -> tuple[float, float] | None:
        if not spec.balanced:
            return None
        n, s = (sum(v[i] for f, v in self.folds.items() if f != spec.held_out) for i in (0, 1))
        return n / (2.0 * max(n - s, 1)), n / (2.0 * max(s, 1))


def binned(rows: DataFrame, label: str, key: str = "cust_id", fold: str | None = None) -> Binned:
    """Bytes of the ``features`` vectors; cut points are taken from at most about ``EDGE_ROWS`` rows."""
    fold_of = F.col(fold).cast("int") if fold else F.lit(-2)
    picked = rows.select(
        F.col(key).cast("long").alias("key"), fold_of.alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array("features").alias("x")
    )
    stats = picked.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.min("y").alias("a"), F.max("y").alias("b")).collect()
    n = sum(r.n for r in stats)
    if not n:
        raise ValueError("no rows to learn from")
    # about even in any order of rows; repeated keys come along together
    share = F.pmod(F.xxhash64(F.lit("edges"), "key"), F.lit(1 << 20))
    sample = picked.where(share * F.lit(n) < F.lit(EDGE_ROWS << 20)).select("x").limit(4 * EDGE_ROWS).toArrow()
    if not sample.num_rows:  # a key that nearly all rows share
        sample = picked.select("x").limit(EDGE_ROWS).toArrow()
    bins = Bins.of(matrix(sample.column("x").combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                raw = pa.array([r.tobytes() for r in bins(matrix(b.column("x")))], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:3], raw], ["key", "fold", "y", "bins"])

    table = staged(picked.mapInArrow(run, "key long, fold int, y double, bins binary"), "binned")
    middle = table.agg(F.percentile("y", F.lit(0.5))).first()[0]
    spread = max(max(abs(r.a), abs(r.b)) for r in stats)
    spread = max(spread, max(r.b for r in stats) - min(r.a for r in stats))
    scale = float(2.0 ** np.ceil(np.log2(spread))) if spread > 0 else 1.0
    return Binned(table, bins, n, {r.fold: (r.n, float(r.s)) for r in stats}, scale, float(middle))


# --- models


@dataclass(frozen=True)
class Ensemble:
    """A fitted model: the sum (boosted) or mean of its trees' values on top of a base."""

    spec: Spec
    bins: Bins
    trees: list[Tree]
    base: float

    def cut_to(self, rounds: int) -> Ensemble:
        """The model of the first rounds."""
        return replace(self, trees=self.trees[:rounds])

    def margins(self, codes: np.ndarray) -> np.ndarray:
        if self.spec.adaptive:
            return trees.vote(self.spec, self.trees, np.stack([t.value[t.node_of(codes)] for t in self.trees], axis=1))
        out = np.zeros(len(codes))
        for t in self.trees:
            out += t.value[t.node_of(codes)]
        return self.base + out if self.spec.boosted else out / max(1, len(self.trees))

    def numbers(self, margin: np.ndarray) -> np.ndarray:
        votes = self.spec.adaptive and self.spec.classes
        return trees.logistic(margin) if votes or self.spec.loss == "logistic" else margin

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802 - the name MLlib's models have
        """Share of the gain of each feature, first within each tree."""
        out = np.zeros(len(self.bins.edges))
        for t in self.trees:
            own = np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], len(out))
            out += own / own.sum() if own.sum() else 0.0
        return out / out.sum() if out.sum() else out

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``prediction``, and ``probability`` for classes."""
        sent = rows.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            own = sent.value
            return pa.array(own.numbers(own.margins(own.bins(matrix(x)))) if len(x) else [], pa.float64())

        scored = rows.withColumn("prediction", score(vector_to_array("features")))
        if not self.spec.classes:
            return scored
        p = F.col("prediction")
        return scored.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", (p > 0.5).cast("double"))


@dataclass(frozen=True)
class Trees:
    """An estimator: ``fit`` gives an ``Ensemble``. ``label`` is the column to learn."""

    spec: Spec
    label: str

    def hasParam(self, name: str) -> bool:  # noqa: N802 - as MLlib's estimators
        return name == "probabilityCol" and self.spec.classes

    def fit(self, rows: DataFrame) -> Ensemble:
        table = binned(rows, self.label)
        model = fit_all([self.spec], table)[0]
        drop_staged(table.rows)
        return model


# --- growing in one task


class InTask:
    """All rows of a table in one task; grows the trees of one model."""

    def __init__(self, spec: Spec, block: Block, bins: Bins, base: float, weights, scale: float) -> None:
        self.spec, self.block, self.bins, self.weights, self.scale = spec, block, bins, weights, scale
        self.margin = np.full(len(block.y), base) if spec.sequential else np.broadcast_to(np.float64(base), len(block.y))
        self.done = False

    def grow(self, numbers: list[int]) -> list[Tree]:
        spec, block = self.spec, self.block
        y = trees.gradient(spec, block.y, self.margin, self.scale) if spec.boosted else target(spec, block.y, self.scale)
        norm = trees_norm(spec, block, self.margin)
        times = [trees.sampled(spec, t, block.key, block.fold, self.margin, norm) for t in numbers]
        row = np.concatenate([np.flatnonzero(m) for m in times])
        tree = np.repeat(np.arange(len(numbers)), [np.count_nonzero(m) for m in times])
        m = np.concatenate([m[m > 0] for m in times])
        growth = Growth(spec, numbers, [(v.sum(), (v * y).sum()) for v in times], self.weights, len(self.bins.edges))
        if not spec.sequential:  # rows of many trees are large
            times = [None] * len(numbers)
        row, at, m = self._only(growth, row, tree, m)
        del tree
        if isinstance(block.bins, trees.Words):
            splits = trees.WordSplits(block.bins, spec)
        elif spec.split == "best":
            splits = trees.Splits(block.columns, spec)
        else:
            splits = trees.RandomSplits(block.bins, block.columns, spec, self.bins.values)
        leaf = np.zeros(len(y), np.int32) if spec.sequential else None  # of a sequential model's one tree
        out = np.flatnonzero(times[0] == 0) if spec.sequential else None
        while (asked := growth.asked()) is not None:
            feature, cut, child, kept = growth.take(splits.search(asked, row, at, m, y[row]))
            moves = feature[at] >= 0
            row, at, m = row[moves], at[moves], m[moves]
            right = block.bins[row, feature[at]] > cut[at]
            if spec.sequential:
                leaf[row] = growth.trees[0].child[asked.node[at]] + right
            at = child[at] + right
            splits.follow(feature, child, kept, row, at, m, y[row])
            at = kept[at]
            here = at >= 0
            row, at, m = row[here], at[here], m[here]
        for i, t in enumerate(growth.trees):
            if spec.sequential:
                leaf[out] = t.node_of(block.bins, out)
            extra = trees.leaf_extra(spec, block.y, self.margin, times[i], leaf, len(t.feature), self.scale)
            trees.set_values(spec, t, growth.sums[i], extra, self.scale, self.weights)
            if spec.adaptive:
                weight, wrong = np.exp(self.margin - norm[0]) * (block.fold != spec.held_out), trees.errors(spec, t, leaf, block.y)
                worst = 1.0 if spec.classes else float(wrong[weight > 0].max())
                share = float(weight @ wrong) / (norm[1] * max(worst, 1e-300))
                self.done = not trees.voice(spec, t, share, worst, numbers == [0])
            if spec.sequential:
                trees.advance(spec, t, leaf, block.y, self.margin)
        return [t for t in growth.trees if t.say > 0]

    @staticmethod
    def _only(growth: Growth, row: np.ndarray, tree: np.ndarray, m: np.ndarray):
        place = np.full(len(growth.numbers), -1)
        place[growth.tree] = np.arange(len(growth.tree))
        at = place[tree]
        here = at >= 0
        return (row, at, m) if here.all() else (row[here], at[here], m[here])


def trees_norm(spec: Spec, block: Block, margin: np.ndarray) -> tuple[float, float, int] | None:
    """The greatest logarithm of a weight, the sum of weights relative to it, and the number of rows that teach."""
    if not spec.adaptive:
        return None
    own = margin[block.fold != spec.held_out]
    top = float(own.max(initial=-np.inf))
    return top, float(np.exp(own - top).sum()), len(own)


def target(spec: Spec, y: np.ndarray, scale: float) -> np.ndarray:
    return y if spec.classes else np.rint(y / scale * trees.UNIT)


def pieces(spec: Spec, marks: set[int], n: int = 0) -> list[tuple[int, int]]:
    """Ranges of trees of n rows that may be grown apart; ``marks`` are counts at which a range has to end."""
    if spec.sequential:
        return [(0, spec.trees)]
    size = LONG_TREES_AT_ONCE if n > SENT else TREES_AT_ONCE
    ends = sorted({*range(size, spec.trees, size), *marks, spec.trees})
    return list(zip([0, *ends[:-1]], ends))


def _dealt(table: Binned, jobs: list[tuple], schema: str, work) -> DataFrame:
    """``work(i, job, block)`` for every job, each in a task of its own, with all rows; yields record batches."""
    spark = table.rows.sparkSession
    if table.n > SENT:
        return _read_by_each(table, jobs, schema, work)
    arrow = table.rows.toArrow()
    sent = spark.sparkContext.broadcast((Block.of(arrow.sort_by("key").combine_chunks()), jobs))
    # heavy and light jobs alternate; the place says which job a row is
    deal = spark.range(0, len(jobs), 1, len(jobs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column("id").to_pylist():
                block, all_jobs = sent.value
                yield from work(i, all_jobs[i], block)

    return deal.mapInArrow(run, schema)


def _read_by_each(table: Binned, jobs: list[tuple], schema: str, work) -> DataFrame:
    """The same where each task reads all rows, as the one partition of the left side of a product."""
    spark = table.rows.sparkSession
    sent, known = spark.sparkContext.broadcast(jobs), replace(table, rows=None)
    deal = spark.range(0, len(jobs), 1, len(jobs)).withColumnRenamed("id", "job")
    paired = table.rows.coalesce(1).hint("shuffle_replicate_nl").crossJoin(deal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (b for b in batches if b.num_rows)
        if (first := next(rows, None)) is not None:
            i = first.column("job")[0].as_py()
            job = sent.value[i]
            yield from work(i, job, Block.gathered(chain([first], rows), known, job[SPEC]))

    return paired.mapInArrow(run, schema)


#: Where a job has its settings.
SPEC = 3


def fit_all(specs: list[Spec], table: Binned) -> list[Ensemble]:
    """Every model, fitted on all rows but those of its held-out fold."""
    if not table.in_one_task(specs):
        grown = OverRows(specs, table).fit()
    else:
        jobs = [(m, a, b, spec, table.base(spec), table.weights(spec)) for m, spec in enumerate(specs) for a, b in pieces(spec, set(), table.n)]
        bins, scale = table.bins, table.scale

        def work(i, job, block):
            m, a, b, spec, base, weights = job
            rows = InTask(spec, block, bins, base, weights, scale)
            found: list[Tree] = []
            for numbers in batches_of(spec, a, b, len(block.y) > ALONE):
                if not rows.done:
                    found += rows.grow(numbers)
            yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([a]), pa.array([pickle.dumps(found)], pa.binary())], ["model", "start", "trees"])

        grown = [[] for _ in specs]
        for r in sorted(_dealt(table, jobs, "model long, start long, trees binary", work).collect(), key=lambda r: (r.model, r.start)):
            grown[r.model] += pickle.loads(r.trees)
    return [Ensemble(spec, table.bins, t, table.base(spec)) for spec, t in zip(specs, grown)]


def batches_of(spec: Spec, start: int, end: int, alone: bool = False) -> list[list[int]]:
    """Trees grown together; those of many rows go one at a time where jobs cost nothing."""
    size = 1 if spec.sequential or alone else TREES_AT_ONCE if spec.split == "random" else BEST_AT_ONCE
    return [list(range(a, min(a + size, end))) for a in range(start, end, size)]


def held_out_scores(specs: list[Spec], marks: list[list[int]], table: Binned) -> DataFrame:
    """(model, trees, key, fold, y, margin) of the rows of each model's held-out fold, staged.

    ``marks`` are the numbers of trees at which a model is scored: the prefixes of one long fit.
    Adaptive models, which may end before, are not scored here.
    """
    if any(s.adaptive for s in specs):
        raise ValueError("adaptive models have no prefixes to score")
    schema = "model long, trees long, key long, fold int, y double, margin double"
    if not table.in_one_task(specs):
        return staged(OverRows(specs, table).scores(marks, schema), "held-out")
    jobs = [
        (m, a, b, spec, table.base(spec), table.weights(spec), sorted(marks[m]))
        for m, spec in enumerate(specs) for a, b in pieces(spec, set(marks[m]), table.n)
    ]
    jobs.sort(key=lambda j: -(j[2] - j[1]) * j[3].n_features(table.width) * min(12, j[3].depth or 12))
    bins, scale = table.bins, table.scale

    def work(i, job, block):
        m, a, b, spec, base, weights, wanted = job
        rows, out = InTask(spec, block, bins, base, weights, scale), block.fold == spec.held_out
        asked = np.flatnonzero(out)
        total = np.zeros(len(asked))
        for numbers in batches_of(spec, a, b, len(block.y) > ALONE):
            for t, tree in zip(numbers, rows.grow(numbers)):
                if not spec.boosted:
                    total += tree.value[tree.node_of(block.bins, asked)]
                elif t + 1 in wanted:
                    yield _rows(m, t + 1, block, asked, rows.margin[asked])
        if not spec.boosted:
            yield _rows(m, b, block, asked, total)

    found = staged(_dealt(table, jobs, schema, work), "held-out")
    # a forest of k trees is the sum of its pieces that end at k or before
    forests = [(m, k) for m, ks in enumerate(marks) for k in ks if not specs[m].boosted]
    if not forests:
        return found
    counts = table.rows.sparkSession.createDataFrame(forests, "model long, k long")
    boosted = found.join(F.broadcast(counts), "model", "left_anti")
    upto = found.join(F.broadcast(counts), "model").where("trees <= k")
    whole = upto.groupBy("model", F.col("k").alias("trees"), "key", "fold", "y").agg((F.sum("margin") / F.col("k")).alias("margin"))
    return boosted.unionByName(whole)


def _rows(model: int, k: int, block: Block, at: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    n = len(at)
    columns = [np.full(n, model), np.full(n, k), block.key[at], block.fold[at], block.y[at], margin]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["model", "trees", "key", "fold", "y", "margin"])


# --- growing over all rows


class OverRows:
    """The same models by one job a level."""

    def __init__(self, specs: list[Spec], table: Binned) -> None:
        self.specs, self.table, self.spark = specs, table, table.rows.sparkSession
        self.trees: list[list[Tree]] = [[] for _ in specs]
        self.bases = [table.base(s) for s in specs]
        self.weights = [table.weights(s) for s in specs]
        self.norms: dict[int, tuple] = {}
        self.done: set[int] = set()
        zeros = np.array(self.bases).tobytes()
        self.state, self.since = table.rows.withColumn("margins", F.lit(zeros)), 0

    def _over(self, growths: dict[int, Growth], schema: str, work) -> DataFrame:
        """``work(model, growth, block, margins, row, at, m, y)`` adds to what a task returns.

        ``at`` is the place of a row's node among the growth's nodes, or the leaf where none is left.
        """
        specs, scale, grown, since = self.specs, self.table.scale, self.trees, self.since
        recent = {m: grown[m][since:] if specs[m].sequential else [] for m in growths}
        sent = self.spark.sparkContext.broadcast((growths, recent, self.norms))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            growths, recent, norms = sent.value
            kept: dict = {}
            for b in batches:
                if not b.num_rows:
                    continue
                block = Block.of(b)
                margins = np.frombuffer(b"".join(b.column("margins").to_pylist())).reshape(len(block.y), -1)
                for m, growth in growths.items():
                    spec = specs[m]
                    margin = margins[:, m].copy()
                    for t in recent[m]:
                        trees.advance(spec, t, t.node_of(block.bins), block.y, margin)
                    y = trees.gradient(spec, block.y, margin, scale) if spec.boosted else target(spec, block.y, scale)
                    for i, tree in enumerate(growth.trees):
                        times = trees.sampled(spec, int(growth.numbers[i]), block.key, block.fold, margin, norms.get(m, (0.0, 1.0, 1)))
                        row = np.flatnonzero(times)
                        work(kept, m, growth, i, block, margin, row, tree.node_of(block.bins, row), times[row], y[row])
            yield from work(kept, None, None, None, None, None, None, None, None, None)

        return self.state.mapInArrow(run, schema)

    @staticmethod
    def _places(growth: Growth, i: int, node: np.ndarray) -> np.ndarray:
        """Where each node of tree ``i`` stands among the nodes looked at; -1 elsewhere."""
        place = np.full(len(growth.trees[i].feature), -1)
        own = np.flatnonzero(growth.tree == i)
        place[growth.node[own]] = own
        return place[node]

    def _totals(self, models: dict[int, list[int]]) -> dict[int, list[tuple[float, float]]]:
        empty = {m: _blank(self.specs[m], numbers) for m, numbers in models.items()}

        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                rows = [(k[0], k[1], *v) for k, v in kept.items()]
                return [_batch(rows, ("model", "tree", "n", "s"))]
            old = kept.get((m, i), (0.0, 0.0))
            kept[m, i] = (old[0] + float(times.sum()), old[1] + float((times * y).sum()))
            return []

        sums = self._over(empty, "model long, tree long, n double, s double", work).groupBy("model", "tree").agg(F.sum("n"), F.sum("s"))
        found = {(r[0], r[1]): (r[2], r[3]) for r in sums.collect()}
        return {m: [found.get((m, i), (0.0, 0.0)) for i in range(len(numbers))] for m, numbers in models.items()}

    def _level(self, growths: dict[int, Growth]) -> None:
        """One level of all growths: a job for best splits, two for random ones."""
        asked = {m: a for m, g in growths.items() if (a := g.asked()) is not None}
        best = {m: a for m, a in asked.items() if a.spec.split == "best"}
        drawn = {m: a for m, a in asked.items() if a.spec.split != "best"}
        found = self._best(growths, best) if best else {}
        if drawn:
            span = self._ranges(growths, drawn)
            cuts = {m: trees.thresholds(a, span[m], self.table.bins.values) for m, a in drawn.items()}
            left = self._left(growths, drawn, cuts)
            found |= {m: trees.best_of_random(a, cuts[m], span[m], left[m]) for m, a in drawn.items()}
        for m, f in found.items():
            growths[m].take(f)

    def _best(self, growths, asked: dict[int, Asked]) -> dict[int, Found]:
        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                return (_cells_batch(k, a, asked[k].choice) for k, a in kept.items())
            at = OverRows._places(growth, i, node)
            here = at >= 0
            part = trees.histogram(block.bins, row[here], at[here], times[here], y[here], asked[m].choice)
            kept[m] = kept[m] + part if m in kept else part
            return ()

        own = {m: growths[m] for m in asked}
        cells = self._over(own, "model long, node long, place long, feature long, cells binary", work)
        sent = self.spark.sparkContext.broadcast(asked)

        def of_feature(part: pa.Table) -> pa.Table:
            first = part.slice(0, 1).to_pylist()[0]
            total = np.zeros((2, 1, 1, trees.BINS))
            for raw in part.column("cells").to_pylist():
                total += np.frombuffer(raw).reshape(total.shape)
            whole = sent.value[first["model"]]
            at = slice(first["node"], first["node"] + 1)
            one = replace_asked(whole, at, np.array([[first["feature"]]]))
            f = trees.best_of_histogram(one, total)
            values = [first["model"], first["node"], float(f.gain[0]), int(f.feature[0]), int(f.cut[0]), float(f.n[0]), float(f.s[0])]
            return pa.table([[v] for v in values], ["model", "node", "gain", "feature", "cut", "n", "s"])

        schema = "model long, node long, gain double, feature long, cut long, n double, s double"
        each = cells.groupBy("model", "node", "place").applyInArrow(of_feature, schema)
        top = each.groupBy("model", "node").agg(F.max_by(F.struct("gain", "feature", "cut", "n", "s"), F.struct("gain", -F.col("feature"))).alias("top"))
        found = {m: Found(*(np.zeros(len(a.node), t) for t in (float, int, int, float, float))) for m, a in asked.items()}
        for r in top.collect():
            f = found[r.model]
            for name in ("gain", "feature", "cut", "n", "s"):
                getattr(f, name)[r.node] = r.top[name]
        return found

    def _per_feature(self, growths, asked, start, fold_in, kernel, how) -> dict[int, np.ndarray]:
        """Two numbers a node and feature, brought together by ``how``."""

        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                return (_pairs_batch(k, a) for k, a in kept.items())
            at = OverRows._places(growth, i, node)
            here = at >= 0
            part = kernel(m, block.bins, row[here], at[here], times[here], y[here])
            kept[m] = fold_in(kept[m], part) if m in kept else part
            return ()

        own = {m: growths[m] for m in asked}
        found = self._over(own, "model long, cell long, a double, b double", work).groupBy("model", "cell").agg(how[0]("a").alias("a"), how[1]("b").alias("b"))
        out = {m: np.stack([np.full(a.choice.size, float(v)) for v in start]) for m, a in asked.items()}
        table = found.toArrow()
        model, cell, a, b = (table.column(c).to_numpy() for c in ("model", "cell", "a", "b"))
        for m in asked:
            own_rows = model == m
            out[m][0, cell[own_rows]], out[m][1, cell[own_rows]] = a[own_rows], b[own_rows]
        return {m: v.reshape(2, *asked[m].choice.shape) for m, v in out.items()}

    def _ranges(self, growths, asked) -> dict[int, np.ndarray]:
        kernel = lambda m, codes, row, at, times, y: trees.ranges(codes, row, at, asked[m].choice)
        join = lambda a, b: np.stack([np.minimum(a[0], b[0]), np.maximum(a[1], b[1])])
        found = self._per_feature(growths, asked, (trees.BINS, -1), join, kernel, (F.min, F.max))
        return {m: v.astype(np.int16) for m, v in found.items()}

    def _left(self, growths, asked, cuts) -> dict[int, np.ndarray]:
        kernel = lambda m, codes, row, at, times, y: trees.left_sums(codes, row, at, times, y, asked[m].choice, cuts[m])
        return self._per_feature(growths, asked, (0, 0), np.add, kernel, (F.sum, F.sum))

    def _extras(self, growths: dict[int, Growth]) -> dict[tuple[int, int], np.ndarray]:
        """Sums for the leaves that need more than counts and targets."""
        specs, scale = self.specs, self.table.scale

        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                return (_extra_batch(k, a) for k, a in kept.items())
            tree = growth.trees[i]
            part = trees.leaf_extra(specs[m], block.y[row], margin[row], times, node, len(tree.feature), scale)
            kept[m, i] = kept[m, i] + part if (m, i) in kept else part
            return ()

        own = {m: g for m, g in growths.items() if specs[m].boosted and specs[m].loss != "squared"}
        if not own:
            return {}
        found = self._over(own, "model long, tree long, leaf long, cell long, v double", work).groupBy("model", "tree", "leaf", "cell").agg(F.sum("v").alias("v"))
        wide = {"logistic": 1, "absolute": trees.MEDIAN_CELLS}
        out = {(m, i): np.zeros((len(t.feature), wide[specs[m].loss])) for m, g in own.items() for i, t in enumerate(g.trees)}
        for r in found.collect():
            out[r.model, r.tree][r.leaf, r.cell] = r.v
        return out

    def _norm(self, models: list[int]) -> None:
        """Sums of the weights of adaptive models; a row a task and model comes to the driver."""

        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                return [_batch([(k, 0, *v) for k, v in kept.items()], ("model", "tree", "a", "b", "n"))]
            own = trees_norm(specs[m], block, margin)
            if own[2]:
                kept[m] = _joined(kept.get(m), own)
            return []

        specs = self.specs
        self.norms = {}
        empty = {m: _blank(specs[m], [0]) for m in models}
        for r in sorted(self._over(empty, "model long, tree long, a double, b double, n double", work).collect()):
            self.norms[r.model] = _joined(self.norms.get(r.model), (r.a, r.b, int(r.n)))

    def _voices(self, growths: dict[int, Growth]) -> None:
        """The say of finished adaptive trees from their errors on all rows."""
        specs, norms = self.specs, self.norms

        def work(kept, m, growth, i, block, margin, row, node, times, y):
            if m is None:
                return [_batch([(k, 0, *v) for k, v in kept.items()], ("model", "tree", "a", "b"))]
            spec, tree = specs[m], growth.trees[0]
            weight = np.exp(margin - norms[m][0]) * (block.fold != spec.held_out)
            wrong = trees.errors(spec, tree, tree.node_of(block.bins), block.y)
            old = kept.get(m, (0.0, 0.0))
            kept[m] = (old[0] + float(weight @ wrong), max(old[1], float(wrong[weight > 0].max(initial=0.0))))
            return []

        sums = self._over(growths, "model long, tree long, a double, b double", work).groupBy("model").agg(F.sum("a").alias("a"), F.max("b").alias("b"))
        for r in sums.collect():
            spec, tree = specs[r.model], growths[r.model].trees[0]
            worst = 1.0 if spec.classes else r.b
            if not trees.voice(spec, tree, r.a / (norms[r.model][1] * max(worst, 1e-300)), worst, not self.trees[r.model]):
                self.done.add(r.model)

    def _grow(self, models: dict[int, list[int]]) -> None:
        """The trees of these numbers of each model."""
        adaptive = [m for m in models if self.specs[m].adaptive]
        if adaptive:
            self._norm(adaptive)
        totals = self._totals(models)
        growths = {m: Growth(self.specs[m], n, totals[m], self.weights[m], self.table.width) for m, n in models.items()}
        while any(len(g.node) for g in growths.values()):
            self._level(growths)
        extra = self._extras(growths)
        for m, g in growths.items():
            for i, t in enumerate(g.trees):
                trees.set_values(self.specs[m], t, g.sums[i], extra.get((m, i)), self.table.scale, self.weights[m])
        if adaptive:
            self._voices({m: growths[m] for m in adaptive})
        for m, g in growths.items():
            self.trees[m] += [t for t in g.trees if t.say > 0]

    def _write_margins(self) -> None:
        """Margins of all boosted models as far as they are grown."""
        sent = self.spark.sparkContext.broadcast((self.specs, {m: t[self.since :] for m, t in enumerate(self.trees) if self.specs[m].sequential}))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    block = Block.of(b)
                    margins = np.frombuffer(b"".join(b.column("margins").to_pylist())).reshape(len(block.y), -1).copy()
                    specs, grown = sent.value
                    for m, new in grown.items():
                        for t in new:
                            own = margins[:, m].copy()
                            trees.advance(specs[m], t, t.node_of(block.bins), block.y, own)
                            margins[:, m] = own
                    yield b.set_column(b.schema.get_field_index("margins"), "margins", pa.array([r.tobytes() for r in margins], pa.binary()))

        old, known = self.state, self.since
        self.state = staged(old.mapInArrow(run, old.schema), "margins")
        if known:
            drop_staged(old)
        self.since += REPLAYED

    def fit(self) -> list[list[Tree]]:
        """Grow everything: forests some trees at a time, all boosted models round by round together."""
        for m, spec in enumerate(self.specs):
            if not spec.sequential:
                for numbers in batches_of(spec, 0, spec.trees):
                    self._grow({m: numbers})
        for k in range(max([s.trees for s in self.specs if s.sequential], default=0)):
            if k - self.since == REPLAYED:
                self._write_margins()
            if models := {m: [k] for m, s in enumerate(self.specs) if s.sequential and k < s.trees and m not in self.done}:
                self._grow(models)
        return self.trees

    def scores(self, marks: list[list[int]], schema: str) -> DataFrame:
        grown = self.fit()
        sent = self.spark.sparkContext.broadcast((self.specs, marks, grown, self.bases))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            specs, marks, grown, bases = sent.value
            for b in batches:
                if not b.num_rows:
                    continue
                block = Block.of(b)
                for m, spec in enumerate(specs):
                    at = np.flatnonzero(block.fold == spec.held_out)
                    total = np.full(len(at), bases[m])
                    for k, t in enumerate(grown[m], 1):
                        total += t.value[t.node_of(block.bins, at)]
                        if k in marks[m]:
                            yield _rows(m, k, block, at, total.copy() if spec.boosted else total / k)

        return self.table.rows.mapInArrow(run, schema)


def replace_asked(asked: Asked, at: slice, choice: np.ndarray) -> Asked:
    return Asked(asked.spec, asked.tree[at], asked.node[at], asked.n[at], asked.s[at], choice, asked.weights)


def _joined(a: tuple | None, b: tuple) -> tuple:
    """Two norms as one."""
    if a is None:
        return b
    top = max(a[0], b[0])
    return top, a[1] * float(np.exp(a[0] - top)) + b[1] * float(np.exp(b[0] - top)), a[2] + b[2]


def _blank(spec: Spec, numbers: list[int]) -> Growth:
    return Growth(spec, numbers, [(0.0, 0.0)] * len(numbers), None, 1)


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = {"a": pa.float64(), "b": pa.float64(), "n": pa.float64(), "s": pa.float64(), "v": pa.float64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names)], list(names))


def _cells_batch(m: int, hist: np.ndarray, choice: np.ndarray) -> pa.RecordBatch:
    """Histograms of the nodes and features with rows."""
    node, place = np.nonzero(hist[0].any(axis=2))
    raw = pa.array([hist[:, i, j].tobytes() for i, j in zip(node.tolist(), place.tolist())], pa.binary())
    columns = [pa.array(np.full(len(node), m)), pa.array(node), pa.array(place), pa.array(choice[node, place].astype(np.int64)), raw]
    return pa.RecordBatch.from_arrays(columns, ["model", "node", "place", "feature", "cells"])


def _pairs_batch(m: int, found: np.ndarray) -> pa.RecordBatch:
    a, b = found.reshape(2, -1).astype(np.float64)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), m)), pa.array(np.arange(len(a))), pa.array(a), pa.array(b)], ["model", "cell", "a", "b"])


def _extra_batch(key: tuple[int, int], found: np.ndarray) -> pa.RecordBatch:
    leaf, cell = np.nonzero(found)
    columns = [pa.array(np.full(len(leaf), k)) for k in key]
    return pa.RecordBatch.from_arrays([*columns, pa.array(leaf), pa.array(cell), pa.array(found[leaf, cell])], ["model", "tree", "leaf", "cell", "v"])
