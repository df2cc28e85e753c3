"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words. A document's expected copies are
proportional to its importance, at most ``CAP``, and sum (times words) to the target.
The whole part is given for certain. The rest is an inclusion probability p: documents
are ranked by u / (1 - u) divided by p / (1 - p), u being a random number, and the first
ones are taken until their words fill what is left of the target.

u is a hash of doc_id and text, so reruns agree. No source is sorted: the place where
the ranking is cut is found by counting words in ever narrower intervals, and each
document then decides for itself, without a shuffle.

Defined cases: null or empty texts have size 0 and are copied like others of size 0.
Null is a source of its own, last in order. Rows alike in doc_id and text are taken or
left together. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.llm.common import word_count
from buyerscope.sources.staging import drop_staged, staged

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
#: Sources whose figures fit the driver; more than that is an error.
MOST_SOURCES = 20_000
#: Counters that one narrowing step brings to the driver, over all sources.
COUNTERS = 1 << 16
#: Ranks left in an interval that are looked at one by one.
FEW = 64


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> dict:
    """Words to take from each source; what a full source can't take goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), list(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if per * weight[s] > cap * sizes[s]]
        if not full:
            return found | {s: per * weight[s] for s in open_}
        for s in full:
            found[s] = cap * sizes[s]
            left -= found[s]
            open_.remove(s)
    return found


def importance(size: Column) -> Column:
    """Twice as high for long documents as for very short ones."""
    return 1.0 + size / (size + F.lit(200.0))


def _measured(docs: DataFrame, *also: Column) -> DataFrame:
    """What the sampling needs of each row: source, words and random number."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("mixing"), F.col("doc_id"), F.col("text")), 12)
    u = (bits + 0.5) / F.lit(float(1 << 52))
    return docs.select(*also, F.col("source").alias("src"), word_count("text").alias("size"), u.alias("u"))


def _with(rows: DataFrame, values: dict, names: str) -> DataFrame:
    """Each row with its source's figures; their number is checked before."""
    spark = rows.sparkSession
    data = [(s, *v) for s, v in values.items()]
    small = spark.createDataFrame(data, f"of_source string, {names}")
    return rows.join(F.broadcast(small), F.col("src").eqNullSafe(F.col("of_source"))).drop("of_source")


def _factors(rows: DataFrame, target: dict, sizes: dict) -> dict:
    """Factor c of each source: sum of min(CAP, c * importance) * size is its target."""
    imp, full = importance(F.col("size")), float("inf")
    c = {s: full if target[s] >= CAP * sizes[s] else 0.0 for s in sizes}
    first = True
    while True:
        capped = F.col("c") * imp >= CAP
        sums = _with(rows, {s: (x,) for s, x in c.items() if x < full}, "c double").groupBy("src").agg(
            F.sum(F.when(capped, F.col("size")).otherwise(0)).alias("capped"),
            F.sum(F.when(capped, 0.0).otherwise(imp * F.col("size"))).alias("free"),
        )
        new = dict(c)
        for r in sums.collect():
            new[r.src] = (target[r.src] - CAP * r.capped) / r.free if r.free else full
        if not first and all(new[s] <= c[s] * (1 + 1e-12) for s in c):
            return new
        c, first = new, False


def _expected(c: Column) -> Column:
    return F.least(F.lit(CAP), c * importance(F.col("size")))


def _rank(c: Column, odds: Column) -> Column:
    """A number between 0 and 1 that grows with the Pareto rank; null for documents without a random part.

    Dividing by ``odds``, those of the source as a whole, spreads it over the interval.
    """
    e = _expected(c)
    p = e - F.floor(e)
    u = F.col("u")
    q = (u / (1 - u)) / (p / (1 - p)) * odds
    return F.when(p > 0, q / (1 + q))


def _cuts(rows: DataFrame, left: dict) -> dict:
    """The last rank to take in each source, so that the words taken come nearest to ``left``.

    rows: src, size, rank. Each step counts words in equal parts of an interval and goes
    on with the part in which the sum passes what is left.
    """
    at = {s: (0.0, 1.0, 0.0) for s, x in left.items() if x > 0}
    cut = {s: -1.0 for s in left}
    bins = max(2, COUNTERS // max(1, len(left)))
    while at:
        inside = _with(rows, {s: v[:2] for s, v in at.items()}, "lo double, hi double").where("rank >= lo and rank < hi")
        part = F.floor((F.col("rank") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
        sums = inside.groupBy("src", F.least(part, F.lit(bins - 1)).alias("part")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("rank").alias("first"), F.max("rank").alias("last")
        )
        by: dict = {}
        for r in sums.collect():
            by.setdefault(r.src, []).append(r)
        nearer: dict = {}
        few: dict = {}
        for s, (lo, hi, taken) in at.items():
            for r in sorted(by.get(s, []), key=lambda r: r.part):
                if taken + r.size <= left[s]:
                    taken, cut[s] = taken + r.size, r.last
                    continue
                if r.first == r.last or r.n <= FEW:
                    few[s] = (r.first, r.last, taken)
                else:
                    nearer[s] = (r.first, math.nextafter(r.last, 2.0), taken)
                break
        if few:
            near = _with(rows, {s: v[:2] for s, v in few.items()}, "lo double, hi double").where("rank between lo and hi")
            ranks = near.groupBy("src", "rank").agg(F.sum("size").alias("size")).orderBy("rank").collect()
            for s, (_, _, taken) in few.items():
                for r in (r for r in ranks if r.src == s):
                    if abs(taken + r.size - left[s]) > abs(taken - left[s]):
                        break
                    taken, cut[s] = taken + r.size, r["rank"]
        at = nearer
    return cut


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> dict:
    """By source: (size, target, factor, odds, cut); all that a document needs to decide."""
    rows = staged(_measured(docs), "sizes")
    found = rows.groupBy("src").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = {r.src: r["size"] for r in found}
    if not sizes:
        return {}
    target = targets(sizes, weights, share)
    c = _factors(rows, target, sizes)
    e = _expected(F.col("c"))
    parts = _with(rows, {s: (x,) for s, x in c.items()}, "c double").groupBy("src").agg(
        F.sum(F.floor(e) * F.col("size")).alias("sure"), F.sum((e - F.floor(e)) * F.col("size")).alias("random"),
        F.sum(F.when(e > F.floor(e), F.col("size")).otherwise(0)).alias("open"),
    ).collect()
    left = {r.src: target[r.src] - r.sure for r in parts}
    odds = {r.src: r["random"] / (r.open - r["random"]) if r.open > r["random"] else 1.0 for r in parts}
    ranked = _with(rows, {s: (c[s], odds[s]) for s in sizes}, "c double, odds double")
    ranked = ranked.select("src", "size", _rank(F.col("c"), F.col("odds")).alias("rank")).where("rank is not null")
    cut = _cuts(ranked, left)
    drop_staged(rows)
    return {s: (sizes[s], target[s], c[s], odds[s], cut[s]) for s in sizes}


def copies(docs: DataFrame, of_source: dict) -> DataFrame:
    """Rows (row, size, source_size, target, copies); row holds the columns of ``docs``."""
    packed = _measured(docs, F.struct("*").alias("row"))
    known = _with(packed, of_source, "source_size long, target double, c double, odds double, cut double")
    more = _rank(F.col("c"), F.col("odds")) <= F.col("cut")
    n = F.floor(_expected(F.col("c"))) + F.coalesce(more, F.lit(False)).cast("int")
    return known.select("row", "size", "source_size", "target", n.cast("int").alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    taken = copies(docs, plan(docs, weights, share)).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
