"""SimHash near-duplicates through deletion variants of fingerprint segments.

A fingerprint has 64 bits; two texts link when at most four differ. Cut into three
segments, one of them differs by at most one bit (4 / 3 < 2). So every segment is
indexed under all its variants with one bit wiped out: two segments that differ by at
most one bit share a variant. An equality shuffle on the variants brings possible
partners together, and the full fingerprints are compared there.

Defined cases: a null or wordless text has fingerprint zero and links like any other.
Equal doc_ids and repeated rows are ordinary rows. A null doc_id never names a
component unless all its documents have none (then it is null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.llm.components import components
from buyerscope.sources.staging import drop_staged, staged

SHINGLE = 4
MOST_BITS = 4
SEED = 42
#: (lowest bit, width) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints a variant may gather on average before its keys are lengthened.
OCCUPANCY = 512
#: Runs of equal variants up to this length are compared pair by pair, longer ones by search.
SHORT_RUN = 32


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 over the word shingles, as a signed long."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    width = min(shingle, len(words))
    starts = (ends - size)[: len(words) - width + 1]
    digest = xxhash.xxh64_digest
    hashes = [digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends[width - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        raw = np.frombuffer(b"".join(hashes[at : at + (1 << 16)]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; text_hash tells rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fps = pa.array([fingerprint(t) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), utf8("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _variants(fps: DataFrame, blocks: int) -> DataFrame:
    """(key, fp): every segment with each of its bits wiped out.

    ``blocks`` > 1 adds, to each, the blocks of the other 42 or 43 bits in turn: with at
    most four bits differing, one of five blocks is equal, so no link is lost.
    """
    keys = []
    for low, width in SEGMENTS:
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        rest = [b for b in range(64) if not low <= b < low + width]
        for bit in range(width):
            key = part.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit((low + bit) << 22))
            if blocks == 1:
                keys.append(key)
                continue
            for j in range(blocks):
                mask = sum(1 << b for b in rest[j::blocks])
                mask -= (1 << 64) if mask >> 63 else 0
                keys.append(F.xxhash64(key, F.lit(j), F.col("fp").bitwiseAND(F.lit(mask))))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked among distinct fingerprints, at most one a node.

    A search that compares each reached fingerprint with all those not reached yet: in
    a dense run few are left after a few steps.
    """
    left, a, b = fps, [], []
    while len(left):
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= MOST_BITS
            found = left[near]
            if len(found):
                a.append(np.full(len(found), root))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    empty = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def run_links(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Links (n, 2) within the runs of equal keys; both arrays sorted by key."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[edge, len(key)])
    found = []
    for d in range(1, min(SHORT_RUN, int(size.max(initial=1)))):
        i = np.flatnonzero(key[d:] == key[:-d])
        near = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= MOST_BITS]
        found.append(np.stack([fp[near], fp[near + d]], 1))
    for k in np.flatnonzero(size > SHORT_RUN):
        found.append(np.stack(_forest(fp[edge[k] : edge[k] + size[k]]), 1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return np.unique(np.sort(pairs, axis=1), axis=0)


class _Sets:
    """Union-find over the fingerprints linked in a task."""

    def __init__(self) -> None:
        self.over: dict[int, int] = {}

    def top(self, x: int) -> int:
        over = self.over
        while (y := over.get(x, x)) != x:
            over[x] = x = over.get(y, y)
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.over[max(a, b)] = self.over[min(a, b)] = min(a, b)
        return a != b


def _sorted_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key; a run that reaches into the next batch waits for it.

    Of the links found, a task hands on those that connect what it had not connected yet.
    """
    sets = _Sets()

    def out(keys: list, fps: list) -> pa.RecordBatch:
        links = run_links(np.concatenate(keys), np.concatenate(fps)).tolist()
        new = [link for link in links if sets.joins(*link)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in new], pa.int64()) for i in (0, 1)], ["a", "b"])

    keys, fps = [], []
    for b in batches:
        if not b.num_rows:
            continue
        k, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cut = int(np.searchsorted(k, k[-1]))
        if cut or (keys and keys[-1][-1] != k[0]):
            yield out([*keys, k[:cut]], [*fps, f[:cut]])
            keys, fps = [], []
        keys.append(k[cut:])
        fps.append(f[cut:])
    if keys:
        yield out(keys, fps)


def links(fps: DataFrame) -> DataFrame:
    """Links (a < b) that connect all fingerprints of ``fps`` (distinct, column fp) at most four bits apart.

    Each task gives a spanning forest of the links it finds: the components are those
    of all links. Keys are lengthened by blocks once the average run would pass
    ``OCCUPANCY``; both ways find every link.
    """
    blocks = 1 if fps.count() <= OCCUPANCY << SEGMENTS[-1][1] else MOST_BITS + 1
    keyed = _variants(fps, blocks)
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_sorted_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root is the component's least fingerprint."""
    own = staged(fingerprints(docs), "fingerprints")
    distinct = staged(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    star = components(links(distinct.select("fp")))
    member = star.union(star.select(F.col("root").alias("node"), "root")).distinct()
    of = staged(member.join(distinct, member["node"] == distinct["fp"]).select("fp", "root", "first_id"), "members")
    named = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = of.join(named, "root").select("fp", "root", "component_id")
    alone = distinct.join(linked, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))
    label = staged(linked.union(alone), "labels")
    drop_staged(of)
    drop_staged(distinct)
    return own.join(label, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    It is the row of the smallest doc_id (null last), then of the smallest text hash;
    of rows alike in both one stays.
    """
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    found = near_duplicates(docs).groupBy("doc_id", "text_hash", "root").agg(F.count("*").alias("n"))
    best = found.groupBy("root").agg(F.min(F.struct(who.alias("who"), "n")).alias("w"))
    stay = staged(best.select(F.col("w.who.doc_id").alias("id"), F.col("w.who.text_hash").alias("hash"), "w.n"), "stay")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    kept = rows.join(stay, (F.col("own_hash") == F.col("hash")) & F.col("own_id").eqNullSafe(F.col("id")))
    alike = kept.where("n > 1").dropDuplicates(["hash", "id"])
    return kept.where("n = 1").select("row.*").union(alike.select("row.*"))
