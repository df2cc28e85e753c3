"""Benchmark decontamination by latent semantic retrieval.

1. Passages are windows of two blocks of 16 words. Their terms are those of the
   benchmark; document frequencies are counted over all blocks of all documents.
2. A randomised SVD of the TF-IDF matrix gives the latent space. The matrix holds the
   benchmark's own passages and all blocks of all documents. Each product with it is one
   distributed pass over the blocks' term numbers, and only matrices of the size terms x
   rank reach the driver. A task adds up how often the most frequent terms meet and
   multiplies once; blocks with a rarer term are multiplied one by one.
3. Every passage of every document is projected and compared with the benchmark's
   passages in blocks. The cosine takes the norm of a passage's whole TF-IDF vector, words
   foreign to the benchmark included, so a small overlap can't look like a match.
4. Candidates are checked: the longest common subsequence of the item's words and the
   words around the passage must cover ``FULL`` of the item, or ``PARTLY`` of it when the
   item's answer (column answer, else its last sentence) is found there too.

Text is compared in lower case (A-Z) without ASCII punctuation. Everything but 1 and 2
is a scan without shuffle. The benchmark is the query set: it is sent to the tasks in
groups of at most ``ITEMS`` items, one scan each.

Defined cases: null or wordless items and texts match nothing. Repeated items and rows
give results of their own. An empty table on either side gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.sources.staging import drop_staged, staged

BLOCK = 16
RANK = 128
OVERSAMPLE = 8
POWER_PASSES = 1
ITEMS = 20_000
#: How often the benchmark's own passages count beside up to FIT_BLOCKS blocks, so that its rare terms shape the
#: space; beside more blocks they count more in proportion, or the corpus would crowd them out of it.
FIT_BLOCKS = 20_000
OWN_WEIGHT = 1_000.0
COSINE = 0.3
#: A word of a window counts up to this often before a window may be left out unprojected.
REPEATS = 2
FULL = 0.75
PARTLY = 0.55
ANSWER = 0.8
#: Bytes of text that a task turns into arrays at once.
AT_ONCE = 1 << 21
#: Passages of which a task holds the latent rows at once.
PASSAGES_AT_ONCE = 512
#: Terms whose meetings a task adds up in half a square table (67 MB), its rows multiplied at once, entries added at once, and blocks for a table to pay.
HOT_TERMS = 1 << 12
ROWS_AT_ONCE = 256
ENTRIES_AT_ONCE = 1 << 16
BLOCKS_A_TASK = 2_000_000
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Item(NamedTuple):
    item_id: int | None
    words: list[bytes]
    answer: list[bytes]


class Index(NamedTuple):
    """What a task needs: terms, their latent vectors and squared weights (the last for foreign words), queries."""

    terms: dict[bytes, int]
    latent: np.ndarray
    square: np.ndarray
    queries: np.ndarray
    owner: np.ndarray
    items: list[Item]


def read_items(benchmark: DataFrame, group: int, groups: int) -> list[Item]:
    """A group of the benchmark's items."""
    answer = utf8("answer") if "answer" in benchmark.columns else F.lit(None).cast("binary")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group
    rows = benchmark.where(part).select("item_id", utf8("text").alias("text"), answer.alias("answer")).collect()
    found = []
    for r in rows:
        text = bytes(r["text"])
        last = [s for s in text.translate(_SENTENCE).split(b"\n") if s.strip()]
        own = words_of(bytes(r.answer)) if r.answer else words_of(last[-1]) if len(last) > 1 else []
        if words := words_of(text):
            found.append(Item(r.item_id, words, own))
    return sorted(found, key=lambda i: (i.item_id is None, i.item_id or 0, i.words))


_SENTENCE = bytes(10 if chr(c) in ".?!" else c for c in range(256))


def _ids(words: list[bytes], terms: dict[bytes, int]) -> np.ndarray:
    """Term of each word; foreign words get the number after the last term."""
    return np.fromiter(map(terms.get, words, repeat(len(terms))), np.int32, len(words))


def _blocks(batch: pa.RecordBatch, terms: dict[bytes, int]):
    """Term ids and block numbers of a batch's words, and the blocks each document begins with."""
    texts = [words_of(t) for t in batch.column("text").to_pylist()]
    size = np.array([len(w) for w in texts], np.int64)
    first = np.r_[0, np.cumsum(-(-size // BLOCK))]
    ids = np.concatenate([_ids(w, terms) for w in texts]) if len(texts) else np.empty(0, np.int32)
    at = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
    return texts, ids, np.repeat(first[:-1], size) + at // BLOCK, first


def _passages(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(ids, counts) of the blocks of all documents as bytes, and ``blocks`` 0; also rows that say how many blocks a slice had."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    n = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", AT_ONCE):
            _, ids, block, first = _blocks(b, sent.value)
            pair, count = np.unique(block[ids < n] * n + ids[ids < n], return_counts=True)
            begin = np.r_[np.flatnonzero(np.diff(pair // n, prepend=-1)), len(pair)]
            parts = [_packed(pair % n, begin, np.int32), _packed(count, begin, np.uint8), pa.array(np.zeros(len(begin) - 1, np.int64))]
            yield pa.RecordBatch.from_arrays(parts, ["ids", "counts", "blocks"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([int(first[-1])])], ["ids", "counts", "blocks"])

    rows = docs.select(utf8("text").alias("text"))
    return staged(rows.mapInArrow(run, "ids binary, counts binary, blocks long"), "passages")


def _packed(values: np.ndarray, begin: np.ndarray, kind: type) -> pa.Array:
    """The bytes of small numbers, a row from each begin to the next."""
    data = np.ascontiguousarray(values, kind)
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer((begin * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all rows, and where each row begins."""
    offset = np.dtype(np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    at = np.frombuffer(column.buffers()[1], offset, len(column) + 1, column.offset * offset.itemsize) // np.dtype(kind).itemsize
    data = column.buffers()[2]
    return np.frombuffer(data, kind, at[-1] - at[0], at[0] * np.dtype(kind).itemsize) if data else np.empty(0, kind), at[:-1] - at[0]


def _frequencies(passages: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Blocks that hold each of n terms, and the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n + 1, np.int64)
        for b in batches:
            if b.num_rows:
                counts[:n] += np.bincount(_unpacked(b.column("ids"), np.int32)[0], minlength=n)
                counts[n] += pa.compute.sum(b.column("blocks")).as_py()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    sums = passages.select("ids", "blocks").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(n + 1, np.int64)
    for r in sums.collect():
        counts[r.term] = r.n
    return counts[:n], int(counts[n])


def _add_products(out: np.ndarray, ids: np.ndarray, counts: np.ndarray, begin: np.ndarray, idf: np.ndarray, right: np.ndarray, weight: float = 1.0) -> None:
    """Adds A'A times ``right`` for the passages that begin at the given places of ids and counts."""
    size = np.diff(np.r_[begin, len(ids)])
    a = counts * idf[ids]
    a /= np.repeat(np.sqrt(np.add.reduceat(a * a, begin)), size)
    seen = np.add.reduceat(right[ids] * a[:, None], begin, axis=0)
    back = np.repeat(seen, size, axis=0) * (weight * a)[:, None]
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
    out[ids[order][first]] += np.add.reduceat(back[order], first, axis=0)


class Meetings:
    """A'A of passages of hot terms only, entry by entry; a passage's terms come in ascending order."""

    def __init__(self, idf: np.ndarray) -> None:
        self.idf = idf
        self.hot = np.sort(np.argsort(idf, kind="stable")[:HOT_TERMS])
        self.place = np.full(len(idf), -1)
        self.place[self.hot] = np.arange(len(self.hot))
        n = np.arange(len(self.hot))
        self.row = n * len(n) - n * (n + 1) // 2  # entry (i, j) with i <= j stands at row[i] + j
        self.table = np.zeros(len(n) * (len(n) + 1) // 2)

    def add(self, ids: np.ndarray, counts: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes in the passages of hot terms; returns ids, counts and begins of the others."""
        of = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(ids)]))
        at = self.place[ids]
        cold = np.zeros(len(begin), bool)
        cold[of[at < 0]] = True
        rest = cold[of]
        a = counts * self.idf[ids]
        a /= np.sqrt(np.bincount(of, a * a))[of]
        own, at, a = of[~rest], at[~rest], a[~rest]
        for gap in range(min(BLOCK, len(own))):
            if gap:
                both = np.flatnonzero(own[gap:] == own[:-gap])
                if not len(both):
                    break
            else:
                both = np.arange(len(own))
            np.add.at(self.table, self.row[at[both]] + at[both + gap], a[both] * a[both + gap])
        return ids[rest], counts[rest], np.flatnonzero(np.diff(of[rest], prepend=-1))

    def product(self, right: np.ndarray) -> np.ndarray:
        """The whole table times the hot rows of a matrix."""
        own, n = right[self.hot], len(self.hot)
        out = np.zeros(own.shape)
        for start in range(0, n, ROWS_AT_ONCE):
            end = min(n, start + ROWS_AT_ONCE)
            rows = np.zeros((end - start, n))
            for i in range(start, end):
                rows[i - start, i:] = self.table[self.row[i] + i : self.row[i] + n]
            out[start:end] += rows @ own
            at = np.arange(start, end)
            rows[at - start, at] = 0.0  # the diagonal counts once
            out += rows.T @ own[start:end]
        return out


def _product(passages: DataFrame, own: list, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'A times a matrix, A being the TF-IDF rows of the documents' and of the benchmark's passages."""
    spark = passages.sparkSession
    sent = spark.sparkContext.broadcast((idf, right))
    width = right.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, right = sent.value
        out, met = np.zeros(right.shape), Meetings(idf)
        for b in batches:
            for at in range(0, b.num_rows, ENTRIES_AT_ONCE // BLOCK):
                some = b.slice(at, ENTRIES_AT_ONCE // BLOCK)
                (ids, begin), (counts, _) = _unpacked(some.column("ids"), np.int32), _unpacked(some.column("counts"), np.uint8)
                ids, counts, begin = met.add(ids, counts, begin)
                for i in range(0, len(begin), PASSAGES_AT_ONCE):
                    part = slice(begin[i], begin[i + PASSAGES_AT_ONCE] if i + PASSAGES_AT_ONCE < len(begin) else len(ids))
                    _add_products(out, ids[part], counts[part], begin[i : i + PASSAGES_AT_ONCE] - begin[i], idf, right)
        out[met.hot] += met.product(right)
        at = np.flatnonzero(out.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at)] + [pa.array(out[at, i]) for i in range(width)], names)

    names = ["term", *[f"y{i}" for i in range(width)]]
    schema = "term long, " + ", ".join(f"y{i} double" for i in range(width))
    sums = passages.mapInArrow(run, schema).groupBy("term").agg(*[F.sum(f"y{i}").alias(f"y{i}") for i in range(width)])
    out = np.zeros(right.shape)
    for r in sums.collect():
        out[r[0]] = r[1:]
    for ids, counts, weight in own:
        _add_products(out, ids, counts, np.zeros(1, np.int64), idf, right, weight)
    return out


def latent_space(passages: DataFrame, own: list, idf: np.ndarray) -> np.ndarray:
    """Leading right singular vectors (terms x rank) by a randomised range finder."""
    width = min(len(idf), RANK + OVERSAMPLE)
    basis = np.random.default_rng(7).standard_normal((len(idf), width))
    for _ in range(1 + POWER_PASSES):
        basis = np.linalg.qr(_product(passages, own, idf, basis))[0]
    small = basis.T @ _product(passages, own, idf, basis)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return basis @ vector[:, np.argsort(value)[::-1][:RANK]]


def fit(docs: DataFrame, items: list[Item]) -> Index:
    """The index of a group of items for a corpus; its space from all passages."""
    terms = {w: i for i, w in enumerate(sorted({w for item in items for w in item.words}))}
    passages = _passages(docs, terms)
    df, n_blocks = _frequencies(passages, len(terms))
    idf = np.log((n_blocks + 2.0) / (df + 1.0))
    owner, own = [], []
    for i, item in enumerate(items):
        pieces = max(1, round(len(item.words) / (2 * BLOCK)))
        for piece in np.array_split(_ids(item.words, terms), pieces):
            own.append(np.unique(piece, return_counts=True))
            owner.append(i)
    weight = OWN_WEIGHT * max(1.0, n_blocks / FIT_BLOCKS)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, n_blocks // BLOCKS_A_TASK)
    known = passages.where("blocks = 0").select("ids", "counts").coalesce(tasks)
    space = latent_space(known, [(ids, counts, weight) for ids, counts in own], idf)
    drop_staged(passages)
    weighted = idf[:, None] * space
    queries = np.stack([counts @ weighted[ids] for ids, counts in own])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
    foreign = np.mean(idf) ** 2
    return Index(
        terms, np.r_[weighted, np.zeros((1, weighted.shape[1]))].astype(np.float32),
        np.r_[idf**2, foreign].astype(np.float32), queries.astype(np.float32), np.array(owner), items,
    )


def common_subsequence(item: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit-parallel steps."""
    masks: dict[bytes, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in words:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _windows(first: np.ndarray) -> np.ndarray:
    """The second block of the window that begins at each block; one past the last where there is none."""
    n = int(first[-1])
    follow = np.arange(1, n + 1)
    follow[first[1:][np.diff(first) > 0] - 1] = n  # the last block of a document stands alone
    return follow


def candidates(ids: np.ndarray, block: np.ndarray, first: np.ndarray, index: Index) -> list[tuple[int, int, float]]:
    """(window, item, cosine) above the threshold.

    A latent vector is never longer than the known part of a passage, so windows whose
    known part is too small (twice over, as repeated words add up) are not projected.
    """
    n, follow, known = int(first[-1]), _windows(first), ids < len(index.terms)
    square, inside = np.zeros(n + 1), np.zeros(n + 1)
    square[:n] = np.bincount(block, weights=index.square[ids], minlength=n)
    inside[:n] = np.bincount(block[known], weights=index.square[ids[known]], minlength=n)
    square, inside = square[:n] + square[follow], inside[:n] + inside[follow]
    may = np.flatnonzero(inside >= (COSINE * COSINE / REPEATS) * square)
    if not len(may):
        return []
    needed = np.zeros(n + 1, bool)
    needed[may] = needed[follow[may]] = True
    sums, rows = np.zeros((n + 1, index.latent.shape[1]), np.float32), np.flatnonzero(needed[:n])
    begin = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    slot = np.arange(len(block)) - np.repeat(begin, np.diff(np.r_[begin, len(block)]))
    filled = np.full((n, BLOCK), len(index.terms), np.int32)  # foreign words and empty slots have the zero vector
    filled[block, slot] = ids
    for at in range(0, len(rows), 1024):
        some = rows[at : at + 1024]
        sums[some] = index.latent[filled[some]].sum(axis=1)
    found = []
    for at in range(0, len(may), 4096):
        some = may[at : at + 4096]
        vectors = (sums[some] + sums[follow[some]]) / np.sqrt(np.maximum(square[some], 1e-12))[:, None]
        for q in range(0, len(index.queries), 1024):
            cosine = vectors @ index.queries[q : q + 1024].T
            w, i = np.nonzero(cosine >= COSINE)
            found += zip(some[w].tolist(), index.owner[q + i].tolist(), cosine[w, i].tolist())
    return found


def matches(texts: list, ids: np.ndarray, block: np.ndarray, first: np.ndarray, index: Index) -> list[dict]:
    """The best confirmed passage of each document and item."""
    best: dict[tuple[int, int], dict] = {}
    word_of = np.r_[0, np.cumsum([len(t) for t in texts])]
    terms_of = {i: np.unique(_ids(index.items[i].words, index.terms), return_counts=True) for i in set(index.owner.tolist())}
    done = set()
    for window, i, cosine in candidates(ids, block, first, index):
        d = int(np.searchsorted(first, window, "right")) - 1
        if (d, i, window) in done:
            continue
        done.add((d, i, window))
        item, begin = index.items[i], (window - int(first[d])) * BLOCK
        size = len(item.words)
        start, end = max(0, begin - size), min(len(texts[d]), begin + 2 * BLOCK + size)
        # no common subsequence is longer than what the two have in common in any order
        counts = np.bincount(ids[word_of[d] + start : word_of[d] + end], minlength=len(index.terms))
        if np.minimum(counts[terms_of[i][0]], terms_of[i][1]).sum() < PARTLY * size:
            continue
        around = texts[d][start:end]
        common = common_subsequence(item.words, around)
        answered = bool(item.answer) and common_subsequence(item.answer, around) >= ANSWER * len(item.answer)
        if common >= FULL * size or (answered and common >= PARTLY * size):
            old = best.get((d, i))
            if old is None or (common, cosine) > (old["n_common"], old["cosine"]):
                best[d, i] = {"doc": d, "item": i, "start_word": start, "end_word": end, "cosine": float(cosine), "n_common": common, "answered": answered}
    return list(best.values())


def _groups(benchmark: DataFrame) -> int:
    return max(1, -(-benchmark.count() // ITEMS))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row and item found in it: where, how alike, and how many words in common."""
    groups, found = _groups(benchmark), None
    schema = "doc_id long, item_id long, start_word long, end_word long, cosine double, n_common long, n_item long, answered boolean"
    rows = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    for g in range(groups):
        items = read_items(benchmark, g, groups)
        if not items:
            continue
        sent = docs.sparkSession.sparkContext.broadcast(fit(docs, items))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text", AT_ONCE):
                index, ids = sent.value, b.column("doc_id").to_pylist()
                hits = matches(*_blocks(b, index.terms), index)
                yield pa.RecordBatch.from_pylist(
                    [
                        {k: m[k] for k in ("start_word", "end_word", "cosine", "n_common", "answered")}
                        | {"doc_id": ids[m["doc"]], "item_id": index.items[m["item"]].item_id, "n_item": len(index.items[m["item"]].words)}
                        for m in hits
                    ],
                    _SCHEMA,
                )

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()),
     ("cosine", pa.float64()), ("n_common", pa.int64()), ("n_item", pa.int64()), ("answered", pa.bool_())]
)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no item is found, with all their columns."""
    groups, clean = _groups(benchmark), docs
    for g in range(groups):
        items = read_items(benchmark, g, groups)
        if not items:
            continue
        sent = docs.sparkSession.sparkContext.broadcast(fit(docs, items))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                texts = whole.column("text").cast(pa.binary()).fill_null(b"")
                numbered = pa.RecordBatch.from_arrays([texts, pa.array(range(whole.num_rows))], ["text", "at"])
                keep = np.ones(whole.num_rows, bool)
                for b in slices(iter([numbered]), "text", AT_ONCE):
                    at = b.column("at")[0].as_py()
                    for m in matches(*_blocks(b, sent.value.terms), sent.value):
                        keep[at + m["doc"]] = False
                yield whole.filter(pa.array(keep))

        clean = clean.mapInArrow(run, docs.schema)
    return clean
