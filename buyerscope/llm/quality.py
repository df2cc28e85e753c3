"""Quality rules on repetition, by suffix arrays.

The words of many texts are laid end to end, each word numbered within its own text, so
that no two texts share a prefix. Prefix doubling sorts all suffixes with array
operations; only suffixes that are not yet told apart are sorted again. The ranks kept
from each doubling give the longest common prefix of neighbours. Intervals of the suffix
array with a common prefix are the repeated substrings; those that can't be extended on
either side are maximal. The union of their spans is what a text repeats.

A text is rejected by the method when maximal repeats of ``LEAST`` words or more cover
more than ``MOST_COVERED`` of its words, or when its longest repeat has more than
``LONGEST_WORDS`` words and more than ``LONGEST_SHARE`` of the text.

Defined cases: a null text has no words and fails the base rule; equal and repeated rows
are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8

LEAST = 5
MOST_COVERED = 0.3
LONGEST_WORDS = 40
LONGEST_SHARE = 0.2
#: Base rule.
BASE_WORDS = 20
BASE_WINDOW = 8
BASE_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
#: Bytes of text sorted together; a longer text is sorted alone.
AT_ONCE = 1 << 21


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the common prefix of each suffix with the one before it.

    Equal tokens must stand in the same text, and a text's end must tell suffixes apart:
    then no common prefix crosses into the next text.
    """
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(tokens, kind="stable")
    new = np.r_[True, np.diff(tokens[order]) != 0]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, active, width = [rank.astype(np.int32)], _shared(order, new), 1
    while len(active):
        ahead = active + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(rank[active] * (n + 1) + second, kind="stable")
        active, second = active[by], second[by]
        old = rank[active]
        old_new = np.r_[True, np.diff(old) != 0]
        new = old_new | np.r_[True, np.diff(second) != 0]
        at = np.arange(len(active))
        rank[active] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old_new, at, 0))
        levels.append(rank.astype(np.int32))
        active, width = _shared(active, new), width * 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    prefix = np.zeros(n, np.int64)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    i, j, common = order[at - 1], order[at], np.zeros(len(at), np.int64)
    for k in reversed(range(len(levels))):
        inside = np.maximum(i, j) < n
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        step = np.where(same, 1 << k, 0)
        i, j, common = i + step, j + step, common + step
    prefix[at] = common
    return order, prefix


def _shared(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Members of groups of two or more; ``new`` marks where a group begins."""
    return order[~(new & np.r_[new[1:], True])]


def maximal_repeats(tokens: np.ndarray, order: np.ndarray, prefix: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last) of the intervals of the suffix array that are maximal repeats of ``least`` tokens or more."""
    before = np.where(order > 0, tokens[order - 1], -1)
    changes = np.cumsum(np.r_[0, np.diff(before) != 0])
    found, stack = [], []

    def close(length: int, last: int) -> int:
        first = last
        while stack and stack[-1][0] > length:
            size, first = stack.pop()
            if changes[last] != changes[first]:
                found.append((size, first, last))
        return first

    at = np.flatnonzero(prefix >= least)
    end = -1
    for p, length in zip(at.tolist(), prefix[at].tolist()):
        if p != end:
            close(0, end - 1)
            stack.clear()
        first = close(length, p - 1) if stack and stack[-1][0] > length else p - 1
        if not stack or stack[-1][0] < length:
            stack.append((length, first))
        end = p + 1
    close(0, end - 1)
    return found


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that differ between texts, and where each text begins."""
    number: dict[bytes, int] = {}
    get = number.setdefault
    words = np.fromiter((get(w, len(number)) for t in texts for w in t), np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    return words + np.repeat(np.arange(len(texts)), size) * (len(number) + 1), np.r_[0, np.cumsum(size)]


def _covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    edge = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def measure(texts: list[bytes]) -> dict[str, list]:
    """All measures of each text."""
    words = [t.split() for t in texts]
    tokens, first = _numbered(words)
    n = len(tokens)
    order, prefix = suffix_array(tokens)
    repeat = np.zeros(n, np.int64)  # longest prefix of each suffix that occurs elsewhere in the text
    np.maximum.at(repeat, order, np.maximum(prefix, np.r_[prefix[1:], 0])) if n else None
    window = np.flatnonzero(repeat >= BASE_WINDOW)
    long = np.flatnonzero(repeat >= LEAST)
    in_window = np.r_[0, np.cumsum(_covered(window, np.full(len(window), BASE_WINDOW), n))]
    in_repeat = np.r_[0, np.cumsum(_covered(long, repeat[long], n))]
    intervals = maximal_repeats(tokens, order, prefix, LEAST)
    text_of = np.searchsorted(first, order[[i[1] for i in intervals]], "right") - 1 if intervals else np.empty(0, np.int64)
    n_repeats = np.bincount(text_of, minlength=len(texts))
    longest = [int(repeat[a:b].max(initial=0)) for a, b in zip(first[:-1], first[1:])]
    longest = [x if x >= LEAST else 0 for x in longest]
    out: dict[str, list] = {k: [] for k in MEASURES}
    for i, (text, own) in enumerate(zip(texts, words)):
        a, b = first[i], first[i + 1]
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        size, doubled, covered = len(own), int(in_window[b] - in_window[a]), int(in_repeat[b] - in_repeat[a])
        failed = size < BASE_WORDS or 100 * doubled > BASE_PERCENT * size
        rejected = covered > MOST_COVERED * size or (longest[i] > LONGEST_WORDS and longest[i] > LONGEST_SHARE * size)
        for k, v in zip(MEASURES, (
            size, sum(len(w.decode()) for w in own) if not text.isascii() else sum(map(len, own)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), doubled,
            failed, not failed and not rejected, covered, longest[i], int(n_repeats[i]),
        )):
            out[k].append(v)
    return out


MEASURES = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(), "kept": pa.bool_(), "n_covered_words": pa.int64(), "longest_repeat": pa.int64(), "n_maximal_repeats": pa.int64(),
}


def judge(docs: DataFrame) -> DataFrame:
    """doc_id and all measures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", AT_ONCE):
            found = measure(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(found[k], t) for k, t in MEASURES.items()]], ["doc_id", *MEASURES])

    kind = {pa.int64(): "long", pa.bool_(): "boolean"}
    schema = "doc_id long, " + ", ".join(f"{k} {kind[t]}" for k, t in MEASURES.items())
    return docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text")).mapInArrow(run, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, n_words, times) of every maximal repeat; start_word is one of its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", AT_ONCE):
            tokens, first = _numbered([t.split() for t in b.column("text").to_pylist()])
            order, prefix = suffix_array(tokens)
            rows = maximal_repeats(tokens, order, prefix, LEAST)
            start = [int(order[x[1] : x[2] + 1].min()) for x in rows]
            text = (np.searchsorted(first, start, "right") - 1).tolist() if rows else []
            ids = b.column(0).to_pylist()
            columns = [[ids[t] for t in text], [s - int(first[t]) for s, t in zip(start, text)], [x[0] for x in rows], [x[2] - x[1] + 1 for x in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start_word", "n_words", "times"])

    rows = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start_word long, n_words long, times long")
