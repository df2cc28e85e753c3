"""Fill-in-middle: texts cut in three and put together in another order, and back.

A text is cut into units: code points, words (with the white space after them) or lines.
Fixed blocks of its UTF-8 bytes carry the number of units and of code points that begin in
them, in a Fenwick tree a text. A cut after k units goes down the tree in halving steps to
the block where unit k begins, adding up the code points passed; only that block is looked
at byte by byte. All texts of a slice are searched side by side.

Where a text is cut and which form it takes follow from the SHA-256 of seed and doc_id, so a
retried task makes the same output. The operator is one narrow pass without shuffle.

    plain  the text: it is empty, holds a sentinel, or the draw leaves it whole
    psm    P prefix S suffix M middle
    spm    S suffix P prefix M middle

Defined cases: a null text is empty; a null doc_id is hashed as empty; repeated rows get
equal outputs; an empty table gives no rows; columns of the input with the names of the
output (in any case) are left out. A text of any length is cut whole. Bytes that are not
UTF-8 go along with the code point before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from buyerscope.llm.common import replaced, slices, utf8

SENTINELS = ("<P>", "<S>", "<M>")
#: Draws are per cent: this many texts are rearranged, and of those this many begin with the suffix.
REARRANGED = 90
SUFFIX_FIRST = 20
SEED = 1
#: Bytes of a block.
BLOCK = 512
#: Bytes of text that a task searches at once.
AT_ONCE = 1 << 22

_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))


def _begins(data: np.ndarray, first: np.ndarray, unit: str) -> np.ndarray:
    """At which bytes a unit begins; ``first`` holds where the texts begin, none of them empty."""
    if unit == "char":
        return (data & 0xC0) != 0x80
    gap = _SPACE[data] if unit == "word" else data == ord("\n")
    begins = np.r_[True, gap[:-1]]
    if unit == "word":
        begins &= ~gap
    begins[first] = True
    if unit == "word":  # white space at the head of a text belongs to its first word
        words = np.flatnonzero(begins & ~gap)
        head = first[gap[first]]
        after = np.searchsorted(words, head)
        words = np.append(words, len(data))[after]
        inside = words < np.append(first, len(data))[np.searchsorted(first, head) + 1]
        begins[words[inside]] = False
    return begins


class Forest:
    """The Fenwick trees of many texts."""

    def __init__(self, texts: list[bytes], unit: str = "char", block: int = BLOCK) -> None:
        if unit not in ("char", "word", "line"):
            raise ValueError(f"no such unit: {unit}")
        size = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.start = np.cumsum(size) - size
        self.end = self.start + size
        self.block = block
        self.n_blocks = -(-size // block)
        self.first = np.cumsum(self.n_blocks) - self.n_blocks
        self.begins = _begins(self.data, self.start[size > 0], unit) if len(self.data) else np.empty(0, bool)
        self.points = (self.data & 0xC0) != 0x80
        of = np.repeat(np.arange(len(texts)), self.n_blocks)
        place = np.arange(len(of)) - self.first[of] + 1  # within its text, from 1
        edge = self.start[of] + (place - 1) * block
        low = place & -place
        at = np.arange(1, len(of) + 1)
        self.units, self.chars = [], []
        for marks, tree in ((self.begins, "units"), (self.points, "chars")):
            upto = np.r_[0, np.cumsum(np.add.reduceat(marks, edge, dtype=np.int64))] if len(edge) else np.zeros(1, np.int64)
            setattr(self, tree, upto[at] - upto[at - low])
            setattr(self, f"n_{tree}", upto[self.first + self.n_blocks] - upto[self.first])

    def cut(self, text: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text asked for: the byte (from the text's begin) and the code point where its first ``after`` units end."""
        m, first = self.n_blocks[text], self.first[text]
        pos, left, chars = np.zeros(len(text), np.int64), after.astype(np.int64), np.zeros(len(text), np.int64)
        inner = (after > 0) & (after < self.n_units[text])
        step = 1 << (int(m.max(initial=1)).bit_length() - 1)
        while step:
            ahead = pos + step
            node = np.minimum(first + ahead - 1, len(self.units) - 1)
            down = inner & (ahead <= m)
            down[down] = self.units[node[down]] <= left[down]
            left[down] -= self.units[node[down]]
            chars[down] += self.chars[node[down]]
            pos[down] = ahead[down]
            step >>= 1
        byte = np.where(after > 0, self.end[text] - self.start[text], 0)
        chars = np.where(inner, chars, np.where(after > 0, self.n_chars[text], 0))
        begin = self.start[text] + pos * self.block
        for q in np.flatnonzero(inner).tolist():
            a = int(begin[q])
            here = a + int(np.flatnonzero(self.begins[a : a + self.block])[left[q]])
            byte[q] = here - self.start[text[q]]
            chars[q] += np.count_nonzero(self.points[a:here])
        return byte, chars


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Sentinels that can always be told from the text around them; others raise."""
    for a in sentinels:
        for b in sentinels:
            mixes = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b)))
            if not a or mixes or (a != b and a in b):
                raise ValueError(f"sentinels that overlap: {sentinels}")
    if len(set(sentinels)) < 3:
        raise ValueError(f"sentinels must differ: {sentinels}")
    return sentinels


def draws(key: str = "doc_id", seed: int = SEED) -> Column:
    """Four numbers below 2^32 that follow from seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def rearranged(
    docs: DataFrame, unit: str = "char", seed: int = SEED, percent: int = REARRANGED,
    suffix_first: int = SUFFIX_FIRST, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """The columns of ``docs`` without the text, and n (units), form, prefix_chars, middle_chars and output."""
    before, behind, middle = (s.encode() for s in _checked(sentinels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", AT_ONCE):
            texts = b.column("_text").to_pylist()
            h = np.array(b.column("_draws").flatten()).reshape(-1, 4)
            forest = Forest(texts, unit)
            n = forest.n_units
            ends = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
            held = np.array([not t or before in t or behind in t or middle in t for t in texts], bool)
            plain = held | (h[:, 2] % 100 >= percent)
            spm = h[:, 3] % 100 < suffix_first
            which = np.flatnonzero(~plain)
            (a, a_chars), (z, z_chars) = (forest.cut(which, ends[which, i]) for i in (0, 1))
            out, form = list(texts), ["plain"] * len(texts)
            for i, x, y in zip(which.tolist(), a.tolist(), z.tolist()):
                t = texts[i]
                form[i] = "spm" if spm[i] else "psm"
                head = (behind, t[y:], before, t[:x]) if spm[i] else (before, t[:x], behind, t[y:])
                out[i] = b"".join((*head, middle, t[x:y]))
            chars = np.zeros((2, len(texts)), np.int64)
            chars[0, which], chars[1, which] = a_chars, z_chars - a_chars
            found = [pa.array(n), pa.array(form), pa.array(chars[0], mask=plain), pa.array(chars[1], mask=plain), pa.array(out, pa.binary())]
            kept = [b.column(c) for c in b.schema.names if c not in ("_text", "_draws")]
            yield pa.RecordBatch.from_arrays([*kept, *found], [f.name for f in schema.fields])

    made = "n long, form string, prefix_chars long, middle_chars long, output binary"
    names = [c.split()[0] for c in made.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in ("text", *names)]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], utf8("text").alias("_text"), draws("doc_id", seed).alias("_draws"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for field in made.split(", "):
        schema = schema.add(*field.split())
    return replaced(rows.mapInArrow(run, schema), output=F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of."""
    before, behind, middle = _checked(sentinels)
    out, kind = F.col(output), F.col(form)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(out, F.lit(len(first) + 1), F.length(out))
        rest = F.substring_index(body, second, -1)
        return F.substring_index(body, second, 1), F.substring_index(rest, middle, 1), F.substring_index(rest, middle, -1)

    p, s, m = parts(before, behind)
    s2, p2, m2 = parts(behind, before)
    return F.when(kind == "psm", F.concat(p, m, s)).when(kind == "spm", F.concat(p2, m2, s2)).otherwise(out)
