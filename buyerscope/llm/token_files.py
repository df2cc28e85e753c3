"""Token-ID files: flat unsigned integers with 64-bit document offsets.

Documents are dealt to ranges of doc_id and sorted; each range becomes one part:

    <part>.bin   the ids of its documents one after another, little-endian and unsigned: 16 bits
                 where all ids of the tokenizer fit, 32 otherwise
    <part>.idx   little-endian int64, where each document begins, then the end
    <part>.ids   little-endian int64 doc_ids; null ones come last, their number is in the table of parts

The table of parts (part, base, n_docs, n_null, n_tokens, width, file) is the index of the data
set; base, the ids in all parts before, is a prefix sum over the parts. Only this table,
a row a part, reaches the driver. A lost task writes a new file; the table names the
files of the attempts that counted.

White space never lies within a token and a tokenizer without post-processing treats the
pieces between it alike wherever they stand, so each distinct piece is encoded once and
remembered. ``Encoder`` checks that the tokenizer is of this kind and encodes whole texts
otherwise.

Defined cases: a null text is empty and has the end id only; null doc_ids come last;
rows with equal doc_ids stand side by side by text; an empty table gives no rows.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import accumulate, pairwise
from operator import add

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.llm.shared_files import attempt_name, mapped, new_folder, one_task_each, opened

END_ID = 1
#: Pieces of a generation that a worker remembers; when it is full, the one before is forgotten.
REMEMBERED = 400_000
#: Marks that often follow a word; several in a row are one part.
_MARKS = b".,;:!?"


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; a worker process keeps it, and what it remembers, for its next task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Texts to ids, as the bytes of unsigned integers of ``kind``.

    For tokenizers of the kind that ``_splits_at_space`` knows, new pieces go through the steps of
    the file one by one: lower case and composed form, the file's expression, bytes as
    letters, merges. That spares the library's bookkeeping of offsets, most of its time.
    Pieces with a character newer than Unicode 3.2, where tables may differ, or with a
    special token take the library's whole way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.by_piece = self._splits_at_space(plan)
        #: Pieces of this generation and of the one before.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        most = max(self.tokenizer.get_vocab().values())
        self.kind = "<u2" if most < 1 << 16 else "<u4"
        self.settled: set[str] = set()
        if self.by_piece:
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = WhitespaceSplit()
            self.part_end = np.zeros(most + 1, bool)
            suffix = plan["model"]["end_of_word_suffix"]
            self.part_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
            self.parts = regex.compile(plan["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall

    @staticmethod
    def _splits_at_space(plan: dict) -> bool:
        """Whether white space is dropped, letters stay together, bytes stand for characters, and nothing depends on what stands around."""
        before = (plan["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        first, last = before[0], before[-1]
        known = {"NFC", "Replace", "Lowercase"}
        kinds = {n["type"] for n in (plan["normalizer"] or {}).get("normalizers", [])}
        model = plan["model"]
        return bool(
            len(before) == 2 and last.get("type") == "ByteLevel" and not (last.get("add_prefix_space") or last.get("use_regex"))
            and first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
            and r"[^\s\p{L}\p{N}]+" in first["pattern"].get("Regex", "") and plan["post_processor"] is None
            and model["type"] == "BPE" and not (model.get("dropout") or model.get("unk_token") or model.get("byte_fallback"))
            and model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
            and kinds == known
            and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in plan["added_tokens"])
        )

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _encode_parts(self, new: list[bytes]) -> None:
        """Ids of what the expression finds: many side by side, cut where a token ends a part."""
        for at in range(0, len(new), 4000):
            some = new[at : at + 4000]
            letters = b" ".join(some).decode("latin-1")
            if not (letters.isascii() and letters.isprintable()):  # those stand for themselves
                letters = letters.translate(_BYTES_AS_LETTERS)
            ids = np.array(self.bare.encode_batch_fast([letters], add_special_tokens=False)[0].ids, self.kind)
            edge = [0, *((np.flatnonzero(self.part_end[ids]) + 1) * ids.itemsize).tolist()]
            raw = ids.tobytes()
            self.known.update(zip(some, [raw[a:b] for a, b in pairwise(edge)], strict=True))

    def _lowered(self, pieces: list[str]) -> list[str] | None:
        """Composed and in lower case, as the file says; nothing if a piece does not stay one."""
        out = self.tokenizer.normalizer.normalize_str(" ".join(pieces)).split(" ")
        return out if len(out) == len(pieces) else None

    def _settled(self, piece: str) -> bool:
        new = set(piece) - self.settled
        fine = {c for c in new if unicodedata.ucd_3_2_0.category(c) != "Cn" and not c.isspace()}
        self.settled |= fine
        return len(fine) == len(new)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces not met before. Most are letters and perhaps marks, of which no list is made."""
        known, parts, marks = self.known, self.parts, _MARKS.decode()
        known[b""] = b""
        new, wide, whole = set(), [], []
        word, head, tail, odd, odd_parts = [], [], [], [], []

        for piece in pieces:
            if piece.isalpha():  # ASCII letters
                new.add(piece)
            elif b"<|" in piece:
                whole.append(piece)
            elif (core := piece.rstrip(_MARKS)).isalpha():
                word.append(piece)
                head.append(core)
                tail.append(piece[len(core) :])
            elif piece.isascii():
                odd.append(piece)
                odd_parts.append([p.encode() for p in parts(piece.decode())])
            else:
                wide.append(piece)
        for at in range(0, len(wide), 2000):
            text = [p.decode() for p in wide[at : at + 2000]]
            fine = [True] * len(text) if self._settled("".join(text)) else list(map(self._settled, text))
            whole += [p for p, ok in zip(wide[at : at + 2000], fine) if not ok]
            some = [p for p, ok in zip(wide[at : at + 2000], fine) if ok]
            lowered = self._lowered([t for t, ok in zip(text, fine) if ok]) if some else []
            if lowered is None:
                whole += some
            else:
                for piece, low in zip(some, lowered):
                    core = low.rstrip(marks)
                    if core.isalpha():
                        word.append(piece)
                        head.append(core.encode())
                        tail.append(low[len(core) :].encode())
                    else:
                        odd.append(piece)
                        odd_parts.append([p.encode() for p in parts(low)])
        new.update(head, tail, *odd_parts)
        self._encode_parts(sorted(new.difference(known), key=bytes.isascii))
        ids = known.__getitem__
        known.update(zip(word, list(map(add, map(ids, head), map(ids, tail)))))
        known.update(zip(odd, [b"".join(map(ids, found)) for found in odd_parts]))
        known.update(zip(whole, self._plain([p.decode() for p in whole])))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        if not self.by_piece:
            return self._plain([t.decode() for t in texts])
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        # A-Z may be lowered before, as the tokenizer does it, but where a special token could come of it
        pieces = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if new := set().union(*pieces).difference(self.known):
            met = [p for p in new if p in self.before]
            self.known.update(zip(met, map(self.before.__getitem__, met)))
            self._learn(list(new.difference(met)))
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]


#: The usual stand-ins of bytes in byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 and
#: up. The space is left alone: no part holds one, and it parts them.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES_AS_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN) if b != 32}


def write(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write all texts as token files; returns the table of parts.

    ``tokenizer`` is the path of a tokenizer file on every machine.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([end_id], own.kind).tobytes()
        part = TaskContext.get().partitionId()
        uri = f"{folder}/{attempt_name(part)}"
        where, path = opened(uri)
        size, ids = [], []
        with where.open_output_stream(path + ".bin") as file:
            for b in slices(batches, "text", 1 << 21):
                encoded = [x + end for x in own.encode(b.column("text").to_pylist())]
                file.write(b"".join(encoded))
                size += [len(x) // len(end) for x in encoded]
                ids += b.column("doc_id").to_pylist()
        with where.open_output_stream(path + ".idx") as file:
            file.write(np.r_[0, np.cumsum(np.array(size, np.int64))].astype("<i8").tobytes())
        with where.open_output_stream(path + ".ids") as file:
            file.write(np.array([i or 0 for i in ids], "<i8").tobytes())
        row = [part, len(ids), sum(i is None for i in ids), sum(size), len(end), uri]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "n_docs", "n_null", "n_tokens", "width", "file"), row))])

    rows = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.rand(7)]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order[:2])
    schema = "part long, n_docs long, n_null long, n_tokens long, width long, file string"
    parts = sorted(tuple(r) for r in dealt.mapInArrow(run, schema).collect())
    base = [0, *accumulate(p[3] for p in parts)]
    rows = [(p[0], b, *p[1:]) for p, b in zip(parts, base)]
    return one_task_each(spark, rows, "part long, base long, n_docs long, n_null long, n_tokens long, width long, file string")


def read(parts: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.to_pylist():
                flat, offset, ids = (mapped(f"{p['file']}.{x}", k) for x, k in (("bin", f"<u{p['width']}"), ("idx", "<i8"), ("ids", "<i8")))
                missing = np.arange(len(ids)) >= len(ids) - p["n_null"]
                for at in range(0, len(ids), 1000):
                    some = slice(at, at + 1000)
                    edge = offset[at : at + 1001]
                    raw = [flat[x:y].astype("<u4").tobytes() for x, y in zip(edge[:-1], edge[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[some], mask=missing[some]), pa.array(p["base"] + edge[:-1]), pa.array(np.diff(edge)), pa.array(raw, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
