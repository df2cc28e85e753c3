"""Tokens of whole texts under several tokenizers, the counts that rollups keep.

A version is the name of a tokenizer file: ``.json`` for the tokenizers library, whose
special tokens count as such, ``.tiktoken`` for ranks of a byte-level vocabulary, where
every text is ordinary. Files stay where they are; their path is a parameter and every
machine has them.

Defined cases: a null or empty text has no tokens. Very long texts are encoded whole, one
at a time. Equal rows give equal rows. An empty table gives none.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from buyerscope.llm.common import slices, utf8
from buyerscope.llm.token_files import encoder

_counters: dict[str, Callable[[list[bytes]], list[int]]] = {}


def _ranked(path: str, pattern: str) -> Callable[[list[bytes]], list[int]]:
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encode = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda texts: [len(encode(t.decode())) for t in texts]


def _filed(path: str) -> Callable[[list[bytes]], list[int]]:
    own = encoder(path)
    width = int(own.kind[-1])
    return lambda texts: [len(ids) // width for ids in own.encode(texts)]


def counter(path: str, pattern: str) -> Callable[[list[bytes]], list[int]]:
    """Texts to numbers of tokens; a worker process keeps it for its next task."""
    if path not in _counters:
        _counters[path] = _ranked(path, pattern) if path.endswith(".tiktoken") else _filed(path)
    return _counters[path]


def counted(docs: DataFrame, keep: list[str], tokenizers: dict[str, str], pattern: str) -> DataFrame:
    """The columns ``keep`` and one long column per version; texts don't leave the task that reads them.

    ``tokenizers`` has a path per version, ``pattern`` the expression that cuts texts for ranks.
    """
    rows = docs.select(*keep, utf8("text").alias("_text"))
    schema = rows.select(*keep, *[F.lit(0).cast("long").alias(v) for v in tokenizers]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 1 << 21):
            texts = b.column("_text").to_pylist()
            found = [pa.array(counter(path, pattern)(texts), pa.int64()) for path in tokenizers.values()]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), *found], [*keep, *tokenizers])

    return rows.mapInArrow(run, schema)
