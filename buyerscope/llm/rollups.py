"""Delta-maintained token counts by source, language and tokenizer version.

Totals are additive, so they are kept as a sum of deltas. A batch holds signed changes:
an insert adds a document's tokens, a delete takes them back, a revised count adds the
difference. A batch is summed by key and written to a folder of its own; it is committed
by publishing one small file under its name that says which folder that is. The file is
written first and put in place in one step that fails where the name is taken, so of
several writers one wins, and a writer that is lost before leaves nothing that counts.
``compact`` folds the batches that it listed, and no others, into one snapshot that
remembers their names; a name is never counted again.

    <folder>/batches/<name>    pointer to data-<id>/: source, lang, version, docs, tokens
    <folder>/snapshots/<n>     pointer to fold-<id>/: totals/, and names/ of the batches in them; the largest n counts

Publishing needs a store whose rename is one step and does not replace a file, as HDFS's
is; on a local disk it is a hard link. A reader of totals that compaction overtakes may
miss a deleted folder and fail; it never sees a wrong sum.

Defined cases: null source, lang or version are keys of their own. Changes with a null
count add none. Keys whose documents and tokens sum to zero vanish from the totals. An
empty batch commits and counts as seen.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

KEYS = ("source", "lang", "version")
_SUMS = ("docs", "tokens")
SCHEMA = "source string, lang string, version string, docs long, tokens long"


def insert(rows: DataFrame) -> DataFrame:
    """Changes for new documents: keys and n_tokens."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("tokens"))


def delete(rows: DataFrame) -> DataFrame:
    """Changes that take documents back: keys and the n_tokens they count with."""
    return insert(rows).select(*KEYS, *[(-F.col(c)).alias(c) for c in _SUMS])


def revise(rows: DataFrame) -> DataFrame:
    """Changes for new counts of known documents: keys, n_tokens as counted and new_tokens."""
    return rows.select(
        *KEYS, F.lit(0).cast("long").alias("docs"),
        (F.coalesce("new_tokens", F.lit(0)) - F.coalesce("n_tokens", F.lit(0))).cast("long").alias("tokens"),
    )


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS])


class Rollup:
    """Totals in a folder of a shared store, for any number of writers."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        for part in ("batches", "snapshots"):
            self._fs.mkdirs(self._path(f"{self.folder}/{part}"))

    def _publish(self, pointer: str, target: str) -> bool:
        """Put a file that names ``target`` in place; False if there is one already."""
        own = self._path(f"{self.folder}/claim-{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        out.write(bytearray(target.encode()))
        out.close()
        place = self._path(f"{self.folder}/{pointer}")
        if self._fs.getUri().getScheme() != "file":
            done = not self._fs.exists(place) and self._fs.rename(own, place)
        else:
            disk = self.spark._jvm.java.io.File
            try:
                self.spark._jvm.java.nio.file.Files.createLink(
                    disk(place.toUri().getPath()).toPath(), disk(own.toUri().getPath()).toPath()
                )
                done = True
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" not in str(e.java_exception):
                    raise
                done = False
        self._fs.delete(own, False)
        return done

    def _pointers(self, part: str) -> dict[str, str]:
        """Name and target of each pointer; one row a batch since the last compaction, or one a snapshot."""
        found = self.spark.read.text(f"{self.folder}/{part}").select(F.element_at(F.split(F.input_file_name(), "/"), -1), "value")
        return {name: f"{self.folder}/{target}" for name, target in found.collect()}

    def _snapshot(self) -> tuple[int, str | None]:
        found = {int(n): target for n, target in self._pointers("snapshots").items()}
        return (max(found), found[max(found)]) if found else (0, None)

    def _folded(self, last: str | None, names: list[str]) -> set[str]:
        """Which of these names the snapshot holds."""
        if not (last and names):
            return set()
        return {r.name for r in self.spark.read.parquet(f"{last}/names").where(F.col("name").isin(names)).collect()}

    def is_committed(self, name: str) -> bool:
        """Whether a batch counts."""
        listed = self._fs.exists(self._path(f"{self.folder}/batches/{name}"))
        return listed or bool(self._folded(self._snapshot()[1], [name]))

    def commit(self, name: str, changes: DataFrame) -> bool:
        """Add a batch once; False if its name is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9][\w-]*", name):
            raise ValueError(f"not a batch name: {name}")
        if self.is_committed(name):
            return False
        own = f"data-{uuid.uuid4().hex}"
        _summed(changes).write.parquet(f"{self.folder}/{own}")
        if not self._publish(f"batches/{name}", own):
            self._fs.delete(self._path(f"{self.folder}/{own}"), True)
            return False
        # another writer's batch may have been folded, and its pointer freed, since the first look
        return not self._folded(self._snapshot()[1], [name])

    def _state(self) -> tuple[int, str | None, dict[str, str], set[str]]:
        """Snapshot, pointers and which of those are folded; the pointers are read first, as folded ones vanish."""
        pending = self._pointers("batches")
        number, last = self._snapshot()
        return number, last, pending, self._folded(last, list(pending))

    def _sum_of(self, last: str | None, folders: list[str]) -> DataFrame:
        read = self.spark.read.schema(SCHEMA)
        parts = [read.parquet(*p) for p in ([f"{last}/totals"] if last else [], folders) if p]
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        rows = parts[0].union(parts[1]) if len(parts) > 1 else parts[0]
        return _summed(rows).where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """Sums over all committed batches."""
        _, last, pending, folded = self._state()
        return self._sum_of(last, [target for n, target in pending.items() if n not in folded])

    def compact(self) -> bool:
        """Fold the batches that are committed now into a new snapshot; False if another writer was first."""
        number, last, pending, folded = self._state()
        new = {n: target for n, target in pending.items() if n not in folded}
        own = f"fold-{uuid.uuid4().hex}"
        self._sum_of(last, list(new.values())).write.parquet(f"{self.folder}/{own}/totals")
        names = self.spark.createDataFrame([(n,) for n in new], "name string")
        if last:
            names = names.union(self.spark.read.parquet(f"{last}/names"))
        names.write.parquet(f"{self.folder}/{own}/names")
        if not self._publish(f"snapshots/{number + 1}", own):
            self._fs.delete(self._path(f"{self.folder}/{own}"), True)
            return False
        for n, target in pending.items():
            self._fs.delete(self._path(f"{self.folder}/batches/{n}"), False)
            self._fs.delete(self._path(target), True)
        return True
