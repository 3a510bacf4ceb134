"""Keyed Parquet tables with versions: an upsert rewrites only the buckets it touches.

Layout: ``<path>/data/<write>/bucket=<b>/*.parquet`` and a pointer
``<path>/_pointer/<version>.json`` that maps each bucket to the write it lives
in. Data files are never changed. A pointer is written aside, whole, and then
given its number in one atomic step, which fails if another writer took that
number: a writer that dies leaves nothing under it. A number whose file cannot
be read (left by something else) is passed over by readers and writers. Rows
without a key cannot be merged: they go to ``<path>/keyless``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.operators.merge import any_null, merge
from tidemark.specs import TableSpec
from tidemark.workspace import compiled

BUCKET = "bucket"
ACTION = "__action"
RETRIES = 5
#: Rows of both sides that one task merges or writes. It sorts them by key and then by bucket, some 700 bytes for each of a
#: wide row; without a bound a task would hold its share of the table by ``spark.sql.shuffle.partitions``.
TASK_ROWS = 1 << 17


class VersionTaken(RuntimeError):
    """Another writer committed the version first."""


@dataclass
class Pointer:
    version: int = 0
    buckets: dict[int, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    bucket_count: int | None = None
    keys: list[str] | None = None
    columns: list[str] | None = None
    #: Rows this version inserted and updated; None where it did not come of a merge.
    actions: dict[str, int] | None = None
    #: The highest number taken, readable or not.
    taken: int = 0


class VersionedTable:
    """One table, any number of readers. A writer that loses a race applies its batch to the new version.

    ``buckets`` is fixed when the table is created: aim at about 1 GB per bucket.
    Buckets are the remainders of the hash Spark itself shuffles the merge key by.
    The tasks of a write follow its rows, in a number that divides that of the
    buckets or is a multiple of it, so no bucket is cut between tasks it shares
    with others, and none needs another shuffle.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int = 64):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        compiled(spark)
        known = self.pointer()
        self.bucket_count = known.bucket_count or buckets
        if known.keys is not None and (known.keys, known.columns) != (list(spec.keys), list(spec.columns)):
            raise ValueError(f"{self.path} holds other columns or keys than {spec.name}: {known.keys}, not {list(spec.keys)}")

    # -- pointer ---------------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/_pointer") if n.endswith(".json")]

    def pointer(self, version: int | None = None) -> Pointer:
        numbers = self._numbers()
        if version is not None:
            found = self._load(version) if version in numbers else None
            if found is None:
                raise ValueError(f"{self.path} has no version {version}")
            return found
        found = next(filter(None, map(self._load, reversed(numbers))), Pointer())
        found.taken = numbers[-1] if numbers else 0
        return found

    def _load(self, number: int) -> Pointer | None:
        """The pointer of a number; None if its file is no pointer."""
        try:
            doc = json.loads(self._text(f"{self.path}/_pointer/{number:020d}.json"))
            return Pointer(
                doc["version"], {int(b): w for b, w in doc["buckets"].items()}, doc["applied"], doc["bucket_count"],
                doc.get("keys"), doc.get("columns"), doc.get("actions"),
            )
        except (ValueError, KeyError, TypeError, AttributeError):
            return None

    def _text(self, file: str) -> str:
        """A small file through the file system: no job."""
        fs, path = self._fs(file)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, pointer: Pointer) -> None:
        doc = {
            "version": pointer.version,
            "bucket_count": self.bucket_count,
            "buckets": {str(b): w for b, w in sorted(pointer.buckets.items())},
            "applied": pointer.applied,
            "keys": list(self.spec.keys),
            "columns": list(self.spec.columns),
            "actions": pointer.actions,
        }
        fs, aside = self._fs(f"{self.path}/_pointer/aside/{uuid.uuid4().hex}")
        _, final = self._fs(f"{self.path}/_pointer/{pointer.version:020d}.json")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(doc).encode()))
        out.close()
        try:
            self._publish(fs, aside, final)
        except Py4JJavaError as taken:
            if fs.exists(final):
                raise VersionTaken(f"version {pointer.version} of {self.path} was written by someone else") from taken
            raise
        finally:
            fs.delete(aside, False)

    def _publish(self, fs, aside, final) -> None:
        """Give a whole file its final name in one step, or fail if the name is taken.

        A rename that does not overwrite is such a step on HDFS. A local rename would replace the file, a link does not.
        """
        jvm = self.spark._jvm
        if fs.getUri().getScheme() == "file":
            paths = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (final, aside)]
            jvm.java.nio.file.Files.createLink(*paths)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(aside, final, none)

    # -- reading ---------------------------------------------------------------

    @property
    def version(self) -> int:
        return self.pointer().version

    def was_applied(self, writer: str, batch_id: int) -> bool:
        return self.pointer().applied.get(writer, -1) >= batch_id

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or those of an earlier version."""
        return self._read(self.pointer(version).buckets)

    def _read(self, buckets: dict[int, str]) -> DataFrame:
        paths = [f"{self.path}/data/{w}/{BUCKET}={b}" for b, w in sorted(buckets.items())]
        if not paths:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).parquet(*paths)

    # -- writing ---------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.spec.keys), F.lit(self.bucket_count)).alias(BUCKET)

    def _write(
        self, rows: DataFrame, old: Pointer, applied: tuple[str, int] | None, actions: Observation | dict | None = None
    ) -> int:
        version = max(old.version, old.taken) + 1
        write = f"{version:020d}-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{write}"
        rows.select(*self.spec.columns, self._bucket()).write.partitionBy(BUCKET).parquet(folder)
        written = {
            int(n.split("=")[1]): write for n in self._names(folder) if n.startswith(f"{BUCKET}=")
        }
        marks = {**old.applied, **({applied[0]: applied[1]} if applied else {})}
        counts = actions.get if isinstance(actions, Observation) else actions
        self._commit(Pointer(version, {**old.buckets, **written}, marks, actions=counts))
        return version

    def overwrite(self, rows: DataFrame, *, applied: tuple[str, int] | None = None) -> int:
        """Replace the whole table by rows with unique keys."""
        old = self.pointer()
        base = Pointer(old.version, {}, old.applied, taken=old.taken)
        typed = self._typed(rows)
        return self._write(self._by_key(typed, self._tasks(typed.count())), base, applied)

    def _typed(self, rows: DataFrame, *keep: str) -> DataFrame:
        given = rows.columns
        columns = [
            f"CAST({f'`{c}`' if c in given else 'NULL'} AS {self.spec.type_of(c)}) AS `{c}`" for c in self.spec.columns
        ]
        return rows.selectExpr(*columns, *[f"`{k}`" for k in dict.fromkeys(keep) if k not in self.spec.columns])

    def _by_key(self, rows: DataFrame, tasks: int | None) -> DataFrame:
        return rows.repartition(tasks, *self.spec.keys) if tasks else rows.repartition(*self.spec.keys)

    def _tasks(self, rows: int) -> int | None:
        """How many tasks take so many rows; None where one could take all, as the planner packs them."""
        least, buckets = -(-rows // TASK_ROWS), self.bucket_count
        if least < 2:
            return None
        if least >= buckets:
            return -(-least // buckets) * buckets
        return next(n for n in range(least, buckets + 1) if buckets % n == 0)

    def upsert(
        self,
        source: DataFrame,
        *,
        seq: Sequence[str] | None = None,
        event_col: str | None = None,
        present: str | None = None,
        applied: tuple[str, int] | None = None,
        whole: bool = False,
        fixed: bool = False,
    ) -> int:
        """Merge a batch and return the version. ``applied=(writer, batch)`` makes a replay a no-op.

        Only the numbers of the touched buckets (at most ``buckets``) reach the
        driver. ``whole`` is for a batch known to touch most of the table: all
        buckets are rewritten. Rows without a key are set apart in ``<path>/keyless``.
        ``fixed`` is for a batch that reads the same however often it is read (a stage of a run): it is not kept beside it,
        as packing wide rows costs more than reading their keys twice.
        A batch that loses its version to another writer is merged into that one.
        """
        keep = [c for c in (*(seq or ()), present) if c]
        batch = self._typed(source, *keep)
        batch = batch if fixed else batch.persist(StorageLevel.MEMORY_AND_DISK)
        options = dict(
            update=self.spec.update_columns, seq=seq, event_col=event_col, present=present,
            null_safe=self.spec.null_safe, null_keys=False,
        )
        # One name for all attempts: a batch that loses a race sets its keyless rows apart once.
        name = f"{applied[0]}-{applied[1]}".replace("/", "_") if applied else uuid.uuid4().hex
        try:
            for attempt in range(RETRIES):
                old = self.pointer()
                if applied and old.applied.get(applied[0], -1) >= applied[1]:
                    return old.version
                try:
                    return self._upsert(batch, old, applied, options, whole, name)
                except VersionTaken:
                    if attempt + 1 == RETRIES:
                        raise
        finally:
            if not fixed:
                batch.unpersist()

    def _upsert(
        self, batch: DataFrame, old: Pointer, applied: tuple[str, int] | None, options: dict, whole: bool, name: str
    ) -> int:
        keyed = batch
        keyless = F.lit(False) if self.spec.null_safe else any_null(self.spec.keys)
        found = batch.select(self._bucket(), keyless.alias("keyless")).groupBy(BUCKET, "keyless").count().collect()
        if any(r.keyless for r in found):
            batch.filter(keyless).write.mode("overwrite").parquet(f"{self.path}/keyless/{name}")
            keyed = batch.filter(~keyless)
        touched = {r[BUCKET] for r in found if not r.keyless}
        if not touched:
            return self._write(keyed.select(*self.spec.columns), old, applied, {"inserted": 0, "updated": 0})
        buckets = old.buckets if whole else {b: w for b, w in old.buckets.items() if b in touched}
        return self._merge_into(buckets, keyed, sum(r["count"] for r in found if not r.keyless), old, applied, options)

    def keyless(self) -> DataFrame:
        """Rows set apart because a key column was NULL."""
        names = self._names(f"{self.path}/keyless")
        if not names:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.parquet(*[f"{self.path}/keyless/{n}" for n in names]).select(*self.spec.columns)

    def _merge_into(
        self,
        buckets: dict[int, str],
        batch: DataFrame,
        size: int,
        old: Pointer,
        applied: tuple[str, int] | None,
        options: dict,
    ) -> int:
        target = self._read(buckets)
        tasks = self._tasks(size + (target.count() if buckets else 0))  # of the target, file footers are read
        rows = merge(target, batch, self.spec.keys, action=ACTION, tasks=tasks, **options)
        # A null-safe join shuffles by other expressions than the bare keys.
        rows = self._by_key(rows, tasks) if self.spec.null_safe else rows
        # Counted on the way to the files: the target is not read a second time.
        actions = Observation()
        rows = rows.observe(
            actions, F.count_if(F.col(ACTION) == "insert").alias("inserted"), F.count_if(F.col(ACTION) == "update").alias("updated")
        )
        return self._write(rows, old, applied, actions)

    def vacuum(self, keep_versions: int = 2) -> list[str]:
        """Delete pointers before the last ``keep_versions`` readable ones, and the writes none of the rest uses."""
        numbers = self._numbers()
        kept = {n: p for n in numbers if (p := self._load(n))}
        kept = dict(sorted(kept.items())[-keep_versions:])
        if not kept:
            return []
        gone = [n for n in numbers if n < min(kept)]
        used = {w for p in kept.values() for w in p.buckets.values()}
        newest = f"{max(kept):020d}"
        unused = [w for w in self._names(f"{self.path}/data") if w not in used and w[:20] <= newest]
        for name in [*(f"_pointer/{n:020d}.json" for n in gone), *(f"data/{w}" for w in unused)]:
            fs, path = self._fs(f"{self.path}/{name}")
            fs.delete(path, True)
        return unused

    def actions(self) -> DataFrame:
        """``version, inserted, updated`` of the versions that are kept; counted as they were written (NULL: not by a merge)."""
        rows = [(p.version, *((p.actions or {}).get(k) for k in ("inserted", "updated"))) for p in map(self._load, self._numbers()) if p]
        return self.spark.createDataFrame(rows, "version bigint, inserted bigint, updated bigint")
