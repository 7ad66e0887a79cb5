"""Versioned Parquet tables with one append-only commit log for the store (S-02, S-05..S-09, §4.3).

Plain Parquet cannot be overwritten by a plan that reads it, and no table
format is assumed to be installed.  Every write goes to a folder of its own
and becomes visible only when a small commit file is created afterwards::

    {root}/{table}/data/v={version}-{attempt}/[year=YYYY/]part-*.parquet
    {root}/_log/{seq:012d}.json   {"tables": {table: {"version", "parts", ...}}, "published": {table: [versions]},
                                 "marks": {dataset: epoch}, "entries": {dataset: [[name, length, epoch]]}}
    {root}/_done/{table}/{version}, {root}/_ledger/{dataset}/{entry}     empty marker files

* A commit file holds the state of all tables, so one file publishes all
  targets of a run together; readers take the newest complete one.
* ``published`` and ``entries`` name only what that commit added, so a commit
  file does not grow with the number of runs.  Before the next commit they
  become marker files; the newest commit and the markers together are the whole
  history, whenever a writer dies.
* The ledger (S-03, S-04) is the set of landing entries that were run, by name,
  length and epoch: an entry that lands late, with an epoch older than others
  that were run, is still new.
* A write never touches a folder that a commit points to: each attempt gets a
  fresh folder, and a version that was published once is refused for ever.
* Year routing (S-07): only the years present in a write get a new folder;
  the commit carries the other years' folders over from the previous commit,
  so untouched years are not rewritten (dynamic partition replacement).
* Two writers: the file system must create a file only if it is absent
  (``create(path, overwrite=false)``).  HDFS and local disks do; on an object
  store this needs conditional puts, else run one writer at a time.  The loser
  of a race commits on top of the winner, or fails if both changed one table.
  Threads of one driver (datasets run side by side) take turns at the commit log and at appends to one log table.

All file-system calls go through Hadoop's ``FileSystem`` on the driver, so the
same code works on HDFS, object stores and local disk.  Only metadata passes
through the driver; data is written by Spark tasks.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import with_known_rows

ALL = "*"
PUBLISH_ATTEMPTS = 20
# Spark's folder name for a null partition value
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# One lock per folder that threads of this driver write to in turns
_TURNS: dict[str, threading.RLock] = defaultdict(threading.RLock)


class Cancelled(RuntimeError):
    """The run was cancelled; nothing of it is published."""


class PublishConflict(RuntimeError):
    """Another writer changed the table since this version was written."""


class AlreadyPublished(ValueError):
    """The version was published before; its data is left as it is."""


@dataclass
class Commit:
    seq: int
    version: str
    parts: dict[str, str]       # partition value (or "*") -> folder
    partition_col: str | None
    schema_json: str
    key: list[str]
    rows: int | None = None     # rows in the table once published, when known
    part_rows: dict[str, int] | None = None   # rows per partition value (year-routed tables)
    folder: str = ""            # where this commit's own rows were written
    extra: dict | None = None   # what a layout or an operator keeps with the version (small)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))


class TableStore:
    """A folder of versioned tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cancelled: Callable[[], bool] = lambda: False  # asked before a commit becomes visible
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------ file-system helpers
    def _fs(self, path: str):
        p = self._Path(path)
        return p.getFileSystem(self._conf), p

    def _list(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p)]

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _write_text(self, path: str, text: str) -> None:
        fs, p = self._fs(path)
        out = fs.create(p, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    # ------------------------------------------------------------ commits
    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _log_names(self) -> list[str]:
        return sorted(n for n in self._list(f"{self.root}/_log") if n.endswith(".json"))

    def _log_entry(self, name: str) -> dict | None:
        """A commit file's content; ``None`` for one its writer did not finish."""
        try:
            return json.loads(self._read_text(f"{self.root}/_log/{name}"))
        except json.JSONDecodeError:
            return None

    def _snapshot(self) -> tuple[int, dict]:
        """Next free sequence number and the newest complete state of all tables."""
        with _TURNS[self.root]:
            names = self._log_names()
            for n in reversed(names):
                state = self._log_entry(n)
                if state is not None:
                    return int(names[-1][:-5]) + 1, state
        return (int(names[-1][:-5]) + 1 if names else 0), {"tables": {}, "published": {}, "marks": {}}

    def latest_commit(self, table: str) -> Commit | None:
        meta = self._snapshot()[1]["tables"].get(table)
        return None if meta is None else Commit(
            seq=meta["seq"], version=meta["version"], parts=meta["parts"], partition_col=meta.get("partition_col"),
            schema_json=meta["schema"], key=meta.get("key", []), rows=meta.get("rows"),
            part_rows=meta.get("part_rows"), folder=meta.get("folder", ""), extra=meta.get("extra"))

    def versions(self, table: str) -> list[str]:
        """Folders written for the table, published or not (``{version}-{attempt}``)."""
        return [n.split("=", 1)[1] for n in self._list(f"{self.table_path(table)}/data") if n.startswith("v=")]

    def has_version(self, table: str, version: str) -> bool:
        """Whether the version was ever published, whatever came after it."""
        return (version in self._snapshot()[1]["published"].get(table, [])
                or self._exists(f"{self.root}/_done/{table}/{_marker(version)}"))

    # ------------------------------------------------------------ ledger of landing entries
    def ledger(self, dataset: str) -> set[tuple[str, int, int]]:
        """(name, length, epoch) of the dataset's landing entries that were run, one per run."""
        done = {tuple(json.loads(unquote(n))) for n in self._list(f"{self.root}/_ledger/{dataset}")}
        return done | {tuple(e) for e in self._snapshot()[1].get("entries", {}).get(dataset, [])}

    def _mark(self, path: str) -> None:
        if not self._exists(path):
            try:
                self._write_text(path, "")
            except Py4JJavaError as e:  # another writer was first
                if not self._exists(path):
                    raise e

    def _keep_history(self, state: dict) -> None:
        """Marker files for what the newest commit added; before it is succeeded."""
        for table, versions in state.get("published", {}).items():
            for v in versions:
                self._mark(f"{self.root}/_done/{table}/{_marker(v)}")
        for dataset, entries in state.get("entries", {}).items():
            for e in entries:
                self._mark(f"{self.root}/_ledger/{dataset}/{_marker(json.dumps(e))}")

    # ------------------------------------------------------------ read
    def read(self, table: str, schema: T.StructType | None = None,
             partitions: list[str] | None = None) -> DataFrame | None:
        """S-02: the latest committed rows; ``None`` when the table does not exist
        and no schema is given, else an empty frame with ``schema``.

        ``partitions`` limits the read to those partition values (e.g. years):
        only their folders are opened.
        """
        c = self.latest_commit(table)
        if c is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        out = self.read_commit(c, partitions)
        rows = c.rows
        if partitions is not None and c.partition_col:
            wanted = [str(p) for p in partitions if str(p) in c.parts]
            known = c.part_rows or {}
            rows = sum(known[p] for p in wanted) if all(p in known for p in wanted) else None
        return with_known_rows(out, rows)

    def read_commit(self, c: Commit, partitions: list[str] | None = None) -> DataFrame:
        """Rows of one commit — also of a written but not yet published one, which
        lets a run build later targets on files instead of re-running a plan."""
        parts = c.parts
        if partitions is not None and c.partition_col:
            wanted = {str(p) for p in partitions}
            parts = {k: v for k, v in parts.items() if k in wanted}
        hidden = (c.extra or {}).get("hidden", [])
        if not parts:
            return self.spark.createDataFrame([], c.schema).drop(*hidden)
        if c.partition_col in hidden:  # the routing column is no data: one scan of all folders
            return self.spark.read.schema(_data_schema(c)).parquet(*(parts[k] for k in sorted(parts))).drop(*hidden)
        frames = []
        for value, path in sorted(parts.items()):
            df = self.spark.read.schema(_data_schema(c)).parquet(path)
            if c.partition_col:
                ptype = c.schema[c.partition_col].dataType
                df = df.withColumn(c.partition_col, F.lit(None if value == NULL_PART else value).cast(ptype))
            frames.append(df.select(*[F.col(f"`{f.name}`") for f in c.schema.fields]))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    # ------------------------------------------------------------ write
    def write(self, table: str, df: DataFrame, version: str, partition_col: str | None = None,
              key: list[str] | None = None, sort_within: list[str] | None = None,
              replace_parts: list[str] | None = None, save: Callable[[DataFrame, str], None] | None = None) -> Commit:
        """Write a new version (not yet visible) into a fresh folder; returns the commit to publish.

        ``save(df, folder)`` writes the rows where a layout needs more than Parquet folders by partition value.

        With ``partition_col`` only the values present in ``df`` get a folder;
        the rest are carried over from the previous commit — except the values
        in ``replace_parts``, which this write is responsible for: when ``df``
        has no row for one of them (e.g. retention emptied it) it is dropped.
        """
        if self.has_version(table, version):
            raise AlreadyPublished(f"{table}: version {version!r} was published before")
        vdir = f"{self.table_path(table)}/data/v={version}-{uuid.uuid4().hex[:12]}"
        writer_df = df.sortWithinPartitions(*sort_within) if sort_within else df
        prev = self.latest_commit(table)
        if partition_col:
            with _shuffles_freed(self.spark):
                if save is not None:
                    save(writer_df, vdir)
                else:
                    writer_df.write.mode("error").partitionBy(partition_col).parquet(vdir)
            parts = dict(prev.parts) if prev is not None and prev.partition_col == partition_col else {}
            written = set()
            for name in self._list(vdir):
                if name.startswith(partition_col + "="):
                    parts[name.split("=", 1)[1]] = f"{vdir}/{name}"
                    written.add(name.split("=", 1)[1])
            for value in replace_parts or []:
                if str(value) not in written:
                    parts.pop(str(value), None)
        else:
            with _shuffles_freed(self.spark):
                writer_df.write.mode("error").parquet(vdir)
            parts = {ALL: vdir}
        seq = (prev.seq + 1) if prev is not None else 0
        return Commit(seq=seq, version=version, parts=parts, partition_col=partition_col,
                      schema_json=df.schema.json(), key=list(key or []), folder=vdir)

    def rewritten_parts(self, commit: Commit) -> list[str]:
        """Partition values whose folder belongs to this commit's own version."""
        return [k for k, v in commit.parts.items() if (v + "/").startswith(commit.folder + "/")]

    def discard(self, commit: Commit) -> None:
        """Delete the folder of a version that was written and will not be published."""
        fs, p = self._fs(commit.folder)
        fs.delete(p, True)

    def bytes_of(self, folder: str) -> int:
        """Bytes of the files below a folder (0 if it is not there)."""
        fs, p = self._fs(folder)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def count_parts(self, commit: Commit, parts: list[str]) -> dict[str, int]:
        """Rows per partition value of ``parts`` (one small job; only the
        partition column is read back, the result has one row per value)."""
        if not parts or not commit.partition_col:
            return {}
        df = self.read_commit(commit, parts).select(commit.partition_col)
        return {str(r[0]): int(r[1]) for r in df.groupBy(commit.partition_col).count().collect()}

    def publish(self, table: str, commit: Commit) -> None:
        """Make one written version visible."""
        self.publish_all({table: commit})

    def mark(self, dataset: str) -> int | None:
        """Greatest epoch of the landing entries that were run for the dataset."""
        return self._snapshot()[1].get("marks", {}).get(dataset)

    def publish_all(self, commits: dict[str, Commit], entries: dict[str, tuple[str, int, int]] | None = None) -> None:
        """Make the written versions of several tables visible together: one commit file for all.

        ``entries`` records, in the same file, the landing entry (name, length, epoch) that was run for a dataset.
        """
        with _TURNS[self.root]:
            if self.cancelled():
                raise Cancelled("cancelled")
            self._publish(commits, entries)

    def _publish(self, commits: dict[str, Commit], entries: dict[str, tuple[str, int, int]] | None) -> None:
        for _ in range(PUBLISH_ATTEMPTS):
            seq, state = self._snapshot()
            tables = dict(state["tables"])
            published: dict[str, list[str]] = {}
            epochs = dict(state.get("marks", {}))
            for dataset, (_, _, epoch) in (entries or {}).items():
                epochs[dataset] = max(epoch, epochs.get(dataset, epoch))
            for table, c in commits.items():
                if self.has_version(table, c.version):
                    raise AlreadyPublished(f"{table}: version {c.version!r} was published before")
                if tables.get(table, {"seq": -1})["seq"] != c.seq - 1:
                    raise PublishConflict(f"{table}: changed by another writer since version {c.version!r} was written")
                tables[table] = {"seq": c.seq, "version": c.version, "parts": c.parts, "partition_col": c.partition_col,
                                 "schema": c.schema_json, "key": c.key, "rows": c.rows, "part_rows": c.part_rows,
                                 "folder": c.folder, "extra": c.extra}
                published.setdefault(table, []).append(c.version)
            self._keep_history(state)
            path = f"{self.root}/_log/{seq:012d}.json"
            try:
                self._write_text(path, json.dumps({"tables": tables, "published": published, "marks": epochs,
                                                   "entries": {d: [list(e)] for d, e in (entries or {}).items()}}))
                return
            except Py4JJavaError as e:  # another writer took the number: look again
                if not self._exists(path):
                    raise e
        raise PublishConflict("the commit log kept changing")

    def overwrite(self, table: str, df: DataFrame, version: str, **kw) -> Commit:
        """S-05/S-06: write and publish in one call (single-target runs, tests)."""
        c = self.write(table, df, version, **kw)
        self.publish(table, c)
        return c

    def vacuum(self, table: str, keep_commits: int = 2, include_unpublished: bool = False) -> list[str]:
        """Delete version folders that none of the last ``keep_commits`` commits use.

        Folders of versions that were written but never published (no-op runs,
        failed runs) are removed only with ``include_unpublished`` — call it
        when no writer is running.  Returns the deleted folders.
        """
        history: list[dict] = []
        for name in self._log_names():
            meta = ((self._log_entry(name) or {}).get("tables") or {}).get(table)
            if meta is not None and (not history or history[-1]["seq"] != meta["seq"]):
                history.append(meta)
        if not history:
            return []
        def version_dirs(meta: dict) -> set[str]:
            return {p.split("/data/", 1)[1].split("/", 1)[0] for p in meta["parts"].values()}
        kept: set[str] = set()
        for meta in history[-keep_commits:]:
            kept |= version_dirs(meta)
        published: set[str] = set()
        for meta in history[:-keep_commits]:
            published |= version_dirs(meta)
        deleted = []
        for v in self._list(f"{self.table_path(table)}/data"):
            if v in kept or (v not in published and not include_unpublished):
                continue
            path = f"{self.table_path(table)}/data/{v}"
            fs, p = self._fs(path)
            fs.delete(p, True)
            deleted.append(path)
        return deleted

    def append(self, table: str, df: DataFrame) -> None:
        """S-10: append-only log tables (run history) use Spark's own append commit."""
        path = f"{self.table_path(table)}/log"
        with _TURNS[path]:  # two appends to one folder would share their temporary folder
            df.write.mode("append").parquet(path)

    def read_log(self, table: str, schema: str | None = None) -> DataFrame | None:
        """A log's rows; without any, an empty frame if ``schema`` is given."""
        if not self._list(f"{self.table_path(table)}/log"):
            return None if schema is None else self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.table_path(table)}/log")


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)


def _marker(name: str) -> str:
    """A file name that stands for any text."""
    return quote(name, safe="")


def _data_schema(c: Commit) -> T.StructType:
    if not c.partition_col:
        return c.schema
    return T.StructType([f for f in c.schema.fields if f.name != c.partition_col])
