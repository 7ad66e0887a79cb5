"""Stored tables in key slices: a merge reads and rewrites only the slices its batch touches (J-03, U-02, U-04, S-11, A-01..A-04).

Layout.  A table has a fixed number of slices, a partition column that the key decides: runs of consecutive
integers of the first key column share a slice (ids are issued in order, so a day's batch meets few
slices), other keys are hashed.  Inside a slice the files are bucketed by Spark (``bucketBy``) on the key's text, so bucket i of
any slices can be joined with the batch in one task: the batch is shuffled to the buckets, the stored rows are not.

A merge runs with as many shuffle partitions as buckets (set for its duration; run one merge at a time in a session).
It takes three jobs, none of which reads an untouched slice:

1. the slices of the batch (one row per slice reaches the driver);
2. an aggregate over the merge of those slices and the batch: per slice its change counts, its row count and an
   order-independent 128-bit digest of its rows, and what the changed rows add to the totals.  A slice whose digest
   equals the stored one is not written; if none differs, no data file is written at all;
3. the write of the changed slices.

The commit carries rows and digest per slice and the totals' state, so the totals row needs no stored row: a changed row
adds its new value and retracts its previous one.  States are exact decimals (fractional values as ``bround(x, 6)``, the merge's own
tolerance), null and NaN count as missing.

Rows are compared and chosen as in :mod:`snapmerge.operators.merge`: last batch row per key, null keys equal, first-seen
stamps kept.  A row that compares equal stays as it is stored (J-03).  An empty batch changes nothing.  Batch columns
are cast to the stored types; a column that one side lacks is null there.
"""

from __future__ import annotations

import contextlib
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null, qcol
from ..operators import merge as M
from ..operators import totals as TT
from ..operators.sizing import with_known_rows
from ..sources.store import Commit, TableStore

SLICE = "_slice"
KEY_TEXT = "_key"
#: rows of a file aimed at when a table is made; its first batch decides the layout, which it keeps
ROWS_PER_FILE = 200_000
#: most rows of a bucket when a table is made: a task of a merge holds one bucket of the touched slices
ROWS_PER_TASK = 500_000
#: least and most slices of a table, and buckets: files of a slice, and tasks of a merge
SLICES = (16, 4096)
BUCKETS = (4, 4096)
#: runs of ids per slice when a table is made: a run is that part of the first batch's span of ids
RUNS_PER_SLICE = 4
#: decimals of fractional totals
SCALE = 6


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class MergeReport:
    version: str
    new_rows: int = 0
    edited_rows: int = 0
    total_rows: int = 0
    slices_read: int = 0
    slices_written: int = 0
    bytes_written: int = 0
    published: bool = False
    written: list[str] = field(default_factory=list)


def key_text(keys: Sequence[str]) -> Column:
    """The key as one text that is never null; equal exactly for equal keys (nulls included)."""
    return F.to_json(F.struct(*[qcol(k).alias(k) for k in keys]), {"ignoreNullFields": "false"})


def slice_of(schema: T.StructType, keys: Sequence[str], slices: int, run: int) -> Column:
    """The slice of a row, from its key alone."""
    first = schema[keys[0]].dataType
    if isinstance(first, _INTEGERS):
        part = F.coalesce(F.floor(qcol(keys[0]).cast("long") / run), F.lit(-1)).cast("long")
    else:
        part = key_text(keys)
    return F.pmod(F.xxhash64(part), F.lit(slices)).cast("int")


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two sums of row hashes: equal for equal multisets of rows, in any order."""
    # each value hashed with its column's name; a null adds nothing, so that a column without values is like none
    cells = [x for c in sorted(columns) for x in (F.when(qcol(c).isNotNull(), F.lit(c)), qcol(c))]
    return [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for seed in (1, 2)]


def _exact(c: Column, dtype: T.DataType) -> Column:
    """A value as a decimal that sums without rounding; NaN as null."""
    c = nan_to_null(c, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = F.bround(c, SCALE)
    return c.cast(f"decimal(38,{dtype.scale if isinstance(dtype, T.DecimalType) else 0 if not isinstance(dtype, (T.FloatType, T.DoubleType)) else SCALE})")


class KeyedTable:
    """A table of a :class:`TableStore` with one row per key, in key slices."""

    def __init__(self, store: TableStore, table: str, keys: Sequence[str], slices: int | None = None, buckets: int | None = None, run: int | None = None,
                 ord_col: str | None = None, seq_col: str | None = None):
        self.store, self.table, self.keys = store, table, list(keys)
        layout = ((self._commit() or Commit(0, "", {}, None, "{}", [])).extra or {}).get("layout", [slices, buckets, run])
        self.slices, self.buckets, self.run = layout  # a table keeps the layout it was made with
        self.ord_col, self.seq_col = ord_col, seq_col

    def _lay_out(self, batch: DataFrame) -> None:
        """Slices, buckets and the length of the runs of ids (1: the key is no integer) for a new table.

        A named number of buckets is the least: the tasks of a merge grow with the table, not the rows of a task.
        """
        first = qcol(self.keys[0])
        span = (F.max(first) - F.min(first)).cast("long") if isinstance(batch.schema[self.keys[0]].dataType, _INTEGERS) else F.lit(0)
        made = batch.agg(F.count(F.lit(1)).alias("rows"), span.alias("span")).first()
        self.buckets = max(self.buckets or BUCKETS[0], min(BUCKETS[1], math.ceil(made["rows"] / ROWS_PER_TASK)))
        self.slices = self.slices or min(SLICES[1], max(SLICES[0], made["rows"] // ROWS_PER_FILE // self.buckets))
        self.run = self.run or (made["span"] or 0) // (RUNS_PER_SLICE * self.slices) or 1

    def _commit(self) -> Commit | None:
        return self.store.latest_commit(self.table)

    # ------------------------------------------------------------ read
    def read(self) -> DataFrame | None:
        """The stored rows, without the layout's columns; rows of slices that the last version did not write are unchanged."""
        rows = self._rows()
        return None if rows is None else rows.drop(KEY_TEXT)

    def _rows(self) -> DataFrame | None:
        """One scan of the slices that the last version wrote and one of the others."""
        c = self._commit()
        if c is None:
            return None
        schema = T.StructType([f for f in c.schema.fields if f.name != SLICE])
        own = set(self.store.rewritten_parts(c))
        scan = lambda folders: self.store.spark.read.schema(schema).parquet(*folders) if folders else self.store.spark.createDataFrame([], schema)
        old = scan([v for k, v in sorted(c.parts.items()) if k not in own]).withColumn(M.CHANGE, F.lit(M.UNCHANGED))
        return with_known_rows(scan([c.parts[k] for k in sorted(own)]).unionByName(old), c.rows)

    def totals(self) -> DataFrame | None:
        """A-01..A-03: the totals row from the commit's state; no stored row is read."""
        c = self._commit()
        if c is None:
            return None
        state, cells, fields = c.extra["totals"], [], []
        for f in c.schema.fields:
            if f.name in (SLICE, KEY_TEXT, *M.STAMPS, M.CHANGE):
                continue
            total, n = state.get(f.name, ("0", 0))
            if TT.is_money(f.name):
                kind = TT.sum_type(f.dataType)
                cells.append(Decimal(total) if isinstance(kind, T.DecimalType) else int(Decimal(total)) if isinstance(kind, T.LongType) else float(total))
            elif TT.is_percent(f.name):
                kind = T.DoubleType()
                cells.append(float(Decimal(total)) / n if n else None)
            else:
                kind = f.dataType
                cells.append(None)
            fields.append(T.StructField(f.name, kind))
        return self.store.spark.createDataFrame([(*cells, True)], T.StructType([*fields, T.StructField(TT.IS_TOTAL, T.BooleanType())]))

    def verify(self) -> list[str]:
        """Slices whose stored rows differ from the digest of their commit (reads the whole table)."""
        c = self._commit()
        if c is None:
            return []
        names = [f.name for f in c.schema.fields if f.name not in (SLICE, M.CHANGE)]
        a, b = row_digest(names)
        have = {str(r[0]): [str(r.a), str(r.b)] for r in self._rows().groupBy(slice_of(c.schema, self.keys, self.slices, self.run).alias(SLICE)).agg(a.alias("a"), b.alias("b")).collect()}
        return sorted(k for k in {*have, *c.extra["digests"]} if have.get(k) != c.extra["digests"].get(k))

    def _bucketed(self, c: Commit, parts: dict[str, str]) -> tuple[str, DataFrame]:
        """Some slices as a bucketed table of the session catalog: (its name, rows).  The data stays where it is."""
        spark, name = self.store.spark, f"keyed_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in c.schema.fields if f.name != SLICE)
        where = self.store.table_path(self.table)
        spark.sql(f"CREATE TABLE {name} ({columns}, `{SLICE}` int) USING parquet PARTITIONED BY (`{SLICE}`) "
                  f"CLUSTERED BY (`{KEY_TEXT}`) SORTED BY (`{KEY_TEXT}`) INTO {self.buckets} BUCKETS LOCATION '{where}/data'")
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (`{SLICE}` = {k}) LOCATION '{v}'" for k, v in sorted(parts.items())))
        return name, spark.table(name)

    # ------------------------------------------------------------ merge
    def changes(self) -> DataFrame | None:
        """J-04: the new and edited rows of the last version; only the slices that it wrote are read."""
        rows = self.read()
        return None if rows is None else rows.where(F.col(M.CHANGE) != M.UNCHANGED)

    def merge(self, batch: DataFrame, version: str, run_seq: int = 0, entries: dict | None = None) -> MergeReport:
        """U-04 / J-03: merge a batch by key; publishes a version if any row is new or edited.

        New rows are stamped with ``run_seq`` and their position.  ``entries``: see :meth:`TableStore.publish_all`.
        """
        commit, report = self.prepare(batch, version, run_seq)
        if commit is not None or entries:
            self.store.publish_all({self.table: commit} if commit is not None else {}, entries)
        report.published = commit is not None
        return report

    def prepare(self, batch: DataFrame, version: str, run_seq: int = 0) -> tuple[Commit | None, MergeReport]:
        """The merge without its publication, so that several tables can be published together; no commit if nothing changes."""
        report, c = MergeReport(version), self._commit()
        if c is None:
            self._lay_out(batch)
        tagged = M.tag(batch, 1, self.ord_col, self.seq_col)
        routed = tagged.withColumn(KEY_TEXT, key_text(self.keys)).withColumn(SLICE, slice_of(batch.schema, self.keys, self.slices, self.run))
        touched = {str(r[0]) for r in routed.select(SLICE).distinct().collect()}  # at most one row per slice
        old = {k: v for k, v in (c.parts if c else {}).items() if k in touched}
        report.slices_read = len(old)
        name, prev = self._bucketed(c, old) if old else (None, None)
        # Spark shuffles a bucketed side too if there are more shuffle partitions than buckets
        conf, partitions = self.store.spark.conf, self.store.spark.conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(self.buckets))
        try:
            return self._merge(routed, prev, c, report, version, run_seq), report
        finally:
            conf.set("spark.sql.shuffle.partitions", partitions)
            if name:
                self.store.spark.sql(f"DROP TABLE {name}")

    def _merge(self, routed: DataFrame, prev: DataFrame | None, c: Commit | None, report: MergeReport, version: str, run_seq: int) -> Commit | None:
        merged, names, kinds = self.merged(routed, prev, c, run_seq)
        known = (c.extra if c else None) or {"digests": {}, "totals": {}}
        a, b = row_digest([n for n in names if n != SLICE])
        numbers = [n for n in names if TT.is_money(n) or TT.is_percent(n)]
        deltas = []
        for i, n in enumerate(numbers):
            now, before = _exact(qcol(n), kinds[n]), _exact(F.col(M.PREV).getField(n), kinds[n])
            moved = F.col(M.CHANGE) != M.UNCHANGED
            deltas += [F.sum(F.when(moved, now)).alias(f"in{i}"), F.sum(F.when(moved, before)).alias(f"out{i}"),
                       F.sum(F.when(moved, now.isNotNull().cast("long") - before.isNotNull().cast("long"))).alias(f"n{i}")]
        found = merged.groupBy(SLICE).agg(F.count_if(F.col(M.CHANGE) == M.NEW).alias("new"), F.count_if(F.col(M.CHANGE) == M.EDITED).alias("edited"),
                                          F.count(F.lit(1)).alias("rows"), a.alias("a"), b.alias("b"), *deltas).collect()  # one row per slice
        changed = [r for r in found if known["digests"].get(str(r[SLICE])) != [str(r.a), str(r.b)]]
        report.new_rows, report.edited_rows = sum(r.new for r in found), sum(r.edited for r in found)
        rows = {**((c.part_rows or {}) if c else {}), **{str(r[SLICE]): r["rows"] for r in found}}
        report.total_rows = sum(rows.values())
        if not changed:
            return None
        own = [r[SLICE] for r in changed]
        out = merged.where(F.col(SLICE).isin(own)).select(*[qcol(n) for n in names], F.col(M.CHANGE))
        new = self.store.write(self.table, out, version, partition_col=SLICE, key=self.keys, save=self._save(prev is None))
        totals = {n: list(v) for n, v in known["totals"].items()}
        for i, n in enumerate(numbers):
            before, count = totals.get(n, ("0", 0))
            moved = sum(((r[f"in{i}"] or Decimal(0)) - (r[f"out{i}"] or Decimal(0)) for r in found), Decimal(before))
            totals[n] = [format(moved, "f"), count + sum((r[f"n{i}"] or 0) for r in found)]
        new.part_rows, new.rows = {k: rows[k] for k in new.parts}, report.total_rows
        new.extra = {"hidden": [SLICE, KEY_TEXT], "layout": [self.slices, self.buckets, self.run], "totals": totals,
                     "digests": {**known["digests"], **{str(r[SLICE]): [str(r.a), str(r.b)] for r in changed}}}
        report.slices_written, report.written = len(own), sorted(map(str, own))
        report.bytes_written = self.store.bytes_of(new.folder)
        return new

    def merged(self, routed: DataFrame, prev: DataFrame | None, c: Commit | None, run_seq: int) -> tuple[DataFrame, list[str], dict]:
        """Rows of the touched slices after the merge, with change_type and the previous row; their stored columns and types."""
        meta = (M.SRC, M.ORD, KEY_TEXT, SLICE, M.CHANGE, *M.STAMPS)
        fields = {f.name: f.dataType for f in (c.schema.fields if c else []) if f.name not in meta}  # stored columns and types come first
        fields.update({f.name: f.dataType for f in routed.schema.fields if f.name not in meta and f.name not in fields})
        vals = [n for n in fields if n not in self.keys]
        kept = [M.STAMP_RUN, M.STAMP_ORD]

        def packed(df: DataFrame, src: Column, ord_: Column, stamps: Sequence[Column]) -> Column:
            cells = [(qcol(n) if n in df.columns else F.lit(None)).cast(fields[n]).alias(n) for n in fields]
            return F.struct(src.cast("long").alias(M.SRC), ord_.cast("long").alias(M.ORD), *cells, *(s.cast("long").alias(n) for s, n in zip(stamps, kept)))

        last = packed(routed, F.col(M.SRC), F.col(M.ORD), (F.lit(run_seq), F.col(M.ORD)))
        batch = routed.groupBy(KEY_TEXT).agg(F.max(last).alias("_batch"), F.min(SLICE).alias("_to"))
        if prev is None:
            g = batch.select(KEY_TEXT, F.col("_to").alias(SLICE), F.col("_batch").alias(M.LAST), F.lit(None).cast(batch.schema["_batch"].dataType).alias(M.PREV))
        else:
            stored = prev.select(KEY_TEXT, SLICE, packed(prev, F.lit(0), F.lit(0), [F.col(n) for n in kept]).alias(M.PREV))
            g = stored.join(batch, KEY_TEXT, "full_outer").select(
                KEY_TEXT, F.coalesce(SLICE, "_to").alias(SLICE), F.coalesce("_batch", M.PREV).alias(M.LAST), M.PREV)
        same = [(n, fields[n]) for n in vals if n not in (self.ord_col, self.seq_col)]
        first = [F.coalesce(F.col(M.PREV).getField(n), F.col(M.LAST).getField(n)).alias(n) for n in kept]
        g = g.withColumn(M.CHANGE, M._change_type(same))
        now = [F.when(F.col(M.CHANGE) == M.UNCHANGED, F.col(M.PREV).getField(n)).otherwise(F.col(M.LAST).getField(n)).alias(n) for n in fields]
        return g.select(KEY_TEXT, *now, *first, SLICE, M.PREV, M.CHANGE), [KEY_TEXT, *fields, *kept, SLICE], fields

    def _save(self, shuffle: bool):
        def save(df: DataFrame, folder: str) -> None:
            name = f"keyed_{uuid.uuid4().hex}"
            rows = df.repartition(self.buckets, KEY_TEXT) if shuffle else df  # a merge's rows are in their buckets already
            (rows.write.format("parquet").mode("error").partitionBy(SLICE).bucketBy(self.buckets, KEY_TEXT).sortBy(KEY_TEXT)
             .option("path", folder).saveAsTable(name))
            df.sparkSession.sql(f"DROP TABLE {name}")  # external: the files stay
        return save


def seed(store: TableStore, table: str, rows: DataFrame, keys: Sequence[str], version: str = "seed", **layout) -> KeyedTable:
    """A keyed table made from existing rows (S-09)."""
    t = KeyedTable(store, table, keys, **layout)
    t.merge(with_known_rows(rows, None), version)
    return t


@contextlib.contextmanager
def staged(store: TableStore, table: str, batch: DataFrame, version: str) -> Iterator[DataFrame]:
    """The batch, written once for the several jobs of a merge; its files go at the end."""
    commit = store.write(f"{table}_batch", batch, version)
    try:
        yield with_known_rows(store.read_commit(commit), None)
    finally:
        store.discard(commit)
