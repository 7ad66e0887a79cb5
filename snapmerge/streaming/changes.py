"""Keyed stateful stream of changes (R-01, J-01): the rows of a landing folder that are new or edited, and nothing else.

Where :mod:`.stream` merges each micro-batch into a stored table, this stream keeps a state for every business key
(``transformWithState``) and appends the changed rows to a change log.  A micro-batch reads and writes the states of its own
keys' groups and the log rows it makes, so its cost follows the batch; no stored row is read.

* The state of a key is a SHA-256 of its last row in comparable form (X-06, X-07: fractional numbers rounded half-even, null
  equal to null) and the number of changes so far.  It lives in RocksDB on the executors, with its change files in the
  checkpoint folder; a lost executor's state is rebuilt from there.
* Keys share a value state in groups by hash, about ``KEYS_PER_GROUP`` of them, as each call from Python to the state store costs
  far more than a key's own work.  A key is known there by the SHA-256 of its text.  The number of groups is fixed at the first
  start of a checkpoint and kept there: from the rows landed by then, or ``groups``.
* Of the rows of one key in a micro-batch the last one counts, by run epoch, then ``ord_col``, then the row's values in column order,
  as in every merge of the library; a later micro-batch outranks earlier ones whatever its epoch, as in the stored tables.
* A row travels as three JSON texts, each value in one of them; the digests are made where its key's rows meet.
* Rows of a key meet in one task.  Before that exchange each Arrow batch keeps the last row of each key, so a key that holds
  a third of all rows (the null key too: null keys are equal) reaches the task as one row per Arrow batch; the task reads them
  one after the other.
* The log is written by the file sink, whose own log makes each micro-batch visible once.

The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start of a checkpoint.  An empty landing folder gives an
empty log; a column that is missing from an extract is null, as in any read through a declared schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import FLOAT_TOLERANCE_DECIMALS, tolerant
from ..operators import merge as M
from ..sources import extract as X
from ..sources.store import TableStore
from .stream import landing_stream

CHANGE_NO = "change_no"   # 1 for the first row of a key, one more for each change
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# all digits of a timestamp, and fields that are null, stay in the text
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: a row on its way: its key, its compared values and the rest as JSON text (UTF-8), and the group of its key
KEY, SAME, REST, GROUP = "_key", "_same", "_rest", "_group"
#: keys that share a state (aimed at when a checkpoint is made), and the least number of groups
KEYS_PER_GROUP = 256
LEAST_GROUPS = 1 << 14


def _comparable(name: str, dtype: T.DataType):
    c = tolerant(F.col(f"`{name}`"), dtype)
    # -0.0 and 0.0 are equal values with different texts
    return F.when(c == 0, F.lit(0.0)).otherwise(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def _order_of(rows: DataFrame, ord_col: str, seq_col: str) -> list[tuple[str, list]]:
    """Each field, in the order in which fields decide, with flat columns whose order (null first) is that of its values; NaN is the
    greatest number.

    As JSON each column is null, a number or a text with the same order.
    """
    out = []
    for f in sorted(rows.schema.fields, key=lambda f: (f.name != seq_col) + (f.name not in (seq_col, ord_col))):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            special = F.when(F.isnan(c), 2).when(c == float("inf"), 1).when(c == float("-inf"), -1).when(c.isNotNull(), 0)
            out.append((f.name, [special, F.when(special == 0, c).when(c.isNotNull(), 0.0)]))
        elif isinstance(f.dataType, T.TimestampType):
            out.append((f.name, [F.unix_micros(c)]))
        elif isinstance(f.dataType, T.BinaryType):
            out.append((f.name, [F.hex(c)]))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.BooleanType)):
            out.append((f.name, [F.to_json(F.struct(c), JSON)]))
        else:
            out.append((f.name, [c]))
    return out


def _rounded(dtype: T.DataType) -> bool:
    """Whether the compared form of a value may differ from the value."""
    return isinstance(dtype, (T.FloatType, T.DoubleType)) or isinstance(dtype, T.DecimalType) and dtype.scale > FLOAT_TOLERANCE_DECIMALS


def _parts(schema: T.StructType, key: list[str], ord_col: str, seq_col: str) -> dict[str, T.StructType]:
    """The fields of a row that can be read from each of its texts; every field is in one."""
    where = lambda f: KEY if f.name in key else REST if f.name in (ord_col, seq_col) or _rounded(f.dataType) else SAME
    return {part: T.StructType([f for f in schema.fields if where(f) == part]) for part in (KEY, SAME, REST)}


def carried(rows: DataFrame, key: list[str], ord_col: str, seq_col: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Each row as the texts of its key, of its compared values and of the rest, its place in the order in flat columns, and where a key's
    rows have that place in their texts (text, name).

    A value is in one text only, and digests are made from the texts after the exchange: hex digests, which nothing compresses, and
    a second copy of the values took three quarters of its bytes.  The rest has the order columns, and the values that are rounded for
    the comparison or have another order as JSON.
    """
    parts, kind = _parts(rows.schema, key, ord_col, seq_col), {f.name: f.dataType for f in rows.schema.fields}
    values = [f for f in rows.schema.fields if f.name not in (*key, ord_col, seq_col)]
    same = F.to_json(F.struct(F.lit(0).alias("_"), *[_comparable(f.name, f.dataType).alias(f.name) for f in values]), JSON)
    flat, extra, place = [], [], []
    for name, columns in _order_of(rows, ord_col, seq_col):
        own = not isinstance(kind[name], (T.FloatType, T.DoubleType, T.TimestampType, T.BinaryType, T.StructType, T.ArrayType, T.MapType, T.BooleanType))
        for c in columns:
            c = c.alias(f"_o{len(flat)}")
            flat.append(c)
            if name not in key:  # of rows of one key
                place.append((REST if name in parts[REST].names else SAME, name) if own else (REST, f"_o{len(flat) - 1}"))
                extra += [] if own else [c]
    rest = F.to_json(F.struct(F.lit(0).alias("_"), *[f"`{n}`" for n in parts[REST].names], *extra), JSON)
    return rows.select(F.to_json(F.struct(*[f"`{k}`" for k in key]), JSON).alias(KEY), same.alias(SAME), rest.alias(REST), *flat), place


def _collapse():
    """Last row of each key of an Arrow batch, without the columns of its place (made here, so that executors need no copy of this package)."""
    def last_rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            by = ["_key", *[n for n in b.schema.names if n.startswith("_o")]]  # rows of a key have one group
            at = pc.sort_indices(pa.Table.from_batches([b]), sort_keys=[(n, "ascending") for n in by], null_placement="at_start")
            ends = pc.run_end_encode(b.column("_key").take(at)).run_ends
            yield b.select(["_group", "_key", "_same", "_rest"]).take(at.take(pc.subtract(ends, 1)))
    return last_rows


def _processor(place: list[tuple[str, str]]) -> StatefulProcessor:
    class Changes(StatefulProcessor):
        """State of a group: for each key its digest (32 bytes), the digest of its last row (32) and its number of changes (8)."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.keys = handle.getValueState("keys", "known binary")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.keys.update((bytes(initialState._known),))

        def handleInputRows(self, key, rows, timerValues):
            import json
            from decimal import Decimal
            from hashlib import sha256

            def at(r):
                # reading the texts costs more than the rest here, so it is done only where a key has rows of several Arrow batches
                texts = {part: json.loads(bytes(r[part]), parse_float=Decimal) for part in ("_same", "_rest")}
                return [((v := texts[part][name]) is not None, v) for part, name in place]

            newest = {}
            for r in rows:
                k = bytes(r._key)
                other = newest.get(k)
                if other is None or at(r) > at(other):
                    newest[k] = r
            got = self.keys.get()
            stored = bytes(got[0]) if got is not None else b""
            known = {stored[i:i + 32]: stored[i + 32:i + 72] for i in range(0, len(stored), 72)}
            out = []
            for text, r in newest.items():
                k, same = sha256(text).digest(), sha256(r._same).digest()
                before = known.get(k)
                if before is None or before[:32] != same:
                    number = 1 if before is None else int.from_bytes(before[32:], "big") + 1
                    known[k] = same + number.to_bytes(8, "big")
                    out.append(Row(change_no=number, _key=text, _same=r._same, _rest=r._rest))
            if out:
                self.keys.update((b"".join(k + v for k, v in known.items()),))
            yield from out

        def close(self) -> None:
            pass

    return Changes()


def changes(rows: DataFrame, key: list[str], ord_col: str = X.ORD, seq_col: str = X.EPOCH, initial: DataFrame | None = None,
            groups: int = LEAST_GROUPS) -> DataFrame:
    """The new and edited rows of a streaming frame: its columns, ``change_type`` and ``change_no``.

    ``initial``: rows stored before the stream's first start (one per key; columns and types as in ``rows``).
    ``groups``: how many groups the keys share states in; a checkpoint keeps the number it was made with.
    """
    group = F.pmod(F.xxhash64(F.sha2(KEY, 256)), F.lit(groups)).alias(GROUP)
    rows = rows.drop(*[c for c in (X.FILE,) if c in rows.columns])
    state = None
    if initial is not None:
        have = set(initial.columns)
        initial = initial.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
        state, _ = carried(initial, key, ord_col, seq_col)
        digest = lambda text: F.unhex(F.sha2(text, 256))
        once = F.concat(digest(KEY), digest(SAME), F.unhex(F.lit(f"{1:016x}")))
        state = state.select(group, once.alias("_known")).groupBy(GROUP).agg(F.listagg("_known").alias("_known")).groupBy(GROUP)
    sent, place = carried(rows, key, ord_col, seq_col)
    texts = [F.col(c).cast("binary").alias(c) for c in (KEY, SAME, REST)]
    sent = sent.select(group, *texts, *[c for c in sent.columns if c not in (KEY, SAME, REST)])
    binary = f"{KEY} binary, {SAME} binary, {REST} binary"
    out = (sent.mapInArrow(_collapse(), f"{GROUP} long, {binary}").groupBy(GROUP)
           .transformWithState(_processor(place), f"change_no long, {binary}", "append", "none", state))
    parts = _parts(rows.schema, key, ord_col, seq_col)
    out = out.select(*[F.from_json(F.col(c).cast("string"), fields, JSON).alias(c) for c, fields in parts.items() if fields.names], CHANGE_NO)
    read = {f.name: F.col(c).getField(f.name).alias(f.name) for c, fields in parts.items() for f in fields}
    return out.select(*[read[c] for c in rows.columns], F.when(F.col(CHANGE_NO) == 1, M.NEW).otherwise(M.EDITED).alias(M.CHANGE), CHANGE_NO)


def _groups(spark: SparkSession, landing_dir: str, schema: T.StructType, checkpoint: str, groups: int | None) -> int:
    """The number of groups a checkpoint was made with; a new one gets ``groups``, or as many as the landed rows need."""
    kept, name = TableStore(spark, checkpoint), f"{checkpoint.rstrip('/')}/groups"
    if not kept._exists(name):
        landed = 0 if groups else spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(landing_dir).count()  # from the file footers
        kept._write_text(name, str(groups or max(LEAST_GROUPS, landed // KEYS_PER_GROUP)))
    return int(kept._read_text(name))


def change_stream(spark: SparkSession, landing_dir: str, schema: T.StructType, key: list[str], log: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, max_files_per_trigger: int | None = None,
                  ord_col: str = X.ORD, initial: DataFrame | None = None, groups: int | None = None) -> StreamingQuery:
    """Start the availableNow stream from ``landing_dir`` into the change log ``log``; the caller ``awaitTermination()``s it.

    ``groups``: see :func:`changes`; name it where far more keys are expected than the rows landed at the first start.
    """
    groups = _groups(spark, landing_dir, schema, checkpoint, groups)
    rows = landing_stream(spark, landing_dir, schema, max_files_per_trigger)
    rows = transform(rows) if transform else rows
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)  # value states need it; the started query keeps its own copy of the settings
    try:
        return (changes(rows, key, ord_col, initial=initial, groups=groups).writeStream.format("parquet").outputMode("append")
                .option("path", log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(STATE_PROVIDER, before) if before else spark.conf.unset(STATE_PROVIDER)


def latest(log: DataFrame, key: list[str]) -> DataFrame:
    """The last row of each key in a change log (with the change that made it)."""
    newest = F.max_by(F.struct(*[f"`{c}`" for c in log.columns if c not in key]), CHANGE_NO).alias("_last")
    return log.groupBy(*key).agg(newest).select(*key, "_last.*")
