"""Incremental consolidation of a landing folder with Structured Streaming (R-01).

Extracts keep arriving in a landing folder (one file per run).  A file-source
stream picks up new files, and ``foreachBatch`` hands each micro-batch to the
same merge used in batch mode, writing through the versioned store:

* ``trigger(availableNow=True)`` processes everything new and stops — the
  scheduled-job shape of the original process, with exactly-once bookkeeping
  by the stream checkpoint;
* each micro-batch writes the version ``{stream_id}-b{batch_id}``, where the
  stream id belongs to the checkpoint folder; when a batch is replayed after a
  failure between publish and checkpoint commit, that version was published
  before and the batch is skipped (idempotent).  A new checkpoint is a new
  stream: its batches count from 0 again and are all stored;
* keep-last order inside a micro-batch is the run epoch from the entry name
  (``seq_col``), then the position inside the extract (``extract_ord``), so
  several files in one micro-batch give the same result as one per micro-batch;
* with ``sliced`` the table is stored in key slices
  (:class:`snapmerge.plans.keyed.KeyedTable`): a micro-batch reads and writes the
  slices that its keys touch, so its cost follows the batch, not the table, and
  :meth:`~snapmerge.plans.keyed.KeyedTable.changes` are the rows it made new or edited.

Watermarks are deliberately not used: they follow the maximum event time, not
the run date, and ``dropDuplicatesWithinWatermark`` keeps the *first* row,
not the last.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge as M
from ..plans import keyed as KT
from ..sources import extract as X
from ..sources.store import TableStore


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream of parquet extracts with the landing columns added."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return X.with_landing_columns(reader.parquet(landing_dir))


def stream_id(store: TableStore, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint folder, made on first use and kept in that folder."""
    path = f"{checkpoint.rstrip('/')}/snapmerge_stream_id"
    if not store._exists(path):
        store._write_text(path, uuid.uuid4().hex)
    return store._read_text(path).strip()


def accumulate_batch(store: TableStore, table: str, key: list[str], stream: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     ord_col: str = X.ORD, sliced: bool = False,
                     on_merge: Callable[[KT.MergeReport], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: keep-last accumulate a micro-batch into ``table``.

    ``ord_col`` orders rows of one key inside the micro-batch (default: run
    epoch, then file position).  ``sliced``: keep the table in key slices;
    ``on_merge`` then gets what each micro-batch changed and wrote.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        version = f"{stream}-b{batch_id}"
        if store.has_version(table, version):
            return  # replay of an already published micro-batch
        rows = transform(batch) if transform else batch
        rows = rows.drop(*[c for c in (X.FILE, X.ORD) if c in rows.columns and c != ord_col])
        if sliced:
            target = KT.KeyedTable(store, table, key, ord_col=ord_col, seq_col=X.EPOCH)
            with KT.staged(store, table, rows, version) as written:
                report = target.merge(written, version, run_seq=batch_id)
            if on_merge is not None:
                on_merge(report)
            return
        stored = store.read(table)
        if stored is not None:
            stored = stored.drop(*[c for c in (M.CHANGE,) if c in stored.columns])
        merged = M.accumulate_and_classify(stored, rows, key, ord_col=ord_col, seq_col=X.EPOCH,
                                           prev_unique=stored is not None)
        store.overwrite(table, merged, version, key=key)

    return process


def stream_accumulate(spark: SparkSession, landing_dir: str, schema: T.StructType, store: TableStore,
                      table: str, key: list[str], checkpoint: str,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      max_files_per_trigger: int | None = None, ord_col: str = X.ORD, sliced: bool = False,
                      on_merge: Callable[[KT.MergeReport], None] | None = None) -> StreamingQuery:
    """Start the availableNow stream; the caller ``awaitTermination()``s it.

    ``landing_dir`` is a folder or a glob of files (e.g. ``.../commission_*.parquet``).
    """
    src = landing_stream(spark, landing_dir, schema, max_files_per_trigger)
    stream = stream_id(store, checkpoint)
    return (src.writeStream.foreachBatch(accumulate_batch(store, table, key, stream, transform, ord_col, sliced, on_merge))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def as_of_from_epoch(epoch: int) -> dt.date:
    return dt.datetime.fromtimestamp(epoch, dt.timezone.utc).date()
