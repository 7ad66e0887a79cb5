"""Report extracts on a landing folder (S-01, S-03, S-04, X-16).

A landing entry is named ``{dataset}_{epoch_seconds}.{parquet|csv}``, one per
run; it may be a single file or a folder of part files written by Spark.
Reading goes through an explicit schema (no per-file inference) and adds the
columns keep-last needs for a deterministic "last":

* ``extract_file``  — the landing entry's name;
* ``extract_epoch`` — the run stamp parsed from that name (run order);
* ``extract_ord``   — position inside the extract: ``part_number * 2^40 +
  row_index``, i.e. file order across the part files of one extract,
  independent of how Spark splits the files.

Run order and position stay separate columns: keep-last uses the epoch as the
run sequence and the position inside it (``seq_col`` / ``ord_col`` of
:func:`snapmerge.operators.merge.accumulate_and_classify`).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Landing entry pattern (anywhere in a path: the entry may be a
# folder of part files), part-file number pattern, rows per part file slot.
LANDING_PATTERN = r"^(.+)_(\d+)\.(parquet|csv)$"
PART_STRIDE = 1 << 40

EPOCH = "extract_epoch"
ORD = "extract_ord"
FILE = "extract_file"


def dataset_of(file_name: Column) -> Column:
    return F.regexp_extract(file_name, LANDING_PATTERN, 1)


def epoch_of(file_name: Column) -> Column:
    """X-16: epoch seconds from a landing entry name (null when absent)."""
    return F.regexp_extract(file_name, LANDING_PATTERN, 2).try_cast("long")


def _landing_epoch(name: Column) -> Column:
    """Epoch of a landing name ``{dataset}_{epoch}.{parquet|csv}``, else null.

    String functions only (no regex): this runs once per row of every extract.
    """
    stem = F.substring_index(name, ".", 1)
    epoch = F.substring_index(stem, "_", -1).try_cast("long")
    is_landing = (name.endswith(".parquet") | name.endswith(".csv")) & F.instr(stem, "_").__gt__(0)
    return F.when(is_landing, epoch)


def _part_number(file_name: Column) -> Column:
    """``part-00003-…`` → 3 (Spark part files); 0 for any other file."""
    num = F.substring_index(F.substring(file_name, 6, 64), "-", 1).try_cast("long")
    return F.when(file_name.startswith("part-"), F.coalesce(num, F.lit(0).cast("long"))).otherwise(
        F.lit(0).cast("long"))


def with_landing_columns(df: DataFrame, row_index: bool = True) -> DataFrame:
    """S-03: add the landing entry name, its run epoch and each row's position.

    The entry is the data file itself, or its folder when the folder carries the
    landing name (a Spark-written entry).  Only cheap string functions run per
    row; each is evaluated once (the parts are computed in their own projection).
    """
    name, parent = "_sm_file_name", "_sm_parent"
    # without row_index: the number of the row in its task, which reads whole files in order
    rows = (F.col("_metadata.row_index") if row_index
            else F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    path = F.col("_metadata.file_path")
    step = df.select("*", F.col("_metadata.file_name").alias(name),
                     F.substring_index(F.substring_index(path, "/", -2), "/", 1).alias(parent),
                     rows.alias("_sm_row"))
    own, up = _landing_epoch(F.col(name)), _landing_epoch(F.col(parent))
    step = (step.withColumn("_sm_own", own).withColumn("_sm_up", up)
            .withColumn(FILE, F.when(F.col("_sm_own").isNotNull(), F.col(name))
                        .when(F.col("_sm_up").isNotNull(), F.col(parent)).otherwise(F.col(name)))
            .withColumn(EPOCH, F.coalesce("_sm_own", "_sm_up")))
    return (step.withColumn(ORD, _part_number(F.col(name)) * F.lit(PART_STRIDE) + F.col("_sm_row"))
            .drop(name, parent, "_sm_row", "_sm_own", "_sm_up"))


def read_extract(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
                 fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """S-01: read one or more extracts with a declared schema, plus landing columns.

    CSV has no ``row_index``.  A CSV entry is read one file per task
    (``multiLine``), so the rows of a file are numbered in file order by
    ``monotonically_increasing_id`` within its task.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("multiLine", "true")
    return with_landing_columns(reader.load(path), row_index=(fmt == "parquet"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """S-02: a stored snapshot if it exists, else an empty frame with ``schema``."""
    if path_exists(spark, path):
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.createDataFrame([], schema)


def _landing_entries(spark: SparkSession, landing_dir: str) -> list[tuple[str, str, int, int]]:
    """(path, name, bytes, data files) of the landing entries, also of those without bytes or files."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [root] if fs.exists(root) else []
    while todo:
        for s in fs.listStatus(todo.pop()):
            path, name = s.getPath(), s.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if re.search(LANDING_PATTERN, name):
                files = [s] if s.isFile() else [f for f in fs.listStatus(path) if f.isFile() and f.getPath().getName().endswith((".parquet", ".csv"))]
                found.append((path.toString(), name, sum(f.getLen() for f in files), len(files)))
            elif s.isDirectory():
                todo.append(path)
    return found


def landing_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """S-03: one row per landing entry — path, dataset, run epoch, run timestamp,
    bytes and number of data files.

    Only folders are listed, no file is opened.  Part files of a Spark-written
    entry count for their entry; an entry without a byte is listed too
    (``length`` 0), so that a broken export does not pass for no export.
    """
    entries = spark.createDataFrame(_landing_entries(spark, landing_dir), "path string, file_name string, length long, parts long")
    return (entries.withColumn("dataset", dataset_of(F.col("file_name"))).withColumn("epoch", epoch_of(F.col("file_name")))
            .where(F.col("epoch").isNotNull()).withColumn("run_ts", F.timestamp_seconds("epoch"))
            .select("path", "file_name", "dataset", "epoch", "length", "parts", "run_ts"))


def latest_extract_per_dataset(files: DataFrame, datasets: list[str] | None = None) -> DataFrame:
    """S-04: newest landing file per dataset (``max_by(path, epoch)``).

    Requested datasets without any file come back with a null path, so the
    runner can write their audit row ("skipped, no extract").
    """
    latest = files.groupBy("dataset").agg(F.max_by("path", "epoch").alias("path"),
                                          F.max("epoch").alias("epoch"))
    if not datasets:
        return latest
    wanted = files.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string")
    return wanted.join(latest, "dataset", "left")
