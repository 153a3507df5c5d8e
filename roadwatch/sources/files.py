"""File inputs, batch and streaming."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import duration_micros, from_micros, micros
from ..session import run_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str,
                 files_per_batch: int | None = None) -> DataFrame:
    """The same table as a stream of its files."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The stream source takes a single file only by pattern.
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def stream_folder(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                  files_per_batch: int | None = 1) -> DataFrame:
    """Replay a folder in file time order, ``files_per_batch`` files per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str | None = None, fmt: str = "text",
                 **options: str) -> DataFrame:
    """Lines in a column ``value``; pass ``fmt="socket", host=..., port=...`` for a socket."""
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


CUT_ROWS = 1_000_000  # positions of the order in one replayed file
CUT_BYTES = 128 << 20  # of what the caller takes a row's size from
LEAST_CUTS = 6
FIRST_TIME = 1_700_000_000_000  # of a replay's files, in milliseconds


def closing(rows: DataFrame, order: str, time: str, after: str) -> DataFrame:
    """``rows`` and one more behind them, ``after`` later than all, null in every other column.

    For input that has come to its end: streamed last, it takes the watermark past every open
    window, so that append-mode streams give their last results as well. Its own window stays open.
    """
    ends = rows.agg((F.max(order) + 1).cast(rows.schema[order].dataType).alias(order),
                    from_micros(F.max(micros(F.col(time))) + duration_micros(after))
                    .cast(rows.schema[time].dataType).alias(time))
    return rows.unionByName(ends.where(F.col(order).isNotNull()), allowMissingColumns=True)


def replayed(spark: SparkSession, rows: DataFrame, order: str, name: str, size: Column | None = None) -> DataFrame:
    """A table as a stream in the order of a whole-number column, one cut per micro-batch.

    The order is cut into ranges of equal width, at least ``LEAST_CUTS``. All cuts
    are written by one job; the files' times then say which comes first. Where the
    store keeps its own times, the cuts are written again one after another. One task
    writes a cut: with long values, give a row's ``size`` in bytes, and there are more cuts.
    """
    highest, held = rows.agg(F.max(order), F.sum(F.lit(0) if size is None else size)).first()
    highest = highest or 0
    cuts = max(LEAST_CUTS, highest // CUT_ROWS, (held or 0) // CUT_BYTES)
    width = highest // cuts + 1
    path = run_dir(spark, f"replay-{name}")
    (rows.withColumn("cut", F.expr(f"`{order}` div {width}")).repartitionByRange(cuts, "cut")
     .write.partitionBy("cut").parquet(path))
    if not _timed(spark, path):
        path = _one_by_one(spark, path, rows.schema, run_dir(spark, f"replay-{name}"))
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{path}/cut=*"))


def _files(spark: SparkSession, path: str) -> list[tuple[int, object, object]]:
    """(cut, file system, file) of every file, in the order of the cuts."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/cut=*/*.parquet")
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(int(f.getPath().getParent().getName().removeprefix("cut=")), system, f) for f in system.globStatus(at)]
    return sorted(found, key=lambda f: f[0])


def _timed(spark: SparkSession, path: str) -> bool:
    """Give the files ascending times; False where the store does not take them."""
    for cut, system, file in _files(spark, path):
        system.setTimes(file.getPath(), FIRST_TIME + cut * 1000, -1)
    return all(file.getModificationTime() == FIRST_TIME + cut * 1000 for cut, _, file in _files(spark, path))


def _one_by_one(spark: SparkSession, path: str, schema, target: str) -> str:
    """The cuts again, each written when the store's time has passed that of the one before."""
    before = 0
    for cut, system, file in _files(spark, path):
        part = spark.read.schema(schema).parquet(file.getPath().toString()).coalesce(1)
        while True:
            part.write.mode("overwrite").parquet(f"{target}/cut={cut}")
            written = max(f.getModificationTime() for c, _, f in _files(spark, target) if c == cut)
            if written > before:
                break
            time.sleep(1)  # stores with times in whole seconds
        before = written
    return target
