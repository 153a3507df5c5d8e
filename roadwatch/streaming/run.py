"""Running a stream to the end of its present input, into a table.

Each micro-batch overwrites its own folder, so a batch that runs again after a
failure leaves the same rows. Folders lie in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import latest_per_key
from ..session import ROCKSDB_PROVIDER, remove_folder, run_dir

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"

Writer = Callable[[DataFrame, int], None]


def batch_writer(folder: str, per_batch: Callable[[DataFrame], DataFrame] | None = None) -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = per_batch(batch) if per_batch else batch
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    return write


def start(stream: DataFrame, writer: Writer, checkpoint: str, mode: str = "append",
          **trigger) -> StreamingQuery:
    """Start with the state in RocksDB, which spills to disk and holds large states."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, ROCKSDB_PROVIDER)
    try:
        return (stream.writeStream.outputMode(mode).foreachBatch(writer)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for the end of the input, however long that takes; ``seconds`` is for streams
    that have no end."""
    try:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError(f"stream still runs after {seconds} s")
    finally:
        query.stop()


def to_table(stream: DataFrame, name: str, mode: str = "append",
             per_batch: Callable[[DataFrame], DataFrame] | None = None,
             folder: str | None = None) -> DataFrame:
    """Run over all present input; the rows written, with their ``batch_id``.

    Pass the ``folder`` of an earlier run to go on from its checkpoint; without
    one nobody can, and the checkpoint goes when the run has ended.
    """
    own, folder = folder is None, folder or run_dir(stream.sparkSession, name)
    finish(start(stream, batch_writer(f"{folder}/out", per_batch), f"{folder}/checkpoint", mode))
    if own:
        remove_folder(stream.sparkSession, f"{folder}/checkpoint")
    try:
        return stream.sparkSession.read.parquet(f"{folder}/out")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # The input was empty, so no batch ran.
        none = stream.sparkSession.createDataFrame([], stream.schema)
        return (per_batch(none) if per_batch else none).withColumn("batch_id", F.lit(0))


def final_rows(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each key of an update-mode table."""
    return latest_per_key(written, keys, "batch_id").drop("batch_id")


def fan_out(outputs: Mapping[str, Callable[[DataFrame, int], None]],
            split: Callable[[DataFrame], Mapping[str, DataFrame]]) -> Writer:
    """One micro-batch to several sinks; the batch is computed once.

    Every sink must be idempotent by batch id, as the writers here are.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in split(batch).items():
                outputs[name](rows, batch_id)
        finally:
            batch.unpersist()
    return write


def without_zone(df: DataFrame) -> DataFrame:
    """Times as batch inputs have them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermark; a time without zone is taken as UTC, the session's zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
