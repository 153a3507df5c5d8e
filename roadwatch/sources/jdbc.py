"""JDBC tables: whole scans, a refreshed snapshot, and an append sink.

Connection options are always passed in; none are stored here.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import latest_per_key

# Fixed value: the reference table is read again every 30 minutes.
REFRESH_SECONDS = 30 * 60


def scan_options(url: str, table: str, *, driver: str | None = None,
                 partition_column: str | None = None, low: int | str | None = None,
                 high: int | str | None = None, partitions: int | None = None,
                 fetch_rows: int = 10_000, **connection: str) -> dict[str, str]:
    """Reader options; with a partition column the scan runs in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **connection}
    if driver:
        options["driver"] = driver
    if partition_column:
        if None in (low, high, partitions):
            raise ValueError("a parallel scan needs low, high and partitions")
        options |= {"partitionColumn": partition_column, "lowerBound": str(low),
                    "upperBound": str(high), "numPartitions": str(partitions)}
    return options


def read(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def append(df: DataFrame, options: dict[str, str], batch_rows: int = 10_000) -> None:
    """Batched inserts from every partition."""
    (df.write.format("jdbc").options(**options).option("batchsize", batch_rows)
     .mode("append").save())


class RefreshedTable:
    """A reference table for ``foreachBatch``: loaded again once it is too old.

    The snapshot is written to the shared folder, so that batches between two
    loads do not ask the database again and a lost executor loses nothing.
    """

    def __init__(self, load: Callable[[], DataFrame], folder: str,
                 max_age_seconds: float = REFRESH_SECONDS,
                 clock: Callable[[], float] = time.monotonic,
                 keys: list[str] | None = None, order: str | None = None):
        """With ``keys`` the last row of each key wins: by ``order``, or as a scan of one partition delivers
        them. A scan of several has no order, so one must be named."""
        self._load, self._folder, self._keys, self._order = load, folder, keys, order
        self._max_age, self._clock = max_age_seconds, clock
        self._loaded_at: float | None = None
        self._version = 0
        self._snapshot: DataFrame | None = None

    def _last_of_each(self, rows: DataFrame) -> DataFrame:
        if not self._keys:
            return rows
        if not self._order and rows.rdd.getNumPartitions() > 1:
            raise ValueError("the rows of a partitioned scan come in no order: name the column that has it")
        order = self._order or "__place"
        placed = rows if self._order else rows.withColumn(order, F.monotonically_increasing_id())
        return latest_per_key(placed, self._keys, order).select(*rows.columns)

    def get(self) -> DataFrame:
        now = self._clock()
        if self._loaded_at is None or now - self._loaded_at >= self._max_age:
            fresh = self._last_of_each(self._load())
            path = f"{self._folder}/snapshot-{self._version}"
            fresh.write.mode("overwrite").parquet(path)
            self._snapshot = fresh.sparkSession.read.schema(fresh.schema).parquet(path)
            self._loaded_at, self._version = now, self._version + 1
        return self._snapshot


def append_once(batch: DataFrame, batch_id: int, key: list[str],
                existing: Callable[[], DataFrame], insert: Callable[[DataFrame], None]) -> None:
    """Append a micro-batch so that running it again adds nothing twice.

    A failed try may have written part of the batch: rows whose key the table
    already holds for this batch are left out. ``key`` must be unique in a batch;
    a batch that repeats one is refused, as its rows could not be told apart.
    """
    repeated = batch.groupBy(*key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"the key {key} is not unique in batch {batch_id}: {repeated[0]}")
    written = existing().where(F.col("batch_id") == batch_id).select(*key)
    insert(batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
           .join(written, key, "left_anti"))


def writer(options: dict[str, str], key: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. Without a key a repeated batch is inserted again;
    with one the table needs a column ``batch_id``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if key is None:
            append(batch, options)
        else:
            append_once(batch, batch_id, key, lambda: read(batch.sparkSession, options),
                        lambda rows: append(rows, options))
    return write
