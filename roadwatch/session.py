"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str = "roadwatch", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them to spark-submit, where AQE coalesces a generous partition count.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master, which has no other machine, may fall back to a
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="roadwatch-")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete what a finished run has left and nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def names_in(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """What a folder holds, by name; nothing if it is not there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return [f.getPath().getName() for f in found or []]


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder, in place of one that is there."""
    at, system = _file(spark, path)
    out = system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    at, system = _file(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``run_dir`` gives in here are deleted at the end: for work whose result lies elsewhere by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove_folder(spark, path)


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run; none is ever used twice."""
    path = f"{shared_dir(spark)}/roadwatch/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path
