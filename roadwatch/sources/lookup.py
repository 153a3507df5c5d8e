"""Look-up in a table too large to scan for every micro-batch.

A batch's distinct keys are pushed to the table as predicates; what came back is
kept by key for ``max_age`` in the shared folder, keys without a row as well, so
only keys that are new or too old are asked for.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import duration_micros
from ..session import names_in, remove_folder, run_dir

#: Gives the table's rows that satisfy any of the predicates, or all rows for None.
Load = Callable[[list[str] | None], DataFrame]

KEYS_PER_PREDICATE = 500
MOST_KEYS = 100_000  # keys of a batch that are pushed; a batch with more reads the whole table


def literal(value) -> str:
    """A value as SQL text."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL text for a key of type {type(value).__name__}")


def predicates(keys: Sequence[str], rows: Sequence[tuple], per_predicate: int = KEYS_PER_PREDICATE) -> list[str]:
    """Conditions that hold for exactly these keys, each for some of them: one query of the source each."""
    found = []
    for low in range(0, len(rows), per_predicate):
        part = rows[low:low + per_predicate]
        if len(keys) == 1:
            found.append(f"{keys[0]} IN ({', '.join(literal(v) for v, in part)})")
        else:
            found.append(" OR ".join("(" + " AND ".join(f"{k} = {literal(v)}" for k, v in zip(keys, row)) + ")"
                                     for row in part))
    return found


def jdbc_load(spark: SparkSession, options: dict[str, str]) -> Load:
    """Rows of a JDBC table (``url``, ``dbtable``, ...), one partition per predicate."""
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}

    def load(conditions: list[str] | None) -> DataFrame:
        if conditions is None:
            return spark.read.format("jdbc").options(**options).load()
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=conditions, properties=rest)
    return load


class KeyedLookup:
    """The rows of a table for the keys of a batch."""

    def __init__(self, load: Load, keys: Sequence[str], folder: str, max_age: str, most_keys: int = MOST_KEYS,
                 clock: Callable[[], float] = time.time):
        self.load, self.keys, self.folder, self.most_keys, self.clock = load, list(keys), folder, most_keys, clock
        self.max_age_s = duration_micros(max_age) / 1e6

    def _known(self, spark: SparkSession) -> list[str]:
        """Folders of what is young enough, oldest first; others are deleted."""
        now, kept = self.clock(), []
        for name in names_in(spark, self.folder, "read-*"):
            path, read_at = f"{self.folder}/{name}", int(name.split("-")[1]) / 1000
            if read_at + self.max_age_s > now:
                kept.append((read_at, path))
            else:
                remove_folder(spark, path)
        return [path for _, path in sorted(kept)]

    def get(self, batch: DataFrame) -> DataFrame:
        """The table's rows of the batch's keys; keys with a null have none."""
        spark = batch.sparkSession
        wanted = batch.select(*self.keys).dropna().distinct()
        known = self._known(spark)
        missing = wanted
        if known:
            missing = wanted.join(spark.read.parquet(*known).select(*self.keys).distinct(), self.keys, "left_anti")
        missing = missing.persist()
        try:
            # The keys of one micro-batch, at most ``most_keys``.
            asked = [tuple(r) for r in missing.limit(self.most_keys + 1).collect()]
            if asked:
                few = len(asked) <= self.most_keys
                found = self.load(predicates(self.keys, asked) if few else None)
                rows = missing.join(found.withColumn("lookup_found", F.lit(True)), self.keys, "left").withColumn(
                    "lookup_found", F.coalesce("lookup_found", F.lit(False)))
                path = f"{self.folder}/read-{int(self.clock() * 1000)}-{run_dir(spark, 'x').rsplit('-', 1)[1]}"
                rows.write.parquet(path)
                known.append(path)
        finally:
            missing.unpersist()
        if not known:
            return self.load(["1 = 0"])
        held = spark.read.parquet(*known).where("lookup_found").drop("lookup_found")
        return held.join(wanted, self.keys, "left_semi")
