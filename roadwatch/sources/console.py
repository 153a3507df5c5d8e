"""Print sink for looking at results."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

# Workers get the functions themselves, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _print_lines(rows: Iterator) -> None:
    for row in rows:
        print(row["line"], flush=True)


def print_stream(df: DataFrame, mode: str = "append", prefix: str = "", rows: int | None = None,
                 show: Callable[[str], object] | None = None) -> DataStreamWriter:
    """A writer that prints every row as comma-separated text behind ``prefix``.

    By default each executor prints its own rows, to its own output. With ``rows``,
    which limits what is shown of each micro-batch, or ``show``, the driver takes
    one partition at a time and prints, or calls ``show`` with each line.
    """
    lines = df.select(F.concat(F.lit(prefix), F.to_csv(F.struct("*"))).alias("line"))

    def write(batch: DataFrame, batch_id: int) -> None:
        if rows is None and show is None:
            batch.foreachPartition(_print_lines)
            return
        for row in islice(batch.toLocalIterator(), rows):
            (show or print)(row["line"])
    return lines.writeStream.outputMode(mode).foreachBatch(write)
