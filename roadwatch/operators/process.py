"""Row functions that need something opened once per partition.

Prefer column expressions; this is for set-up that they cannot hold, such as a
model or a client. Rows pass in Arrow batches, and from these in slices.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# Workers get the functions themselves, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


ROWS_AT_ONCE = 256  # a process function's copies of its rows are of so many


def per_partition(df: DataFrame, schema: str, open_: Callable[[], object],
                  process: Callable[[object, pd.DataFrame], pd.DataFrame],
                  close: Callable[[object], None] | None = None) -> DataFrame:
    """``process(resource, batch)`` with the resource opened and closed around a partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    yield process(resource, batch.iloc[at:at + ROWS_AT_ONCE].reset_index(drop=True))
        finally:
            if close:
                close(resource)
    return df.mapInPandas(run, schema)


def _accents() -> dict[int, str]:
    """Characters with marks to the bare ones, and marks to nothing; found once, by Unicode's own
    decomposition."""
    import unicodedata
    table = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char) and not unicodedata.category(char).startswith("M"):
            continue
        parts = unicodedata.normalize("NFD", char)
        bare = "".join(p for p in parts if not unicodedata.category(p).startswith("M"))
        if bare != char:
            table[code] = bare
    return table


def _strip(table: object, batch: pd.DataFrame) -> pd.DataFrame:
    batch["plain"] = batch["text"].str.translate(table).str.normalize("NFC")
    return batch[[c for c in batch.columns if c != "text"]]


def without_accents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Texts with bare letters, without marks. Spark has no function for it, and the letter table is the
    set-up that a partition shares."""
    rows = df.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return per_partition(rows, f"{key} long, plain string", _accents, _strip)
