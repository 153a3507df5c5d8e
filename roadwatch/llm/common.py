"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import json
import re
import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The white space of the contracts: blank, tab, line feed, vertical tab, form feed, return.
WHITE = r"[\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send the module's functions to workers by value, so they need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(named(column), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    as_text = F.coalesce(named(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(as_text.cast("binary")), F.lit(modulus)).cast("int")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table already has a column of that name."""
    taken = {c.lower().split(".")[0] for c in df.columns} | {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, function, added: str = "") -> DataFrame:
    """``mapInArrow`` over whole rows of any column names; the result has the same columns, and behind
    them those of ``added``. The function sees columns by place."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = StructType([*plain.schema.fields, *StructType.fromDDL(added).fields] if added else plain.schema.fields)
    return plain.mapInArrow(function, schema).toDF(*df.columns, *schema.fieldNames()[len(df.columns):])


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that the driver has worked out, as a table: a literal in the plan, no Python on executors."""
    fields = re.findall(r"(?:^|, )(\w+) \w", schema)
    text = json.dumps([dict(zip(fields, row)) for row in rows])
    return spark.range(1, numPartitions=1).select(
        F.inline(F.from_json(F.lit(text), f"array<struct<{_typed(schema)}>>")))


def _typed(schema: str) -> str:
    """``a int, b long`` as fields of a struct: ``a: int, b: long``."""
    return re.sub(r"(^|, )(\w+) (\w+)", r"\1\2: \3", schema)


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker, across the tasks of one operator.

    Another operator's tasks find it empty: what the one before has held is given back first.
    """
    name = "_roadwatch_worker_cache"
    state = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if state.get("owner") != owner:
        state["owner"], state["held"] = owner, {}
        _give_back()
    return state["held"]


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


ship(__name__)
