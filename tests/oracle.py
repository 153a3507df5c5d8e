"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _sorted(rows, columns, order):
    picked = [tuple(_plain(row[columns.index(c)]) for c in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None
                                              else (True, "", "") for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and all values agree."""
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    spark_names = df.columns
    if sorted(spark_names) != sorted(sql_names):
        return [f"columns {sorted(spark_names)} against {sorted(sql_names)}"]
    order = sorted(spark_names)
    spark_rows = _sorted([tuple(r) for r in df.collect()], spark_names, order)
    wanted = _sorted(sql_rows, sql_names, order)
    problems = []
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
             "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}
    spark_types = dict(df.dtypes)
    for d in result.description:
        if kinds.get(str(d[1]), str(d[1])) != spark_types[d[0]]:
            problems.append(f"type of {d[0]}: {spark_types[d[0]]} against {d[1]}")
    if len(spark_rows) != len(wanted):
        problems.append(f"{len(spark_rows)} rows against {len(wanted)}")
    if not wanted:
        problems.append("no rows")
    off = [(a, b) for a, b in zip(spark_rows, wanted) if a != b]
    if off:
        problems.append(f"{len(off)} rows differ ({order}), first {off[0]}")
    return problems
