"""What one task holds at a time."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.operators import process, user_aggregates
from roadwatch.sources import files


def test_process_functions_get_slices(spark):
    rows = spark.range(3000).coalesce(1)
    sizes = process.per_partition(rows, "id long, n long", lambda: None, lambda _, batch: batch.assign(n=len(batch)))
    found = sizes.agg(F.count("id"), F.max("n")).first()
    assert found[0] == 3000 and found[1] <= process.ROWS_AT_ONCE


def test_quantiles_of_many_groups():
    sketch = user_aggregates.Quantiles([0.5])
    states = sketch.add_groups([sketch.create(), sketch.create()], [pa.array([1.0, None, -2.0, 7.0, 7.0])], [0, 3, 5])
    assert states == [sketch.add_all(sketch.create(), [pa.array(v)]) for v in ([1.0, None, -2.0], [7.0, 7.0])]


def test_long_rows_make_more_cuts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "run_dir", lambda *_: str(tmp_path / "replay"))
    rows = spark.range(100).withColumn("text", F.lit("x"))
    files.replayed(spark, rows, "id", "long", F.lit(files.CUT_BYTES // 5))
    assert len(list((tmp_path / "replay").glob("cut=*"))) > 2 * files.LEAST_CUTS
