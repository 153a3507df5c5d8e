"""Many keys share a state: one call and one value per bucket, whatever the number of keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadwatch.sources.files import stream_folder
from roadwatch.streaming import jobs, processors
from roadwatch.streaming.run import finish, start, to_table


def _stream(spark, folder, rows, cuts=2):
    for cut in range(cuts):
        rows.where(F.col("arrival") % cuts == cut).coalesce(1).write.mode("append").parquet(str(folder))
    return stream_folder(spark, str(folder), rows.schema)


def test_more_keys_than_buckets(spark, tmp_path):
    n = 3 * processors.KEY_BUCKETS
    rows = spark.range(2 * n).select((F.col("id") / 2).cast("long").alias("guid"), F.col("id").alias("arrival"),
                                     F.lit("a").alias("event_id"))
    stream = _stream(spark, tmp_path / "in", rows)
    query = start(jobs.text_so_far(stream, "guid", "arrival", "event_id"), lambda batch, _: batch.write.mode(
        "append").parquet(str(tmp_path / "out")), str(tmp_path / "checkpoint"))
    finish(query)
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= processors.KEY_BUCKETS
    found = spark.read.parquet(str(tmp_path / "out")).groupBy("joined").count().collect()
    assert {r["joined"]: r["count"] for r in found} == {"a": n, "aa": n}


def test_null_and_nan_are_keys(spark, tmp_path):
    rows = spark.createDataFrame([(None, 0), (float("nan"), 1), (0.0, 2), (None, 3), (float("nan"), 4), (-0.0, 5)],
                                 "guid double, arrival long").withColumn("event_id", F.lit("a"))
    found = to_table(jobs.text_so_far(_stream(spark, tmp_path / "in", rows, 1), "guid", "arrival", "event_id"), "nan")
    assert sorted((str(r["guid"]), r["joined"]) for r in found.collect()) == [
        ("0.0", "a"), ("0.0", "aa"), ("None", "a"), ("None", "aa"), ("nan", "a"), ("nan", "aa")]
