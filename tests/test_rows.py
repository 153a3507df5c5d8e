"""Row-wise operators, joins, plans and connectors on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadwatch import schemas, session
from roadwatch.functions.parse import accepted, parse_delimited, rejected, tokenise
from roadwatch.functions.times import duration_micros, time_text
from roadwatch.operators import joins, overlap, project, route, topn, windows
from roadwatch.operators.running import count_rows
from roadwatch.plans import traffic
from roadwatch.sources import files, jdbc, kafka
from roadwatch.sources.stored import stored

AT = dt.datetime(2024, 1, 1)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_malformed_lines_go_to_the_reject_output(spark):
    good = "01\troad\t0001\tcam\t1704067200000\tcar\t88.5"
    df = lines(spark, good, "01\troad\t0001", "", good.replace("88.5", "fast"), None,
               good + "\textra", good.replace("\t88.5", "\t 7 "))
    parsed = parse_delimited(df, schemas.SIGHTING, "\t")
    ok = accepted(parsed, "value").collect()
    assert [r["speed"] for r in ok] == [88.5, 88.5, 7.0]
    assert ok[0]["action_time"] == 1704067200000
    assert accepted(parsed, "value").schema.simpleString() == schemas.SIGHTING.simpleString()
    assert rejected(parsed, "value").count() == 4


def test_separators_are_literal(spark):
    parsed = parse_delimited(lines(spark, "u|p|7"), schemas.CLICK, "|")
    assert accepted(parsed).first()["seconds"] == 7
    wide = parse_delimited(lines(spark, "u.*p.*7"), schemas.CLICK, ".*")
    assert accepted(wide).first()["page"] == "p"


@pytest.mark.parametrize("text,words", [
    ("a\tb\ta", ["a", "a", "b"]), ("a\t\tb\t\t", ["", "a", "b"]), ("", [""]), ("\t\t", []), (None, []),
])
@pytest.mark.parametrize("sep", ["\t", "--"])
def test_tokenise(spark, text, words, sep):
    df = lines(spark, text.replace("\t", sep) if text else text)
    assert sorted(r["word"] for r in tokenise(df, "value", sep).collect()) == words


def test_expand_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, -2)], "id int, cnt int")
    rows = project.expand_rows(df, "cnt", "drawn", key="id", seed=5).collect()
    assert [r["id"] for r in rows] == [1, 1, 1] and all(0 <= r["drawn"] < 3 for r in rows)
    assert rows == project.expand_rows(df, "cnt", "drawn", key="id", seed=5).collect()


def test_first_matching_route_wins(spark):
    df = spark.createDataFrame([("ABBA",), ("Bob",), ("xyz",), (None,)], "t string")
    routed = route.route(df, route.letter_rules("t"))
    assert [r["route"] for r in routed.collect()] == ["a", "b", "main", "main"]
    assert route.output(routed, "b").columns == ["t"]


def test_top_n_with_few_rows_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 5, 1), ("b", 5, 2), ("b", 9, 3)],
                               "k string, v int, arrival int")
    best = topn.top_n(df, ["k"], [F.desc("v"), F.col("arrival")], 2)
    assert sorted((r["k"], r["arrival"], r["rank"]) for r in best.collect()) == [
        ("a", 0, 1), ("b", 1, 2), ("b", 3, 1)]
    assert "WindowGroupLimit" in plan(best)


def test_dimension_last_update_wins_and_missing_key_is_null(spark):
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id int, city string, version int")
    events = spark.createDataFrame([(1,), (2,)], "id int")
    profile = joins.latest_per_key(updates, ["id"], "version").drop("version")
    assert {r["id"]: r["city"] for r in joins.lookup(events, profile, ["id"]).collect()} == {1: "y", 2: None}


def test_size_on_disk_decides_about_the_broadcast(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    dimension = stored(spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v")), "dim")
    assert "BroadcastHashJoin" in plan(joins.lookup(facts, dimension, ["k"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        joined = joins.lookup(facts, dimension, ["k"])
        assert "SortMergeJoin" in plan(joined) and joined.where("v = 'x'").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cogroup_counts_instead_of_writing_pairs(spark):
    rows = [("k", AT, i % 2) for i in range(200)]
    left = spark.createDataFrame(rows, "k string, ts timestamp_ntz, l int")
    right = spark.createDataFrame(rows, "k string, ts timestamp_ntz, r int")
    pairs = joins.cogroup_product(left, right, ["k"], "l", "r", "ts", "10 seconds")
    assert sorted((r["l"], r["r"], r["copies"]) for r in pairs.collect()) == [
        (a, b, 10_000) for a in (0, 1) for b in (0, 1)]


def test_window_join_needs_the_same_window(spark):
    left = spark.createDataFrame([("k", AT), ("k", AT + dt.timedelta(seconds=9))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([("k", AT + dt.timedelta(seconds=10), 1), ("k", AT, 2)],
                                  "k string, ts timestamp_ntz, r int")
    assert [r["r"] for r in joins.window_join(left, right, ["k"], "ts", "10 seconds").collect()] == [2, 2]


def test_sliding_windows_before_the_first_row(spark):
    df = spark.createDataFrame([(AT + dt.timedelta(seconds=7),)], "ts timestamp_ntz")
    found = windows.windowed(df, "ts", "30 seconds", "10 seconds", [], {"n": count_rows()})
    starts = sorted((r["window_start"] - AT).total_seconds() for r in found.collect())
    assert starts == [-20, -10, 0]


def test_narrow_overlap_is_refused(spark):
    with pytest.raises(ValueError):
        overlap.overlap_buckets(spark.range(1), "id", 10, after=11)


def test_bands_and_limits(spark):
    speeds = [120.0, 119.9, 90.0, 60.0, 59.9]
    df = spark.createDataFrame([("a", "r", "m", AT, "c", s) for s in speeds],
                               "area_id string, road_id string, monitor_id string,"
                               "action_time timestamp_ntz, car string, speed double")
    row = traffic.band_counts(df).first()
    assert [row[b] for b in traffic.BANDS] == [1, 2, 1, 1]
    none = spark.createDataFrame([], schemas.SPEED_LIMIT)
    assert sorted(r["real_speed"] for r in traffic.speeding_records(df, none).collect()) == [90.0, 119.9, 120.0]
    high = spark.createDataFrame([("a", "r", "m", 100.0)], schemas.SPEED_LIMIT)
    assert traffic.speeding_records(df, high).count() == 0, "exactly 1.2 times is allowed"


def test_times(spark):
    assert duration_micros("5 minutes") == 300_000_000 and duration_micros("1 day") == 86_400_000_000
    text = spark.range(1).select(time_text(F.timestamp_millis(F.lit(1704067261999))).alias("t"))
    assert text.first()["t"] == "2024-01-01 00:01:01"


# --- connectors -------------------------------------------------------------

def test_kafka_options(spark):
    options = kafka.source_options("h:1", "t", "g", start="earliest", max_offsets_per_trigger=5)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
                       "kafka.group.id": "g", "maxOffsetsPerTrigger": "5"}
    assert kafka.source_options("h:1", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.source_options("h:1", "t", start="middle")
    assert kafka.sink_options("h:1", "t")["kafka.batch.size"] == "16384"
    records = spark.createDataFrame([(bytearray(b"a\tb"), 0, 7), (bytearray(b"c"), 1, 7)],
                                    "value binary, partition int, offset long")
    found = kafka.lines(records).collect()
    assert [tuple(r)[:3] for r in found] == [("a\tb", 0, 7), ("c", 1, 7)]
    assert found[0]["arrival"] != found[1]["arrival"], "offsets repeat in every partition"
    df = spark.createDataFrame([("a", None, 1.5)], "x string, y int, z double")
    assert kafka.as_lines(df, ["x", "y", "z"]).first()["value"] == "a\t\t1.5"


def test_jdbc_options():
    options = jdbc.scan_options("jdbc:x:y", "limits", driver="d.D", partition_column="id", low=0,
                                high=9, partitions=3, user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "3"
    assert options["driver"] == "d.D" and options["user"] == "u" and options["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x:y", "limits", partition_column="id")


def test_refreshed_table(spark, tmp_path):
    now, loads = [0.0], []

    def load():
        loads.append(1)
        return spark.createDataFrame([(len(loads),)], "version int")

    limits = jdbc.RefreshedTable(load, str(tmp_path), max_age_seconds=30, clock=lambda: now[0])
    assert limits.get().first()["version"] == 1
    now[0] = 29.9
    assert limits.get().first()["version"] == 1 and len(loads) == 1
    now[0] = 30
    assert limits.get().first()["version"] == 2


def test_append_once_after_a_half_written_batch(spark, tmp_path):
    sink, schema = str(tmp_path / "sink"), "id int, v string, batch_id long"
    spark.createDataFrame([(1, "a", 7), (1, "old", 6)], schema).write.parquet(sink)
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    for _ in range(2):
        jdbc.append_once(batch, 7, ["id"], lambda: spark.read.schema(schema).parquet(sink),
                         lambda rows: rows.write.mode("append").parquet(sink))
    rows = spark.read.parquet(sink).collect()
    assert sorted((r["id"], r["batch_id"]) for r in rows) == [(1, 6), (1, 7), (2, 7)]


def test_append_once_keeps_every_row_of_a_repeated_batch(spark, tmp_path):
    """Two partitions with the same offset; one row was written before the first try failed."""
    sink, schema = str(tmp_path / "sink"), "offset long, partition int, batch_id long"
    spark.createDataFrame([(7, 0, 3)], schema).write.parquet(sink)
    batch = spark.createDataFrame([(7, 0), (7, 1), (8, 0)], "offset long, partition int")

    def append(key):
        jdbc.append_once(batch, 3, key, lambda: spark.read.schema(schema).parquet(sink),
                         lambda rows: rows.write.mode("append").parquet(sink))

    with pytest.raises(ValueError, match="not unique"):
        append(["offset"])
    append(["partition", "offset"])
    append(["partition", "offset"])
    rows = spark.read.parquet(sink).collect()
    assert sorted((r["offset"], r["partition"]) for r in rows) == [(7, 0), (7, 1), (8, 0)]


def test_last_limit_of_a_monitor_wins(spark, tmp_path):
    rows = spark.createDataFrame([("a", 50.0, 1), ("a", 70.0, 2), ("b", 60.0, 1)], "m string, lim double, v int")
    by_version = jdbc.RefreshedTable(lambda: rows, str(tmp_path / "v"), keys=["m"], order="v")
    by_place = jdbc.RefreshedTable(lambda: rows.coalesce(1).drop("v"), str(tmp_path / "p"), keys=["m"])
    assert sorted(map(tuple, by_version.get().collect())) == [("a", 70.0, 2), ("b", 60.0, 1)]
    assert sorted(map(tuple, by_place.get().collect())) == [("a", 70.0), ("b", 60.0)]
    with pytest.raises(ValueError):
        jdbc.RefreshedTable(lambda: rows.repartition(3), str(tmp_path / "n"), keys=["m"]).get()


def test_sink_record_fits_its_table(spark):
    row = ("c", "0001", "r", 90.0, 60.0, dt.datetime(2024, 1, 1, 0, 0, 1), 5)
    records = spark.createDataFrame([row], "car string, monitor_id string, road_id string, "
                                    "real_speed double, limit_speed double, action_time timestamp_ntz, arrival long")
    record = traffic.sink_record(records)
    assert [(f.name, f.dataType) for f in record.schema] == [
        (f.name, f.dataType) for f in schemas.SPEEDING_RECORD]
    assert record.first()["action_time"] == 1_704_067_201_000
    assert traffic.sink_record(records, "arrival").columns[-1] == "arrival"


def test_jdbc_writer(spark, monkeypatch):
    """The database is replaced by a list: none may be started here."""
    inserted = []
    monkeypatch.setattr(jdbc, "append", lambda df, options: inserted.append(sorted(map(tuple, df.collect()))))
    held = spark.createDataFrame([(1, 5)], "id int, batch_id long")
    monkeypatch.setattr(jdbc, "read", lambda session, options: held)
    batch = spark.createDataFrame([(1,), (2,)], "id int")
    jdbc.writer({})(batch, 5)
    jdbc.writer({}, ["id"])(batch, 5)
    jdbc.writer({}, ["id"])(batch, 6)
    assert inserted == [[(1,), (2,)], [(2, 5)], [(1, 6), (2, 6)]]


def test_process_opens_and_closes_around_a_partition(spark, tmp_path):
    from roadwatch.operators.process import per_partition, without_accents
    df = spark.createDataFrame([(1, "éà ß Ñü"), (2, None), (3, "")], "id long, t string")
    assert sorted((r["id"], r["plain"]) for r in without_accents(df, "id", "t").collect()) == [
        (1, "ea ß Nu"), (2, None), (3, "")]
    log = str(tmp_path)

    def note(name):
        import uuid
        open(f"{log}/{name}-{uuid.uuid4().hex}", "w").close()

    df = spark.range(10).repartition(3)
    rows = per_partition(df, "id long", lambda: note("open"), lambda r, b: b, lambda r: note("close"))
    assert rows.count() == 10
    names = sorted(p.name.split("-")[0] for p in tmp_path.iterdir())
    assert names.count("open") == names.count("close") >= 1


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ty\nz\n")
    assert [r["value"] for r in files.text_lines(spark, str(tmp_path)).collect()] == ["x\ty", "z"]


def test_shared_folder_comes_from_the_session(spark):
    class Session:
        class conf:
            values = {"spark.checkpoint.dir": "hdfs:///shared/"}

            @classmethod
            def get(cls, key, default):
                return cls.values.get(key, default)

        class sparkContext:
            master = "spark://host:7077"

    assert session.shared_dir(Session) == "hdfs:///shared"
    Session.conf.values = {}
    with pytest.raises(ValueError):
        session.shared_dir(Session)
    assert session.run_dir(spark, "x") != session.run_dir(spark, "x")


def test_accents_of_all_code_points(spark):
    import duckdb
    from roadwatch.operators.process import without_accents
    texts = ["Tiếng Việt", "Tiếng Việt", "한 한", "plain", None]
    texts += ["".join(map(chr, range(low, low + 64))) for low in range(0x40, 0x3400, 64)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    con = duckdb.connect()
    want = [con.execute("SELECT strip_accents(?::VARCHAR)", [t]).fetchone()[0] for t in texts]
    assert want[0] == want[1] == "Tieng Viet"
    rows = without_accents(df, "id", "t").orderBy("id").collect()
    assert [(texts[r["id"]], r["plain"], want[r["id"]]) for r in rows if r["plain"] != want[r["id"]]] == []
