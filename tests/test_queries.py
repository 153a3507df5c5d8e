"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry_points
import oracle
from roadwatch.plans.catalog import REGISTRY

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.fixture(scope="module")
def small_con():
    return oracle.connect("/root/testdata/sf0.001")


OWN = REGISTRY  # what stands without the training-data subpackage


def test_every_query_has_sql():
    assert set(OWN) <= set(QUERIES) and set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", [n for n in OWN if not n.startswith("stream_")])
def test_batch_query(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", [n for n in OWN if n.startswith("stream_")])
def test_stream_query(spark, small_con, name):
    result = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert oracle.differences(result, small_con, SQL[name]) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["window_start", "window_end", "area_id", "road_id", "monitor_id",
                              "avg_speed", "car_count"]
    assert result.count() > 0


def test_queries_do_not_depend_on_the_working_folder(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    result = QUERIES["stream_count_window"](spark, "/root/testdata/sf0.001")
    assert result.count() > 0 and os.getcwd() == str(tmp_path)
