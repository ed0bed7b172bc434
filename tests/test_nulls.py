"""Rows without times, keys or scores."""

import datetime as dt


from millrace.operators import binary, series, vectors
from millrace.sources import scratch_dir


def test_asof_ignores_readings_without_time_or_key(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    left = spark.createDataFrame([(1, at(5)), (None, at(5)), (1, None)], "k bigint, ts timestamp_ntz")
    right = spark.createDataFrame([(1, at(2), 10), (1, None, 99), (None, at(2), 98)], "k bigint, ts timestamp_ntz, v int")
    got = {(r.k, r.ts): r.found for r in series.asof(left, right, ["k"], "ts", {"v": "found"}).collect()}
    assert got == {(1, at(5)): 10, (None, at(5)): None, (1, None): None}


def test_curve_leaves_out_rows_without_score(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(0.9, 1), (0.5, 0), (None, 1), (-inf, 0), (-inf, 1)], "score double, label int")
    got = {r.score: (r.tp, r.fp) for r in binary.curve(rows, rows_per_task=1).collect()}
    assert got == {0.9: (1, 0), 0.5: (1, 1), -inf: (2, 2)}


def test_bands_do_not_move_the_rows(spark, tables):
    from millrace.plans import all_queries

    plan = all_queries()["t08_band"].build(spark, tables.folder if hasattr(tables, "folder") else "/root/testdata/sf0.001")
    assert "SortMergeJoin" not in plan._jdf.queryExecution().toString()


def test_vector_helpers_travel_by_value():
    from pyspark import cloudpickle

    assert vectors.__name__ in cloudpickle.list_registry_pickle_by_value()


def test_scratch_follows_the_setting(spark):
    assert scratch_dir(spark).startswith((spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/"))
