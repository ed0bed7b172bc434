"""Splitting hot keys must not change any result."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import features, lifetime, ordered, series, tables

HOT = 40  # rows per task that make the busy keys of the fixture hot


def rows_of(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


@pytest.fixture(scope="module")
def log(spark):
    """A third of the rows belong to unit 0; unit None and unit 9 hold one row each."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows, used = [], set()
    for i in range(900):
        unit = 0 if i % 3 == 0 else rng.choice([1, 2, 3, 4, 5, 6, 7, 8])
        minute = rng.randrange(40_000)
        while (unit, minute) in used:
            minute += 1
        used.add((unit, minute))
        value = None if rng.random() < 0.3 else round(rng.uniform(0, 9), 1)
        rows.append((i, unit, start + timedelta(minutes=minute), value, rng.choice(["ok", "error", "idle"])))
    rows += [(900, None, start, 1.0, "ok"), (901, 9, start, None, "ok")]
    schema = "id bigint, unit bigint, ts timestamp_ntz, value double, state string"
    return spark.createDataFrame(rows, schema).repartition(7).cache()


def test_only_heavy_keys_are_cut(log):
    lay = ordered.lay_out(log, ["unit"], ["ts"], HOT)
    cut = {r["unit"] for r in lay.df.filter(F.col(ordered.CHUNK) >= 0).select("unit").distinct().collect()}
    heavy = {r["unit"] for r in log.groupBy("unit").count().filter(F.col("count") > HOT).collect()}
    assert lay.split and cut == heavy and 0 in cut and None not in cut and 9 not in cut
    assert lay.df.filter("unit = 0").groupBy(ordered.CHUNK).count().agg(F.max("count")).first()[0] <= 4 * HOT
    assert not ordered.lay_out(log, ["unit"], ["ts"]).split


ORDERS = {
    "date": "date_add(DATE'2024-01-01', int(id)) AS o",
    "long_prefix": "concat('https://www.example.org/', lpad(id, 9, '0')) AS o",
    "one_value": "1 AS o",
    "infinite": "CASE WHEN id < 600 THEN double('-inf') ELSE double(id) END AS o",
    "null": "CASE WHEN id >= 600 THEN id END AS o",
}


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("by", [[], ["k"]])
def test_any_order_column_is_cut(spark, order, by):
    rows = spark.range(2000).selectExpr("id", ORDERS[order], "1 AS k")
    lay = ordered.lay_out(rows, by, ["o", "id"], 100)
    assert lay.split and lay.df.groupBy(*lay.parts).count().agg(F.max("count")).first()[0] <= 200
    out = ordered.running(rows, by, ["o", "id"], {"n": F.lit(1)}, rows_per_task=100)
    # NULLs come first.
    assert [r["n"] for r in out.orderBy("o", "id").collect()] == list(range(1, 2001))


def test_every_hot_key_is_cut(spark):
    rows = spark.range(240).selectExpr("id", "id % 60 AS k")
    lay = ordered.lay_out(rows, ["k"], ["id"], 3)
    assert lay.df.filter(F.col(ordered.CHUNK) < 0).isEmpty()
    out = ordered.running(rows, ["k"], ["id"], {"n": F.lit(1)}, {"all": F.lit(1)}, rows_per_task=3)
    assert out.filter("n != id div 60 + 1 OR `all` != 4").isEmpty() and out.count() == 240


JOBS = {
    "running": lambda d, **k: ordered.running(
        d, ["unit"], ["ts", "id"], {"s": F.col("value"), "n": F.lit(1)}, {"all": F.lit(1)}, **k
    ),
    "running_before": lambda d, **k: ordered.running(
        d, ["unit"], ["ts", "id"], {"n": F.lit(1)}, include_current=False, **k
    ),
    "carried": lambda d, **k: ordered.carried(
        d, ["unit"], ["ts", "id"], {"past": F.col("value")}, {"next": F.col("value")}, **k
    ),
    "quantiles": lambda d, **k: ordered.quantiles(d, ["unit"], "value", {"a": 0.1, "b": 0.5}, **k),
    "position": lambda d, **k: ordered.global_position(d, "unit", "id", "at", "n", **k),
    "ranked": lambda d, **k: tables.ranked(d, ["unit"], "value", "id", 4, **k),
    "lags": lambda d, **k: series.lags(d, ["unit"], "ts", "value", [1, 5], [1, 3], **k),
    "rolling": lambda d, **k: series.rolling(d, ["unit"], ["ts", "id"], "value", 11, **k),
    "rolling_time": lambda d, **k: series.rolling_time(d, ["unit"], "ts", "value", 86400, **k),
    "rolling_long_time": lambda d, **k: series.rolling_time(d, ["unit"], "ts", "value", 12 * 86400, **k),
    "fill_forward": lambda d, **k: series.fill(d, ["unit"], "ts", "value", "forward", **k),
    "fill_linear": lambda d, **k: series.fill(d, ["unit"], "ts", "value", "linear", **k),
    "ewm": lambda d, **k: series.ewm(d, ["unit"], "ts", "value", 0.4, 6, **k),
    "acf": lambda d, **k: series.acf(d, ["unit"], "ts", "value", [1, 2], **k),
    "naive": lambda d, **k: series.naive(d, ["unit"], "ts", "value", 24, **k),
    "episodes": lambda d, **k: series.episodes(d, ["unit"], "ts", "value", 4.0, 7200, **k),
    "asof": lambda d, **k: series.asof(
        d.filter("state = 'ok'"), d.filter("state = 'error'"), ["unit"], "ts", {"id": "other", "ts": "at"}, ["id"], **k
    ),
    "history": lambda d, **k: features.history_mean(d, ["unit"], ["ts", "id"], "value", **k),
    "state_time": lambda d, **k: lifetime.state_time(d, ["unit"], ["ts", "id"], "state", **k),
    "remaining": lambda d, **k: lifetime.remaining_life(d, ["unit"], ["ts", "id"], F.col("state") == "error", **k),
}


@pytest.mark.parametrize("job", JOBS)
def test_splitting_changes_nothing(log, job):
    whole, cut = JOBS[job](log), JOBS[job](log, rows_per_task=HOT)
    assert whole.columns == cut.columns
    assert rows_of(whole) == rows_of(cut)


@pytest.mark.parametrize("job", ["running", "lags", "ranked", "carried"])
def test_partitioning_changes_nothing(log, job):
    found = [rows_of(JOBS[job](log.repartition(n), rows_per_task=HOT)) for n in (1, 7, 31)]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("job", JOBS)
def test_empty_input(log, job):
    assert JOBS[job](log.limit(0)).collect() == []


def test_global_order_is_never_one_task_over_rows(log):
    out = ordered.running(log, [], ["ts", "id"], {"n": F.lit(1)})
    assert [r["n"] for r in out.orderBy("ts", "id").collect()] == list(range(1, 903))
    plan = out._jdf.queryExecution().executedPlan().toString()
    over_rows = [l for l in plan.splitlines() if "Window" in l and "_chunk" not in l]
    assert not over_rows


def test_string_positions_keep_the_order(spark):
    words = ["", "a", "ab", "abcdefgh", "abcdefgi", "b", "Ä", "zz", "zzzzzzzzz", "日本"]
    df = spark.createDataFrame([(w, 1) for w in words] * 20, "w string, n int")
    out = ordered.global_position(df.withColumn("g", F.lit(1)), "g", "w", "at", "n_all", rows_per_task=30)
    at = out.groupBy("w").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    want = {w: i * 20 for i, w in enumerate(sorted(words, key=lambda x: x.encode()))}
    assert all(r["lo"] == want[r["w"]] and r["hi"] == want[r["w"]] + 19 for r in at)


@pytest.mark.parametrize("task", [HOT, 5_000_000])
def test_rolling_time_equals_a_range_frame(log, task):
    rows = log.unionByName(log.limit(1).selectExpr("990L AS id", "0L AS unit", "CAST(NULL AS timestamp_ntz) AS ts", "2D AS value", "state"))
    for seconds in (60, 7200, 900_000):
        over = f"(PARTITION BY unit ORDER BY ts RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)"
        want = rows.selectExpr("*", f"count(value) OVER {over} n", f"avg(value) OVER {over} a", f"stddev(value) OVER {over} s", f"min(value) OVER {over} l", f"max(value) OVER {over} m")
        assert rows_of(series.rolling_time(rows, ["unit"], "ts", "value", seconds, rows_per_task=task)) == rows_of(want)


def test_rolling_deviation_keeps_its_digits_at_a_high_level(log):
    rows = log.selectExpr("id", "unit", "ts", "value + 1e9 AS value", "value AS plain")
    high = {r["id"]: r["roll_std"] for r in series.rolling_time(rows, ["unit"], "ts", "value", 7200).collect()}
    low = {r["id"]: r["roll_std"] for r in series.rolling_time(rows, ["unit"], "ts", "plain", 7200).collect()}
    assert any(v for v in low.values()) and all(high[i] == pytest.approx(low[i], abs=1e-5) for i in low if low[i] is not None)


def test_episodes_without_a_key_are_cut(log):
    one = log.groupBy("ts").agg(F.max("value").alias("value"))
    got = series.episodes(one, [], "ts", "value", 4.0, 600, rows_per_task=None)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan
    rows = sorted((r["ts"], r["value"]) for r in one.collect() if r["value"] is not None and r["value"] > 4.0)
    runs = []
    for ts, v in rows:
        if runs and (ts - runs[-1][1]).total_seconds() <= 600:
            runs[-1] = (runs[-1][0], ts, runs[-1][2] + 1, max(runs[-1][3], v))
        else:
            runs.append((ts, ts, 1, v))
    assert sorted((r["start"], r["end"], r["n"], r["peak"]) for r in got.collect()) == runs


def test_quantiles_against_numpy(spark):
    import numpy as np

    values = [float(v) for v in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    row = ordered.quantiles(df, [], "v", {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert (row["a"], row["b"]) == tuple(np.quantile(values, [0.25, 0.5]))
    assert row["c"] == pytest.approx(np.quantile(values, 0.9))
    assert row["rows"] == 11 and row["distinct"] == 7
