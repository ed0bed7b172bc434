"""Model checking, features and models: properties and planted signals."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import binary, features, lifetime, predict, series
from millrace.plans import all_queries
from millrace.plans.binary import planted_binary
from millrace.plans.lifetime import planted_lives
from millrace.plans.predict import X, planted_linear, split
from shared import SMALL


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, int(i % 7 in (0, 3) or i > 60), float((i * 37) % 23)) for i in range(90)]
    return spark.createDataFrame(rows, "id bigint, label int, score double").cache()


def brute_auc(rows):
    pos = [r["score"] for r in rows if r["label"] == 1]
    neg = [r["score"] for r in rows if r["label"] == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)


@pytest.mark.parametrize("task", [5, 5_000_000])
def test_auc(scored, task):
    a = binary.auc(scored, rows_per_task=task).first()["auc"]
    assert a == pytest.approx(brute_auc(scored.collect()))
    turned = binary.auc(scored.withColumn("score", -F.col("score")), rows_per_task=task).first()["auc"]
    assert turned == pytest.approx(1 - a)


def test_all_scores_equal_and_one_class(spark):
    same = spark.createDataFrame([(0, 1.0), (1, 1.0), (1, 1.0)], "label int, score double")
    assert binary.auc(same).first()["auc"] == 0.5
    assert binary.ks(same).first()["ks"] == 0.0
    one = spark.createDataFrame([(1, 1.0), (1, 2.0)], "label int, score double")
    assert binary.auc(one).first()["auc"] is None
    assert binary.auc(one.limit(0)).first()["auc"] is None


@pytest.mark.parametrize("task", [6, 5_000_000])
def test_lift_groups_are_even_with_heavy_ties(spark, task):
    rows = [(i, i % 2, 1.0 if i < 70 else float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, label int, score double")
    got = {r["bucket"]: (r["n"], r["positives"]) for r in binary.lift(df, 10, "id", task).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {b + 1: (10, sum(r[1] for r in order[b * 10 : b * 10 + 10])) for b in range(10)}


@pytest.mark.parametrize("task", [10, 5_000_000])
def test_folds_cover_evenly(spark, scored, task):
    out = binary.folds(scored, "id", 4, "label", rows_per_task=task)
    assert out.count() == 90 and out.select("id").distinct().count() == 90
    sizes = out.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        n = [r["count"] for r in sizes if r["label"] == label]
        assert len(n) == 4 and max(n) - min(n) <= 1


def test_psi_of_equal_samples_is_zero(spark):
    df = spark.range(100).select((F.col("id") % 10).cast("double").alias("x"))
    assert binary.psi(df, df, "x", [2.0, 5.0]).first()["psi"] == pytest.approx(0)
    assert binary.psi(df, df.filter("x < 2"), "x", [2.0, 5.0]).first()["psi"] > 1


def test_weights_recover_balance(tables):
    rows = planted_binary(tables)
    w = binary.class_weights(rows)
    assert w.agg(F.sum(F.col("n") * F.col("weight"))).first()[0] == pytest.approx(rows.count())
    joined = rows.join(w.select("label", "weight"), "label")
    plain = binary.fit_binary(rows, ["x1", "x2"])
    even = binary.fit_binary(joined, ["x1", "x2"], weight="weight")
    assert even.intercept > plain.intercept + 1
    assert plain.coefficients[0] == pytest.approx(4, abs=2.5)


@pytest.mark.parametrize("kind", ["logistic", "forest", "boosted"])
def test_classifiers_beat_chance(spark, kind):
    row = all_queries()[f"p04_{kind}_classifier"].build(spark, SMALL.replace("0.001", "0.01")).first()
    assert row["positives"] > 50 and row["above_chance"]


def test_linear_coefficients(tables):
    rows = planted_linear(tables)
    model = predict.fit_linear(rows, X, "y")
    assert list(model.coefficients) == pytest.approx([3, -2, 0.5], abs=0.02)
    assert model.intercept == pytest.approx(10, abs=0.1)
    shrunk = predict.fit_linear(rows, X, "y", reg=5.0, l1=1.0)
    assert sum(abs(c) for c in shrunk.coefficients) < 5.5


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_trees_beat_the_mean(tables, kind):
    train, test = split(planted_linear(tables))
    model = predict.fit_trees(train, X, "y", kind)
    ours = predict.regression_report(predict.apply(model, test, X), "y", "prediction").first()
    flat = predict.regression_report(predict.mean_baseline(train, test, "y", ["x3"]), "y", "prediction").first()
    assert ours["rmse"] < 0.5 * flat["rmse"] and ours["n"] == flat["n"]


def test_tuning_prefers_no_penalty(spark):
    rows = {r["reg"]: r["place"] for r in all_queries()["p07_tune"].build(spark, SMALL).collect()}
    assert rows == {0.0: 1, 0.1: 2, 1.0: 3}


def test_forecast_beats_seasonal_naive(spark):
    rows = all_queries()["s14_forecast"].build(spark, SMALL.replace("0.001", "0.01")).collect()
    assert len(rows) == 3 and all(r["regression_better"] and r["trees_better"] and r["ahead_better"] for r in rows)


def test_lifetime_model(tables):
    rows = planted_lives(tables)
    m = lifetime.fit_lifetime(rows, ["x1"], "t", "died")
    assert m.intercept == pytest.approx(2, abs=0.1)
    assert m.coefficients[0] == pytest.approx(1.5, abs=0.15)
    assert m.scale == pytest.approx(0.5, abs=0.05)


def test_survival_by_hand_and_when_all_die(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (4, 1)], "t int, died int")
    got = [(r["t"], r["at_risk"], round(r["survival"], 9)) for r in lifetime.survival(df, "t", "died").orderBy("t").collect()]
    assert got == [(1, 4, 0.75), (2, 3, 0.5), (4, 1, 0.0)]


def test_sessions_split_on_the_exact_gap(spark):
    from datetime import datetime as dt

    rows = [(1, dt(2024, 1, 1, h, m)) for h, m in ((0, 0), (0, 59), (1, 59), (2, 58), (9, 0))] + [(2, dt(2024, 1, 1, 0, 0))]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz")
    got = sorted((r["u"], r["session"], r["n_events"]) for r in lifetime.sessions(df, ["u"], "ts", 3600).collect())
    assert got == [(1, 1, 2), (1, 2, 2), (1, 3, 1), (2, 1, 1)]


def test_asof_takes_the_same_instant_and_breaks_ties(spark):
    from datetime import datetime as dt

    a = spark.createDataFrame([(1, dt(2024, 1, 1)), (1, dt(2024, 1, 3)), (2, dt(2024, 1, 3))], "k int, ts timestamp_ntz")
    b = spark.createDataFrame(
        [(1, dt(2024, 1, 1), 10), (1, dt(2024, 1, 2), 11), (1, dt(2024, 1, 2), 12), (1, dt(2024, 1, 4), 13)],
        "k int, ts timestamp_ntz, v int",
    )
    out = series.asof(a, b, ["k"], "ts", {"v": "found"}, ["v"])
    assert [(r["k"], r["found"]) for r in out.orderBy("k", "ts").collect()] == [(1, 10), (1, 12), (2, None)]
    assert series.asof(a, b, ["k"], "ts", {"v": "found"}, ["v"], how="inner").count() == 2


def test_time_split_has_no_leak(tables):
    rows = series.time_split(tables("events"), "ts", ["2024-01-10", "2024-01-20"])
    ends = {(r["fold"], r["role"]): (r["lo"], r["hi"]) for r in rows.groupBy("fold", "role").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    for f in (0, 1):
        assert ends[f, "train"][1] < ends[f, "test"][0]
    assert rows.filter("fold = 1").count() == tables("events").count()


def test_impute_and_scale_edge_cases(spark):
    df = spark.createDataFrame([(1, None), (1, 4.0), (2, None), (None, 6.0), (None, None)], "g int, x double")
    got = features.impute_by(df, ["g"], "x").orderBy("g", "x").collect()
    assert [(r["g"], r["x"], r["x_missing"]) for r in got] == [
        (None, 6.0, False), (None, 6.0, True), (1, 4.0, False), (1, 4.0, True), (2, None, True)
    ] or {(r["g"], r["x"], r["x_missing"]) for r in got} == {
        (None, 6.0, False), (None, 6.0, True), (1, 4.0, False), (1, 4.0, True), (2, None, True)
    }
    med = features.impute(df, {"x": "median"}).filter("x_missing").select("x").distinct().collect()
    assert [r["x"] for r in med] == [5.0]
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    for kind in ("standard", "minmax", "robust"):
        assert [r["x"] for r in features.scale(flat, ["x"], kind).collect()] == [None, None]


def test_bins_edges_and_nulls(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (1.5,), (9.0,)], "x double")
    assert [r["bin"] for r in features.bin(df, "x", [1.0, 2.0]).collect()] == [None, 0, 1, 1, 2]


def test_target_encoding_uses_other_folds_only(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("b", 0, 5.0)], "c string, f int, y double")
    got = {(r["c"], r["f"]): r["encoded"] for r in features.target_encode(df, "c", "y", 1.0, "f").collect()}
    # fold 0: others are (a, 3) with prior 3; fold 1: others are (a, 1), (b, 5) with prior 3
    assert got == {("a", 0): (3 + 3) / 2, ("a", 1): (1 + 3) / 2, ("b", 0): 3.0}


def test_log_target_and_back(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,)], "y double")
    back = features.unlog_target(features.log_target(df, "y"), "log_y", "z").collect()
    assert back[0]["z"] == 0 and back[1]["z"] == pytest.approx(10) and back[2]["z"] is None


def test_category_index_with_many_ties(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "a", "c", "c", None]], "w string")
    assert {r["w"]: r["index"] for r in features.category_index(df, "w").collect()} == {"c": 0, "a": 1, "b": 2}
    assert features.index_category(df, "w").count() == 5


def test_ewm_by_hand(spark):
    from datetime import datetime as dt

    df = spark.createDataFrame([(1, dt(2024, 1, d), v) for d, v in ((1, 1.0), (2, None), (3, 3.0))], "k int, ts timestamp_ntz, y double")
    got = [r["ewm"] for r in series.ewm(df, ["k"], "ts", "y", 0.5, 2).orderBy("ts").collect()]
    assert got == [1.0, 1.0, 3.0]
    assert math.isclose(series.ewm(df, ["k"], "ts", "y", 0.5, 3).orderBy("ts").collect()[2]["ewm"], (3 + 0.25) / 1.25)
