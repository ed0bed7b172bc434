"""Nearest neighbours against brute force, and models on a planted signal."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import vectors as op
from millrace.plans.vectors import planted_vectors


def clustered(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8)) * 5
    label = rng.integers(0, 6, n)
    vec = (centres[label] + rng.normal(size=(n, 8)) * 0.5).astype(np.float32)
    vec[:copies] = vec[0]  # a group of copies
    label[:copies] = label[0]
    return vec, label


def brute(train, test, k):
    tv, tl = train
    out = []
    for q in test[0].astype(np.float64):
        d = np.round(np.sqrt(((tv.astype(np.float64) - q) ** 2).sum(1)), 9)
        out.append(sorted(range(len(tv)), key=lambda i: (d[i], i))[:k])
    return out


def frames(spark, train, test):
    a = spark.createDataFrame(
        [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(*train))], "id bigint, vec array<float>, label int"
    )
    b = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(test[0])], "id bigint, vec array<float>")
    return a, b


@pytest.mark.parametrize("pivots,block", [(64, 4096), (5, 20), (16, 7), (1, 50)])
@pytest.mark.parametrize("copies", [0, 60])
def test_nearest_is_exact(spark, pivots, block, copies):
    train, test = clustered(180, 1, copies), clustered(40, 1, 5)
    a, b = frames(spark, train, test)
    got = {}
    for r in op.nearest(a, b, 4, pivots, block).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"]))
    want = brute(train, test, 4)
    assert len(got) == 40
    assert all([o for _, o in sorted(got[i])] == want[i] for i in range(40))


@pytest.mark.parametrize("copies", [0, 30])
def test_each_row_judged_by_the_others(spark, copies):
    vec, label = clustered(90, 5, copies)
    a, _ = frames(spark, (vec, label), clustered(1, 5))
    got = {r["id"]: (r["prediction"], r["votes"]) for r in op.knn_vote(a, None, 3, 8, 16).collect()}
    order = brute((vec, label), (vec, label), 90)
    for i in range(90):
        near = [int(label[j]) for j in order[i] if j != i][:3]
        best = min(set(near), key=lambda c: (-near.count(c), c))
        assert got[i] == (best, near.count(best))


def test_test_rows_visit_a_falling_share_of_the_groups(spark):
    """Cells grow with the rows, so the bound from a row's own cell leaves out more of them."""
    shares = []
    for n in (300, 9000):
        train, test = clustered(n, 11), clustered(60, 12)
        a, b = frames(spark, (train[0], train[1]), (train[0][:60] + 0.01, train[1][:60]))
        cells = op._Cells(a, 2 * math.isqrt(n), 50)
        first = op._block_search(cells.first(b), cells.train, 3, 50)
        kth = first.groupBy("id").agg(F.max("distance").alias("found"))
        visits = cells.visits(b.join(kth, "id", "left"), 3).count()
        shares.append((visits + 60) / 60 / cells.groups)
    assert shares[1] < shares[0] and shares[1] < 0.25


def test_cells_grow_with_rows():
    counts = [op.cell_count(n, 64) for n in (100, 10_000, 10**6, 10**8)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[2] == 1000 and counts[3] == 10_000


def test_fewer_training_rows_than_k(spark):
    train, test = clustered(3, 2), clustered(10, 3)
    found = op.nearest(*frames(spark, train, test), 5)
    assert found.count() == 30


def test_lsh_finds_most_neighbours(spark):
    train, test = clustered(300, 6), clustered(60, 6)
    a, b = frames(spark, train, test)
    exact = {r["id"]: r["prediction"] for r in op.knn_vote(a, b, 5).collect()}
    close = {r["id"]: r["prediction"] for r in op.knn_lsh(a, b, 5, width=2.0).collect()}
    assert len(close) >= 55
    assert np.mean([exact[i] == p for i, p in close.items()]) > 0.9


def test_many_centroids_take_the_other_way(spark):
    train, _ = clustered(120, 8)
    a, _ = frames(spark, clustered(120, 8), clustered(1, 8))
    cents = op.centroids(a, "label", "vec")
    few = op.nearest_centroid(a, cents, "vec", "id").select("id", "prediction")
    many = op.nearest_centroid(a, cents, "vec", "id", limit=2).select("id", "prediction")
    assert sorted(few.collect()) == sorted(many.collect())


def test_text_labels_and_repeated_ids_above_the_limit(spark):
    df = spark.createDataFrame([(1, [0.1, 0.0], "a"), (1, [5.0, 5.0], "b"), (2, [0.0, 0.2], "a")], "id int, vec array<float>, label string")
    cents = op.centroids(df, "label", "vec")
    few, many = (op.nearest_centroid(df, cents, "vec", "id", **k) for k in ({}, {"limit": 1}))
    assert few.columns == many.columns
    assert sorted(few.collect()) == sorted(many.collect())
    assert few.filter("label != prediction").isEmpty()


def test_zero_vector_is_kept(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "id int, v array<float>")
    assert [r["unit"] for r in op.normalise(df, "v").orderBy("id").collect()] == [[0.0, 0.0], [0.6, 0.8]]


@pytest.mark.parametrize("kind,params", [("logistic", {"maxIter": 20}), ("forest", {}), ("perceptron", {"layers": [64, 10]})])
def test_models_learn_the_planted_classes(tables, kind, params):
    rows = planted_vectors(tables)
    train, test = rows.filter("NOT held_out"), rows.filter("held_out")
    pred = op.predict(op.fit_multiclass(train, kind, **params), test)
    share = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert share > 0.9


def test_class_report(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    rows = {r["class"]: r for r in op.class_report(pred).collect()}
    assert rows[1]["precision"] == pytest.approx(1 / 3) and rows[1]["recall"] == 1.0
    assert rows[2]["precision"] is None and rows[2]["recall"] == 0.0 and rows[2]["f1"] == 0.0


@pytest.mark.parametrize("numbers", [4_000_000, 400])
def test_rounds_find_what_blocks_find(spark, monkeypatch, numbers):
    train, test = clustered(180, 21, 9), clustered(70, 22)
    a, b = frames(spark, train, test)
    found = []
    for moved in (10**9, 0):
        monkeypatch.setattr(op, "MOVED", moved)
        monkeypatch.setattr(op, "ROUND_NUMBERS", numbers)
        monkeypatch.setattr(op, "DISTANCES", 50)
        monkeypatch.setattr(op, "ROWS", 20)
        rows = [
            op.nearest(a, b, 4, 16, 7), op.knn_vote(a, None, 3, 16, 7), op.knn_lsh(a, b, 4, 6.0, 3, 10), op.knn_lsh(a, None, 4, 6.0, 3, 10),
            op.knn_vote(a.unionAll(a), b, 3, 16, 7), op.knn_lsh(a.unionAll(a), b, 4, 6.0, 3, 10),
        ]
        found.append([sorted(tuple(r.asDict().items()) for r in x.collect()) for x in rows])
    assert found[0] == found[1] and all(found[0])


@pytest.mark.parametrize("name", ["knn_vote", "knn_lsh"])
def test_vectors_are_not_moved_to_each_other(spark, name):
    from test_recommend import shuffled

    rng = np.random.default_rng(3)
    vec = rng.normal(size=(3000, 32)).astype(np.float32)
    rows = op.stage(spark.createDataFrame([(i, v.tolist(), i % 7) for i, v in enumerate(vec)], "id bigint, vec array<float>, label int"))
    before = shuffled(spark)
    jobs = {"knn_vote": lambda: op.knn_vote(rows, None, 5, 60, 64), "knn_lsh": lambda: op.knn_lsh(rows, None, 5, 4.0, 4, 64)}
    assert jobs[name]().count() > 0
    assert shuffled(spark) - before < 24 * vec.nbytes
