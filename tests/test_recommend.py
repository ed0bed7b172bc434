"""Similarity jobs against brute force, with a busy user, copies and ties."""

import math
import random
import time
from collections import defaultdict

import pytest

from millrace.operators import recommend as op


def make(seed, users=25, items=30, rows=260, busy=True, clones=True):
    rng = random.Random(seed)
    ix = {}
    for _ in range(rows):
        ix[rng.randrange(1, users), rng.randrange(items)] = float(rng.randint(1, 9))
    if busy:  # user 0 touched every item
        for i in range(items):
            ix[0, i] = float(rng.randint(1, 9))
    if clones:  # a third of all items with one and the same profile, and scaled copies
        for c in range(100, 100 + items // 2):
            for u, w in ((0, 2.0), (3, 4.0), (7, 2.0)):
                ix[u, c] = w * (1 + c % 3)
        for c in range(200, 206):
            ix[0, c] = float(c)
    return ix


def profiles(ix, axis):
    out = defaultdict(dict)
    for (u, i), w in ix.items():
        e, f = (i, u) if axis == "item" else (u, i)
        out[e][f] = w
    return out


def scores(ix, axis):
    p = profiles(ix, axis)
    norm = {e: math.sqrt(sum(w * w for w in v.values())) for e, v in p.items()}
    for a in p:
        for b in p:
            if a < b:
                shared = p[a].keys() & p[b].keys()
                if shared:
                    yield a, b, {
                        "count": len(shared),
                        "jaccard": len(shared) / len(p[a].keys() | p[b].keys()),
                        "cosine": sum(p[a][f] * p[b][f] for f in shared) / norm[a] / norm[b],
                    }


def rep_of(ix, axis, weighted):
    groups = defaultdict(list)
    for e, v in profiles(ix, axis).items():
        top = max(v.values())
        groups[tuple(sorted((f, w / top if weighted else 1) for f, w in v.items()))].append(e)
    return {e: min(g) for g in groups.values() for e in g}


def frame(spark, ix):
    return spark.createDataFrame([(u, i, w) for (u, i), w in ix.items()], "user bigint, item bigint, w double")


SETTINGS = [{}, {"LEAST_WORK": 0}, {"LEAST_WORK": 5, "WORK": 40, "TASKS": 3, "SEGMENT": 4, "CHUNK": 7, "DENSE": 100}, {"LEAST_WORK": 0, "WORK": 3, "TASKS": 3, "SEGMENT": 1, "CHUNK": 1, "DENSE": 1}]


@pytest.fixture(params=SETTINGS, ids=str)
def setting(request, monkeypatch):
    for name, value in request.param.items():
        monkeypatch.setattr(op, name, value)
    return request.param


@pytest.mark.parametrize("axis", ["item", "user"])
@pytest.mark.parametrize("measure,least", [("count", 2), ("count", 5), ("jaccard", 0.3), ("cosine", 0.35), ("cosine", 0.8)])
def test_pairs_are_exact(spark, axis, setting, measure, least):
    ix = make(least * 10 + len(axis))
    job = {"count": op.cooccur, "jaccard": op.jaccard, "cosine": op.cosine}[measure]
    rows = job(frame(spark, ix), least, entity=axis).collect()
    got = {(r["a"], r["b"]): r["score"] for r in rows}
    assert len(got) == len(rows)
    rep = rep_of(ix, axis, measure == "cosine")
    want = {
        (a, b): s[measure]
        for a, b, s in scores(ix, axis)
        if s[measure] >= least and rep[a] == a and (rep[b] == b or rep[b] == a)
    }
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    assert all(r["copy"] == (rep[r["b"]] == r["a"]) for r in rows)


@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_neighbours_are_complete_and_see_through_copies(spark, setting, k, sign):
    ix = {key: w if key[0] % 4 else sign * w for key, w in make(3).items()}
    got = defaultdict(list)
    for r in op.neighbours(frame(spark, ix), k).collect():
        got[r["item"]].append((r["rank"], r["other"]))
    both = defaultdict(list)
    for a, b, s in scores(ix, "item"):
        if s["cosine"] > 1e-9:
            both[a].append((-round(s["cosine"], 9), b))
            both[b].append((-round(s["cosine"], 9), a))
    want = {i: [o for _, o in sorted(v)[:k]] for i, v in both.items()}
    assert {i: [o for _, o in sorted(v)] for i, v in got.items()} == want


def test_only_wanted_pairs_become_rows(spark, tables):
    """Products are added up inside cells; what leaves a cell is a result."""
    from pyspark.sql import functions as F

    from millrace.plans import recommend as plan

    ix = plan.staged(tables)
    rows = op._profiles(ix, "item", op.copies(ix, "item", weighted=False), False)
    products = op._ordered(rows, "count").agg(F.sum("d")).first()[0]
    found = op._similar(rows, "count", 6)
    assert found.where("sum < 6").count() == 0 and 0 < found.count() < products / 10


def test_text_ids(spark):
    ix = frame(spark, make(5)).selectExpr("concat('u', user) AS user", "concat('i', item) AS item", "w")
    assert op.cosine(ix, 0.35).count() > 0 and op.neighbours(ix, 2).count() > 0


def test_recommend_and_eval(spark):
    ix = frame(spark, {(1, 1): 1.0, (1, 2): 2.0, (2, 1): 1.0, (2, 3): 1.0, (3, 2): 1.0, (3, 3): 1.0})
    near = spark.createDataFrame(
        [(1, 3, 0.5), (2, 3, 0.25), (1, 2, 0.9), (3, 1, 0.5), (3, 2, 0.5)], "item bigint, other bigint, score double"
    )
    recs = op.recommend(ix, near, 5)
    got = {(r["user"], r["item"]): r["score"] for r in recs.collect()}
    # user 1 has 1 and 2: item 3 by 0.5 * 1 + 0.25 * 2; user 2 has 1 and 3: item 2 by 0.9 + 0.5; user 3: item 1 by 0.5
    assert got == {(1, 3): 1.0, (2, 2): 1.4, (3, 1): 0.5}
    truth = spark.createDataFrame([(1, 3), (1, 9), (2, 7)], "user bigint, item bigint")
    row = op.rank_eval(recs, truth, 5).first()
    assert row["n_users"] == 2 and row["hit_rate"] == 0.5
    assert row["precision_at_k"] == pytest.approx(0.1) and row["recall_at_k"] == pytest.approx(0.25)


def test_sharing_one_feature_is_refused(spark):
    with pytest.raises(ValueError):
        op.cooccur(frame(spark, {(1, 1): 1.0}), 1)


def test_one_pair_and_no_pair(spark):
    assert op.cosine(frame(spark, {(1, 1): 1.0}), 0.5).collect() == []
    assert op.cosine(frame(spark, {}), 0.5).collect() == []


ROUNDS = [{"INDEX": 40}, {"INDEX": 40, "MANY": 6}, {"INDEX": 25, "MANY": 2, "LEAST_WORK": 0, "CHUNK": 50, "ROWS": 3, "BUCKETS": 64}, {"SPAN": 1, "INDEX": 60}]


@pytest.mark.parametrize("setting", ROUNDS, ids=str)
@pytest.mark.parametrize("measure,least", [("count", 2), ("jaccard", 0.3), ("cosine", 0.35)])
def test_pairs_of_rounds_and_of_long_entities_are_exact(spark, monkeypatch, setting, measure, least):
    for name, value in setting.items():
        monkeypatch.setattr(op, name, value)
    ix = make(77)
    job = {"count": op.cooccur, "jaccard": op.jaccard, "cosine": op.cosine}[measure]
    for axis in ("item", "user"):
        rows = [r for r in job(frame(spark, ix), least, entity=axis).collect() if not r["copy"]]
        rep = rep_of(ix, axis, measure == "cosine")
        want = {(a, b): s[measure] for a, b, s in scores(ix, axis) if s[measure] >= least and rep[a] == a and rep[b] == b}
        assert len(rows) == len(want)
        assert {(r["a"], r["b"]): r["score"] for r in rows} == pytest.approx(want)


@pytest.mark.parametrize("setting", ROUNDS, ids=str)
@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_neighbours_of_rounds_and_of_long_entities_are_complete(spark, monkeypatch, setting, sign):
    for name, value in setting.items():
        monkeypatch.setattr(op, name, value)
    test_neighbours_are_complete_and_see_through_copies(spark, setting, 3, sign)


def shuffled(spark):
    """Bytes written for shuffles so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


@pytest.fixture(scope="module")
def dense(spark):
    """400 users with 200 of 1,000 items each: about 16 million products of weights between items, 6.4 million between users."""
    rng = random.Random(1)
    rows = [(u, i, float(rng.randint(1, 50))) for u in range(400) for i in rng.sample(range(1000), 200)]
    return op.stage(spark.createDataFrame(rows, "user bigint, item bigint, w double"))


@pytest.mark.parametrize("name", ["cooccur", "jaccard", "cosine", "user_cosine", "neighbours"])
def test_products_are_not_shuffled(spark, monkeypatch, dense, name):
    """A product of two weights is formed where its pair is added up: shuffles grow with the interactions, not with the products."""
    jobs = {
        "cooccur": lambda: op.cooccur(dense, 40), "jaccard": lambda: op.jaccard(dense, 0.3), "cosine": lambda: op.cosine(dense, 0.4),
        "user_cosine": lambda: op.cosine(dense, 0.4, "user"), "neighbours": lambda: op.neighbours(dense, 5),
    }
    monkeypatch.setattr(op, "WORK", 200_000)
    before = shuffled(spark)
    jobs[name]().write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 5_000_000


def test_staging_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    manager = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b.toString() for b in _seq(manager().getAllBlocks()) if b.toString().startswith("shuffle_")}
    _seq = lambda s: [s.apply(i) for i in range(s.size())]
    before = files()
    rows = op.stage(spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.sum("id").alias("s")).repartition(3, "s"))
    for _ in range(50):  # files go in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and rows.count() == 5000


@pytest.mark.parametrize("setting", [{}, *ROUNDS[1:3]], ids=str)
@pytest.mark.parametrize("weight", [1.0, 4e-6, 7e11])
def test_recommendations_are_exact(spark, monkeypatch, setting, weight):
    """Against whole numbers of any length, with rows without weight, user or item, rows that repeat and lists that many share."""
    for name, value in setting.items():
        monkeypatch.setattr(op, name, value)
    rng = random.Random(9)
    rows = [(rng.randrange(9), rng.randrange(14), rng.choice([None, 1.0, -0.25, 0.5, 0.999999])) for _ in range(60)]
    rows = [(u, i, w if w is None else w * weight) for u, i, w in rows] + [(None, 3, 1.0), (2, None, 1.0), (5, 13, None)]
    near = [(i, o, rng.choice([0.5, 1 / 3, 1e-12, 0.0])) for i in range(16) for o in rng.sample(range(14), 4) if i != o] + [(1, 2, 0.5), (13, 50, 0.5)]
    want, seen = {}, {(u, i) for u, i, _ in rows if u is not None and i is not None}
    for u, i, w in rows:
        for j, o, s in near:
            if i == j and (u, o) not in seen:
                parts = want.setdefault(u, {}).setdefault(o, [])
                parts += [] if w is None else [math.floor(s * 1e12 + 0.5) * round(w * 1e6)]
    kept = {}
    for u, found in want.items():
        order = sorted(found, key=lambda o: (not found[o], -sum(found[o]), o))[:3]
        kept |= {(u, n + 1): (o, sum(found[o]) / 1e18 if found[o] else None) for n, o in enumerate(order)}
    ix = spark.createDataFrame(rows, "user bigint, item bigint, w double")
    got = op.recommend(ix, spark.createDataFrame(near, "item bigint, other bigint, score double"), 3).collect()
    assert len(got) == len(kept)
    for r in got:
        item, score = kept[r["user"], r["rank"]]
        assert r["item"] == item and (r["score"] is None if score is None else r["score"] == pytest.approx(score, rel=1e-12))


def test_scores_of_all_users_are_not_shuffled(spark, dense):
    near = op.stage(op.neighbours(dense, 40))
    before = shuffled(spark)
    recs = op.recommend(dense, near, 5)
    recs.write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 6_000_000 and recs.count() == 2000
