"""Every registered query on the smallest tables, against its SQL where there is one."""

import pytest

from shared import SMALL
from millrace.plans import all_queries
from oracle import compare, database

QUERIES = all_queries()


#: Models that the smallest tables have too few rows for.
LEARNING = {n for n in QUERIES if n[:3] in ("p03", "p04", "e11", "s14")}
MEDIUM = SMALL.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql and n not in LEARNING])
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name].build(spark, SMALL), con, QUERIES[name].sql) == ""


@pytest.mark.parametrize("name", sorted(LEARNING))
def test_models_match_sql(spark, name):
    assert compare(QUERIES[name].build(spark, MEDIUM), database(MEDIUM), QUERIES[name].sql) == ""


def test_lsh_is_near_the_exact_neighbours(spark):
    exact = {r["id"]: r["prediction"] for r in QUERIES["v04_knn_vote"].build(spark, SMALL).collect()}
    found = QUERIES["v05_knn_lsh"].build(spark, SMALL).collect()
    # Labels carry no signal here, so this is about finding neighbours at all.
    assert len(found) >= 0.9 * len(exact)
    assert sum(exact[r["id"]] == r["prediction"] for r in found) >= 0.5 * len(found)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "trefsl" and "model" not in n and n != "s14_forecast"])
def test_plans_stay_in_the_jvm_and_never_cross_join(spark, name):
    plan = QUERIES[name].build(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PYTHON_NODES)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Frames from the current row to the end cost the square of a key's rows.
    assert "currentrow$(), unboundedfollowing$()" not in plan
