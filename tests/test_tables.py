from pyspark.sql import functions as F

import pytest

from millrace.operators import tables as op


def test_dedupe_with_null_keys_and_ties(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), (1, 5, "x"), (1, 5, "w")], "k int, o int, v string")
    got = {(r["k"], r["v"]) for r in op.dedupe(df, ["k"], [F.col("o"), F.col("v")]).collect()}
    assert got == {(None, "a"), (1, "w")}


def test_duplicates_tell_null_from_text_and_keep_columns_apart(spark):
    rows = [(1, "a", "b"), (2, "a", "b"), (3, None, "b"), (4, "null", "b"), (5, None, "b"), (6, "a|b", "")]
    df = spark.createDataFrame(rows, "id int, x string, y string")
    got = {(r["first_id"], r["copies"]) for r in op.duplicates(df, ["x", "y"], "id").collect()}
    assert got == {(1, 2), (3, 2)}


def test_band_borders(spark):
    bands = spark.createDataFrame([("a", 0.0, 10.0), ("b", 10.0, 25.0), ("all", -100.0, 100.0)], "label string, lo double, hi double")
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (25.0,), (100.0,), (None,), (-0.5,)], "x double")
    got = sorted((r["x"], r["label"]) for r in op.band(df, bands, "x", 10.0).collect())
    assert got == [(-0.5, "all"), (0.0, "a"), (0.0, "all"), (9.99, "a"), (9.99, "all"), (10.0, "all"), (10.0, "b"), (25.0, "all")]


def test_ranked_ties_and_nulls_match_the_window_functions(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1), (1, 5.0, 2), (1, None, 3), (1, 7.0, 4), (1, 1.0, 5), (2, 3.0, 6)], "k int, v double, id int"
    )
    want = df.selectExpr(
        "id",
        "row_number() over (partition by k order by v, id) rn", "rank() over (partition by k order by v) r",
        "dense_rank() over (partition by k order by v) d", "percent_rank() over (partition by k order by v) p",
        "cume_dist() over (partition by k order by v) c", "ntile(3) over (partition by k order by v, id) t",
    )
    for rows in (None, 2):
        kw = {"rows_per_task": rows} if rows else {}
        got = op.ranked(df, ["k"], "v", "id", 3, **kw).select(
            "id", "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile"
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_value_in_all_rows_is_cut(spark):
    """Places inside a value are counted by the tie column, so no task needs all rows of a value."""
    df = spark.range(400).selectExpr("1 as k", "CASE WHEN id % 50 = 0 THEN NULL ELSE 7.0D END AS v", "id")
    want = df.selectExpr(
        "id", "row_number() over (partition by k order by v, id) rn", "rank() over (partition by k order by v) r",
        "dense_rank() over (partition by k order by v) d", "cume_dist() over (partition by k order by v) c",
    )
    for by in (["k"], []):
        out = op.ranked(df, by, "v", "id", rows_per_task=50)
        got = out.select("id", "row_number", "rank", "dense_rank", "cume_dist")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_chunk" in plan


def test_a_tiny_share_is_a_tiny_sample(spark):
    assert op.sample(spark.range(2_000_000), "id", 1e-8).count() <= 1
    assert 150 <= op.sample(spark.range(2_000_000), "id", 1e-4).count() <= 250


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (2, None)], "a int, b double")
    rows = {r["column"]: r for r in op.profile(df).collect()}
    assert (rows["a"]["n_rows"], rows["a"]["n_null"], rows["a"]["n_distinct"], rows["a"]["p50"]) == (3, 0, 2, 2.0)
    assert (rows["b"]["n_null"], rows["b"]["n_distinct"], rows["b"]["min_value"]) == (3, 0, None)


def test_profile_keeps_types_exact(spark):
    df = spark.sql("""SELECT * FROM VALUES (9007199254740993L, 'é', DATE'2024-01-02', 1.10BD, true, 0.5D), (9007199254740992L, '', DATE'2024-01-01', 1.1BD, NULL, NULL),
        (9007199254740992L, NULL, NULL, NULL, false, -0.5D) AS v(big, text, day, dec, flag, f)""")
    rows = {r["column"]: r for r in op.profile(df).collect()}
    assert len(rows) == 6
    assert (rows["big"]["n_distinct"], rows["big"]["min_value"], rows["big"]["max_value"]) == (2, "9007199254740992", "9007199254740993")
    assert (rows["text"]["n_null"], rows["text"]["n_distinct"], rows["text"]["min_value"], rows["text"]["max_value"], rows["text"]["p50"]) == (1, 2, "", "é", None)
    assert (rows["day"]["min_value"], rows["day"]["max_value"], rows["day"]["max_number"] - rows["day"]["p50"]) == ("2024-01-01", "2024-01-02", 43200.0)
    assert (rows["dec"]["n_distinct"], rows["flag"]["n_distinct"], rows["flag"]["p50"]) == (1, 2, 0.5)
    assert (rows["f"]["min_value"], rows["f"]["min_number"], rows["f"]["max_number"]) == (None, -0.5, 0.5)


def test_sample_nests_and_follows_strata(spark):
    df = spark.range(20000).withColumn("s", F.when(F.col("id") % 2 == 0, "x").otherwise("y"))
    small, large = op.sample(df, "id", 0.1), op.sample(df, "id", 0.3)
    assert abs(small.count() / 20000 - 0.1) < 0.01
    assert small.join(large, "id", "left_anti").count() == 0
    parts = {r["s"]: r["count"] for r in op.sample(df, "id", 0.1, "s", {"x": 0.5}).groupBy("s").count().collect()}
    assert abs(parts["x"] / 10000 - 0.5) < 0.03 and abs(parts["y"] / 10000 - 0.1) < 0.02


def test_hash_takes_keys_of_any_size(spark):
    df = spark.range(9223372036854775000, 9223372036854775800, 1)
    assert 0 < op.sample(df, "id", 0.5).count() < 800


def test_bad_json_gives_nulls(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{",), (None,)], "p string")
    assert [r["k"] for r in op.json_fields(df, "p", "k bigint").collect()] == [1, None, None]


@pytest.mark.parametrize("kind,want", [
    ("union_all", [1, 1, 1, 2, 2, None]), ("union", [1, 2, None]), ("intersect", [1, 2]), ("intersect_all", [1, 2]),
    ("except", [None]), ("except_all", [1, None]),
])
def test_set_ops_go_by_name(spark, kind, want):
    a = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (None, 0)], "x int, z int")
    b = spark.createDataFrame([(0, 1), (0, 2)], "z int, x int")
    got = [r["x"] for r in op.set_op(a, b, kind).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
