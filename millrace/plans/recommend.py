"""R queries: customers and the parts they ordered."""

from pyspark.sql import functions as F

from millrace.functions import money, rounded
from millrace.operators import recommend as op
from millrace.plans.registry import Tables, query
from millrace.sources import stage

CUT = "2000-07-01"
MIN_SHARED, MIN_JACCARD, MIN_ITEM_COSINE, MIN_USER_COSINE = 4, 0.08, 0.12, 0.12
#: A bound that every pair with a shared feature reaches.
ANY = 0


def bought(t: Tables, when: str | None = None):
    orders = t("orders", "o_orderkey", "o_custkey", "o_orderdate")
    if when:
        orders = orders.filter(f"o_orderdate {when} timestamp_ntz'{CUT}'")
    lines = t("lineitem", "l_orderkey", "l_partkey", "l_quantity")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return op.interactions(joined, "o_custkey", "l_partkey", F.sum(money("l_quantity")))


def staged(t: Tables, when: str | None = None):
    return stage(bought(t, when))


def ix_sql(name="ix", where="TRUE"):
    return f"""{name} AS (SELECT o_custkey AS "user", l_partkey AS item,
        CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS w
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {where} GROUP BY 1, 2)"""


def rep_sql(entity, weighted, ix="ix"):
    """CTE ``rep``: lowest entity among those with the same profile, and its size and norm."""
    feature = "item" if entity == "user" else "user"
    mark = f"""string_agg("{feature}" || ':' || {"w / top" if weighted else "1"}, ',' ORDER BY "{feature}")"""
    return f"""prof AS (SELECT "{entity}" AS e, count(*) AS n, sqrt(sum(w * w)) AS norm, {mark} AS p
            FROM (SELECT *, max(w) OVER (PARTITION BY "{entity}") AS top FROM {ix}) GROUP BY 1),
        rep AS (SELECT e, n, norm, min(e) OVER (PARTITION BY p) AS rep FROM prof)"""


def pair_sql(entity, score, least, ix="ix"):
    """CTE ``pairs`` by comparing all pairs of representatives."""
    feature = "item" if entity == "user" else "user"
    return f"""own AS (SELECT "{entity}" AS e, "{feature}" AS f, w, n, norm
            FROM {ix} JOIN rep ON "{entity}" = e WHERE e = rep),
        both_ AS (SELECT a.e AS a, b.e AS b, count(*) AS shared, sum(a.w * b.w) AS dot,
            any_value(a.n) AS na, any_value(b.n) AS nb, any_value(a.norm) AS xa, any_value(b.norm) AS xb
            FROM own a JOIN own b ON a.f = b.f AND a.e < b.e GROUP BY 1, 2),
        pairs AS (SELECT a, b, {score} AS score FROM both_ WHERE {score} >= {least})"""


COSINE = "dot / (xa * xb)"


def edges_sql(entity, weighted, score, least, copy_score, copy_where="TRUE"):
    return f"""WITH {ix_sql()}, {rep_sql(entity, weighted)}, {pair_sql(entity, score, least)}
        SELECT a, b, floor(score * 1e6 + 0.5) / 1e6 AS score, FALSE AS copy FROM pairs
        UNION ALL SELECT rep, e, {copy_score}, TRUE FROM rep WHERE e <> rep AND {copy_where}"""


def edges(df):
    return df.withColumn("score", rounded(F.col("score"), 6))


@query("r01_interactions", f"""WITH {ix_sql()} SELECT * FROM ix""")
def _(t: Tables):
    return bought(t)


@query(
    "r02_popularity",
    f"""WITH {ix_sql()} SELECT item, count(*) AS n_users, sum(w) AS weight FROM ix GROUP BY 1
        ORDER BY n_users DESC, weight DESC, item LIMIT 50""",
)
def _(t: Tables):
    return op.popularity(bought(t), 50)


@query(
    "r03_cooccur",
    edges_sql("item", False, "CAST(shared AS DOUBLE)", MIN_SHARED, "CAST(n AS DOUBLE)", f"n >= {MIN_SHARED}"),
)
def _(t: Tables):
    return edges(op.cooccur(staged(t), MIN_SHARED))


@query(
    "r04_jaccard",
    edges_sql("item", False, "CAST(shared AS DOUBLE) / (na + nb - shared)", MIN_JACCARD, "1.0"),
)
def _(t: Tables):
    return edges(op.jaccard(staged(t), MIN_JACCARD))


@query("r05_item_cosine", edges_sql("item", True, COSINE, MIN_ITEM_COSINE, "1.0"))
def _(t: Tables):
    return edges(op.cosine(staged(t), MIN_ITEM_COSINE))


@query("r06_user_cosine", edges_sql("user", True, COSINE, MIN_USER_COSINE, "1.0"))
def _(t: Tables):
    return edges(op.cosine(staged(t), MIN_USER_COSINE, entity="user"))


def near_sql(k, ix="ix"):
    """CTE ``near``: k best others over all items, copies included."""
    return f"""{rep_sql("item", True, ix)}, {pair_sql("item", COSINE, ANY, ix)},
        links AS (SELECT a, b, score FROM pairs UNION ALL SELECT b, a, score FROM pairs
                  UNION ALL SELECT DISTINCT rep, rep, 1.0 FROM rep),
        near AS (SELECT x.e AS item, y.e AS other, score,
                 row_number() OVER (PARTITION BY x.e ORDER BY score DESC, y.e) AS rank
                 FROM links JOIN rep x ON a = x.rep JOIN rep y ON b = y.rep WHERE x.e <> y.e QUALIFY rank <= {k})"""


@query(
    "r07_neighbours",
    f"WITH {ix_sql()}, {near_sql(5)} SELECT item, other, floor(score * 1e6 + 0.5) / 1e6 AS score, rank FROM near",
)
def _(t: Tables):
    return edges(op.neighbours(staged(t), 5))


def recs_sql(k, ix="ix"):
    return f"""scored AS (SELECT "user", other AS item,
            sum(CAST(floor(score * 1e12 + 0.5) AS DECIMAL(20,0)) * CAST(w AS DECIMAL(18,6))) AS exact
            FROM {ix} JOIN near USING (item) GROUP BY 1, 2),
        recs AS (SELECT "user", item, floor(CAST(exact AS DOUBLE) / 1e12 * 1e6 + 0.5) / 1e6 AS score,
            row_number() OVER (PARTITION BY "user" ORDER BY exact DESC, item) AS rank
            FROM scored ANTI JOIN {ix} USING ("user", item) QUALIFY rank <= {k})"""


@query("r08_recommend", f"WITH {ix_sql()}, {near_sql(10)}, {recs_sql(5)} SELECT * FROM recs")
def _(t: Tables):
    ix = staged(t)
    return edges(op.recommend(ix, op.neighbours(ix, 10), 5))


@query(
    "r09_rank_eval",
    f"""WITH {ix_sql("ix", f"o_orderdate < TIMESTAMP '{CUT}'")}, {ix_sql("later", f"o_orderdate >= TIMESTAMP '{CUT}'")},
        {near_sql(10)}, {recs_sql(10)},
        truth AS (SELECT "user", item FROM later ANTI JOIN ix USING ("user", item)),
        per_truth AS (SELECT "user", count(*) AS n_true FROM truth GROUP BY 1),
        per_rec AS (SELECT r."user", count(*) AS n_rec, count(t.item) AS hits
            FROM recs r LEFT JOIN truth t ON r."user" = t."user" AND r.item = t.item GROUP BY 1)
        SELECT count(*) AS n_users, floor(avg(hits / 10) * 1e9 + 0.5) / 1e9 AS precision_at_k,
            floor(avg(hits / n_true) * 1e9 + 0.5) / 1e9 AS recall_at_k,
            floor(avg(CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0 END) * 1e9 + 0.5) / 1e9 AS hit_rate
        FROM per_rec JOIN per_truth USING ("user")""",
)
def _(t: Tables):
    ix = staged(t, "<")
    later = bought(t, ">=").select("user", "item").join(ix, ["user", "item"], "left_anti")
    out = op.rank_eval(op.recommend(ix, op.neighbours(ix, 10), 10), later, 10)
    return out.select("n_users", *[rounded(F.col(c), 9).alias(c) for c in out.columns if c != "n_users"])
