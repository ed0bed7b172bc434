"""F queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import key_hash, money, rounded_all
from millrace.operators import features as op
from millrace.plans.registry import Tables, query

MASKED_SQL = """masked AS (SELECT o_orderkey, o_custkey, o_orderpriority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders)"""


def masked(t: Tables):
    """Orders with planted gaps: the given tables have none."""
    key = F.col("o_orderkey")
    return t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 11 != 0, F.col("o_orderpriority")).alias("priority"),
    )


@query(
    "f01_missing_report",
    f"WITH {MASKED_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
            (count(*) - count({c})) / count(*) AS share FROM masked"""
        for c in ("o_orderkey", "price", "priority")
    ),
)
def _(t: Tables):
    return op.missing_report(masked(t), ["o_orderkey", "price", "priority"])


FILLED = {
    "mean": "(SELECT avg(price) FROM masked)",
    "median": "(SELECT median(price) FROM masked)",
    "constant": "0.0",
}


def _impute(rule):
    def build(t: Tables):
        rows = masked(t).select("o_orderkey", "price")
        return rounded_all(op.impute(rows, {"price": ("constant", 0.0) if rule == "constant" else rule}), 5, "price")

    return build


for rule, value in FILLED.items():
    query(
        f"f02_impute_{rule}",
        f"""WITH {MASKED_SQL} SELECT o_orderkey, floor(coalesce(price, {value}) * 1e5 + 0.5) / 1e5 AS price,
            price IS NULL AS price_missing FROM masked""",
    )(_impute(rule))


@query(
    "f02_impute_mode",
    f"""WITH {MASKED_SQL} SELECT o_orderkey, coalesce(priority, (SELECT priority FROM masked WHERE priority IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority, priority IS NULL AS priority_missing FROM masked""",
)
def _(t: Tables):
    return op.impute(masked(t).select("o_orderkey", "priority"), {"priority": "mode"})


@query(
    "f03_impute_by_group",
    f"""WITH {MASKED_SQL} SELECT o_orderkey, o_custkey, floor(coalesce(price, avg(price) OVER (PARTITION BY o_custkey))
        * 1e6 + 0.5) / 1e6 AS price, price IS NULL AS price_missing FROM masked""",
)
def _(t: Tables):
    return rounded_all(op.impute_by(masked(t).select("o_orderkey", "o_custkey", "price"), ["o_custkey"], "price"), 6, "price")


INDEX_SQL = """idx AS (SELECT {c} AS c, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i
                FROM part GROUP BY 1)"""


@query(
    "f04_index_category",
    f"WITH {INDEX_SQL.format(c='p_type')} SELECT p_partkey, p_type, i AS p_type_index FROM part JOIN idx ON p_type = c",
)
def _(t: Tables):
    return op.index_category(t("part", "p_partkey", "p_type"), "p_type")


@query("f04_category_table", f"WITH {INDEX_SQL.format(c='p_name')} SELECT c AS p_name, n, i AS \"index\" FROM idx")
def _(t: Tables):
    return op.category_index(t("part", "p_name"), "p_name")


HOT = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@query(
    "f05_one_hot",
    "SELECT o_orderkey, o_orderpriority, "
    + ", ".join(f"CAST(o_orderpriority = '{v}' AS INTEGER) AS {n}" for v, n in HOT.items())
    + " FROM orders",
)
def _(t: Tables):
    return op.one_hot(t("orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", HOT)


@query(
    "f06_equal_width_bins",
    """SELECT p_partkey, p_retailprice, CAST(CASE WHEN p_retailprice < 900 THEN 0 WHEN p_retailprice >= 1000 THEN 11
       ELSE floor((p_retailprice - 900) / 100 * 10) + 1 END AS INTEGER) AS bin FROM part""",
)
def _(t: Tables):
    return op.width_bins(t("part", "p_partkey", "p_retailprice"), "p_retailprice", 900.0, 1000.0, 10)


@query(
    "f06_quantile_bins",
    """WITH e AS (SELECT quantile_cont(p_retailprice, [0.2, 0.4, 0.6, 0.8]) AS q FROM part)
       SELECT p_partkey, p_retailprice,
         CAST((p_retailprice >= q[1])::INT + (p_retailprice >= q[2])::INT + (p_retailprice >= q[3])::INT
              + (p_retailprice >= q[4])::INT AS INTEGER) AS bin FROM part, e""",
)
def _(t: Tables):
    rows = t("part", "p_partkey", "p_retailprice")
    return op.bin(rows, "p_retailprice", op.quantile_edges(rows, "p_retailprice", 5))


FOLD = "((({key} % 2147483648) * 2654435761) % 1000003) % 5"


@query(
    "f07_target_encode",
    f"""WITH e AS (SELECT event_id, event_type, value, CAST({FOLD.format(key='event_id')} AS INTEGER) AS fold FROM events),
        g AS (SELECT event_type, fold, sum(value) AS s, count(*) AS n FROM e GROUP BY 1, 2),
        x AS (SELECT event_type, fold, sum(s) OVER c - s AS so, sum(n) OVER c - n AS n_o,
              (sum(s) OVER () - sum(s) OVER f) / (sum(n) OVER () - sum(n) OVER f) AS prior
              FROM g WINDOW c AS (PARTITION BY event_type), f AS (PARTITION BY fold))
        SELECT event_id, event_type, value, fold, floor((so + 20 * prior) / (n_o + 20) * 1e7 + 0.5) / 1e7 AS encoded
        FROM e JOIN x USING (event_type, fold)""",
)
def _(t: Tables):
    rows = t("events", "event_id", "event_type", "value").withColumn("fold", (key_hash("event_id") % 5).cast("int"))
    return rounded_all(op.target_encode(rows, "event_type", "value", 20.0, "fold"), 7, "encoded")


@query(
    "f08_history_mean",
    """SELECT event_id, user_id, value, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / count(*) OVER w AS history
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(t: Tables):
    events = t("events", "event_id", "user_id", "ts", "value").withColumn("exact", money("value"))
    return op.history_mean(events, ["user_id"], ["ts", "event_id"], "exact").drop("ts", "exact")


SCALE_SQL = {
    "standard": "({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem)",
    "minmax": "({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)",
    "robust": "({c} - (SELECT median({c}) FROM lineitem)) / "
    "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)",
}


def _scale(kind):
    def build(t: Tables):
        rows = t("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
        cols = ["l_quantity", "l_extendedprice"]
        return rounded_all(op.scale(rows, cols, kind), 8, *cols)

    return build


for kind, text in SCALE_SQL.items():
    query(
        f"f09_scale_{kind}",
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"floor({text.format(c=c)} * 1e8 + 0.5) / 1e8 AS {c}" for c in ("l_quantity", "l_extendedprice"))
        + " FROM lineitem",
    )(_scale(kind))


CLIP_SQL = {
    "iqr": ("quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25))",
            "quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25))", 1.5),
    "z": ("avg(value) - 2 * stddev_samp(value)", "avg(value) + 2 * stddev_samp(value)", 2.0),
}


def _clip(rule, factor):
    def build(t: Tables):
        rows = op.clip(t("events", "event_id", "value"), "value", rule, factor)
        return rounded_all(rows, 7, "value_clipped")

    return build


for rule, (low, high, factor) in CLIP_SQL.items():
    query(
        f"f10_clip_{rule}",
        f"""WITH b AS (SELECT {low} AS lo, {high} AS hi FROM events)
            SELECT event_id, value, value < lo OR value > hi AS value_outlier,
            floor(greatest(least(value, hi), lo) * 1e7 + 0.5) / 1e7 AS value_clipped FROM events, b""",
    )(_clip(rule, factor))


@query(
    "f11_log_target",
    """SELECT o_orderkey, floor(ln(o_totalprice + 1) * 1e9 + 0.5) / 1e9 AS log_y,
       floor(o_totalprice * 1e5 + 0.5) / 1e5 AS back FROM orders""",
)
def _(t: Tables):
    rows = op.log_target(t("orders", "o_orderkey", "o_totalprice"), "o_totalprice")
    return rounded_all(
        rounded_all(op.unlog_target(rows, "log_y", "back"), 9, "log_y"), 5, "back"
    ).drop("o_totalprice")


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "f12_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, floor(corr({a}, {b}) * 1e9 + 0.5) / 1e9 AS corr FROM lineitem"
        for i, a in enumerate(CORR)
        for b in CORR[i + 1 :]
    ),
)
def _(t: Tables):
    return rounded_all(op.correlations(t("lineitem", *CORR), CORR), 9, "corr")


@query(
    "f12_feature_ranking",
    "SELECT *, CAST(row_number() OVER (ORDER BY abs(corr) DESC, a) AS INTEGER) AS rank FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, 'l_extendedprice' AS b, floor(corr({a}, l_extendedprice) * 1e9 + 0.5) / 1e9 AS corr FROM lineitem"
        for a in CORR
        if a != "l_extendedprice"
    )
    + ")",
)
def _(t: Tables):
    return rounded_all(op.correlations(t("lineitem", *CORR), CORR, "l_extendedprice"), 9, "corr")


@query(
    "f13_assemble",
    "SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def _(t: Tables):
    rows = t("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    v = vector_to_array("features")
    return op.assemble(rows, ["l_quantity", "l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", *[v[i].alias(f"f{i}") for i in range(3)]
    )
