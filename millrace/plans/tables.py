"""T queries."""

from pyspark.sql import functions as F

from millrace.functions import money, rounded, rounded_all
from millrace.operators import tables as op
from millrace.plans.registry import Tables, query
from millrace.sources import save, scratch_dir

BANDS = [("debt", -1000.0, 0.0), ("low", 0.0, 2500.0), ("middle", 2500.0, 7500.0), ("high", 7500.0, 10000.0)]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "t01_load",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def _(t: Tables):
    return t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "t02_save_partitioned",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
              CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""",
)
def _(t: Tables):
    rows = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = scratch_dir(t.spark)
    save(rows.withColumn("o_year", F.year("o_orderdate")), path, ["o_year"])
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_year int"
    return t.spark.read.schema(schema).parquet(path)


@query(
    "t03_net_price",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity < 25""",
)
def _(t: Tables):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return op.select_where(
        t("lineitem"),
        (F.col("l_shipdate") >= F.expr("timestamp_ntz'1998-01-01'")) & (F.col("l_quantity") < 25),
        {
            "l_orderkey": F.col("l_orderkey"),
            "l_linenumber": F.col("l_linenumber"),
            "net": net,
            "gross": net * (1 + F.col("l_tax")),
        },
    )


@query(
    "t04_dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
def _(t: Tables):
    rows = t(
        "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_extendedprice",
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return op.dedupe(rows, ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])


@query(
    "t05_duplicates",
    """SELECT min(doc_id) AS first_doc_id, count(*) AS copies FROM documents
       GROUP BY text HAVING count(*) > 1""",
)
def _(t: Tables):
    return op.duplicates(t("documents", "doc_id", "text"), ["text"], "doc_id")


REGION_SQL = """
SELECT r_name, n_name, c_mktsegment, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, c_mktsegment
"""


def revenue_by_region(t: Tables):
    """The flagship job: fact to four dimensions, then an exact sum per market."""
    joined = op.enrich(
        t("lineitem", "l_orderkey", "l_extendedprice", "l_discount"),
        [
            (t("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "inner"),
            (t("customer", "c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "inner"),
            (t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "inner"),
            (t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"),
        ],
    )
    net = money("l_extendedprice") * (1 - money("l_discount"))
    return op.summarise(
        joined,
        ["r_name", "n_name", "c_mktsegment"],
        {"n_lines": F.count("*"), "revenue": F.sum(net).cast("double")},
    )


query("t06_enrich_inner", REGION_SQL)(revenue_by_region)


@query(
    "t06_enrich_left",
    """SELECT c_custkey, n_name, o_orderkey, o_totalprice FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'""",
)
def _(t: Tables):
    done = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").filter("o_orderstatus = 'F'")
    return op.enrich(
        t("customer", "c_custkey", "c_nationkey"),
        [
            (t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"),
            (done, F.col("c_custkey") == F.col("o_custkey"), "left"),
        ],
    ).select("c_custkey", "n_name", "o_orderkey", "o_totalprice")


@query(
    "t07_present",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def _(t: Tables):
    returned = t("lineitem", "l_orderkey", "l_returnflag").filter("l_returnflag = 'R'")
    return op.present(
        t("orders", "o_orderkey", "o_totalprice"), returned, F.col("o_orderkey") == F.col("l_orderkey")
    )


@query(
    "t07_missing",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def _(t: Tables):
    return op.missing(
        t("orders", "o_orderkey", "o_totalprice"),
        t("lineitem", "l_orderkey"),
        F.col("o_orderkey") == F.col("l_orderkey"),
    )


@query(
    "t08_band",
    """SELECT c_custkey, c_acctbal, label FROM customer JOIN
       (VALUES ('debt', -1000.0, 0.0), ('low', 0.0, 2500.0), ('middle', 2500.0, 7500.0),
               ('high', 7500.0, 10000.0)) b(label, lo, hi) ON lo <= c_acctbal AND c_acctbal < hi""",
)
def _(t: Tables):
    bands = t.spark.createDataFrame(BANDS, "label string, lo double, hi double")
    return op.band(t("customer", "c_custkey", "c_acctbal"), bands, "c_acctbal", 2500.0).select(
        "c_custkey", "c_acctbal", "label"
    )


@query(
    "t09_summarise",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
              CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_price,
              floor(avg(l_discount) * 1e6 + 0.5) / 1e6 AS avg_discount,
              min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(t: Tables):
    return op.summarise(
        t("lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "n_lines": F.count("*"),
            "sum_qty": F.sum(money("l_quantity")).cast("double"),
            "sum_price": F.sum(money("l_extendedprice")).cast("double"),
            "avg_discount": rounded(F.avg("l_discount"), 6),
            "min_price": F.min("l_extendedprice"),
            "max_price": F.max("l_extendedprice"),
        },
    )


@query(
    "t10_distinct_count",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY l_suppkey",
)
def _(t: Tables):
    return op.distinct_count(t("lineitem", "l_suppkey", "l_partkey"), ["l_suppkey"], "l_partkey")


@query("t11_approx_distinct_count", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_distinct, TRUE AS near FROM lineitem GROUP BY 1")
def _(t: Tables):
    """The exact count, and whether the sketch of 2 % deviation comes within five times that."""
    rows = t("lineitem", "l_suppkey", "l_partkey")
    exact = op.distinct_count(rows, ["l_suppkey"], "l_partkey")
    sketch = op.distinct_count(rows, ["l_suppkey"], "l_partkey", rsd=0.02).withColumnRenamed("n_distinct", "about")
    near = F.abs(F.col("about") / F.col("n_distinct") - 1) <= 0.1
    return exact.join(sketch, "l_suppkey").select("l_suppkey", "n_distinct", near.alias("near"))


SUBTOTAL_SQL = """SELECT l_returnflag, l_linestatus, CAST({level} AS BIGINT) AS level, count(*) AS n_lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty
FROM lineitem GROUP BY {sets}"""
GROUPING = "2 * grouping(l_returnflag) + grouping(l_linestatus)"
SUBTOTALS = {
    "rollup": ("rollup", "ROLLUP (l_returnflag, l_linestatus)"),
    "cube": ("cube", "CUBE (l_returnflag, l_linestatus)"),
    "grouping_sets": ([["l_returnflag"], ["l_linestatus"]], "GROUPING SETS ((l_returnflag), (l_linestatus))"),
}


def _subtotals(sets):
    def build(t: Tables):
        return op.subtotals(
            t("lineitem", "l_returnflag", "l_linestatus", "l_quantity"),
            sets,
            ["l_returnflag", "l_linestatus"],
            {"n_lines": F.count("*"), "sum_qty": F.sum(money("l_quantity")).cast("double")},
        )

    return build


for kind, (sets, text) in SUBTOTALS.items():
    query(f"t12_subtotals_{kind}", SUBTOTAL_SQL.format(level=GROUPING, sets=text))(_subtotals(sets))


def _by_day(t: Tables):
    return t("events", "ts", "event_type").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))


WIDE_SQL = """SELECT date_trunc('day', ts)::TIMESTAMP AS day, {} FROM events GROUP BY 1""".format(
    ", ".join(f"count(*) FILTER (event_type = '{e}') AS {e}" for e in EVENT_TYPES)
)


@query("t13_pivot", WIDE_SQL)
def _(t: Tables):
    return op.pivot(_by_day(t), ["day"], "event_type", EVENT_TYPES, F.count(F.lit(1))).na.fill(0, EVENT_TYPES)


@query(
    "t13_unpivot",
    f"""WITH wide AS ({WIDE_SQL})
        UNPIVOT wide ON {", ".join(EVENT_TYPES)} INTO NAME event_type VALUE n""",
)
def _(t: Tables):
    wide = op.pivot(_by_day(t), ["day"], "event_type", EVENT_TYPES, F.count(F.lit(1))).na.fill(0, EVENT_TYPES)
    return op.unpivot(wide, ["day"], EVENT_TYPES, "event_type", "n")


@query(
    "t14_top_per_group",
    """SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank
       FROM events QUALIFY rank <= 3""",
)
def _(t: Tables):
    return op.top_k(t("events", "user_id", "event_id", "value"), 3, [F.desc("value"), F.asc("event_id")], ["user_id"])


@query("t14_top_global", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def _(t: Tables):
    return op.top_k(t("events", "event_id", "value"), 25, [F.desc("value"), F.asc("event_id")])


@query(
    "t15_ranked",
    """SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER w2 AS row_number, rank() OVER w AS rank,
              dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank,
              cume_dist() OVER w AS cume_dist, ntile(4) OVER w2 AS ntile,
              floor(o_totalprice / CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER (PARTITION BY o_custkey) AS DOUBLE)
                    * 1e9 + 0.5) / 1e9 AS share
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice),
                          w2 AS (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey)""",
)
def _(t: Tables):
    rows = t("orders", "o_orderkey", "o_custkey", "o_totalprice")
    out = op.ranked(rows, ["o_custkey"], "o_totalprice", "o_orderkey", 4, share=money("o_totalprice"))
    return out.withColumn("share", rounded(F.col("share"), 9))


SET_SQL = {
    "union_all": "UNION ALL",
    "union": "UNION",
    "intersect": "INTERSECT",
    "intersect_all": "INTERSECT ALL",
    "except": "EXCEPT",
    "except_all": "EXCEPT ALL",
}


def _set_op(kind):
    def build(t: Tables):
        thousands = lambda c: F.floor(F.col(c) / 1000).cast("bigint").alias("thousands")
        a = t("customer").select(F.col("c_nationkey").alias("nationkey"), thousands("c_acctbal"))
        b = t("supplier").select(F.col("s_nationkey").alias("nationkey"), thousands("s_acctbal"))
        return op.set_op(a, b, kind)

    return build


for kind, word in SET_SQL.items():
    query(
        f"t16_{kind}",
        f"""SELECT c_nationkey AS nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS thousands FROM customer
            {word} SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier""",
    )(_set_op(kind))


def _profile_sql(c: str, kind: str) -> str:
    number = {"whole": f"CAST({c} AS DOUBLE)", "floating": c, "time": f"epoch({c})", "text": "NULL::DOUBLE"}[kind]
    quarter = lambda p: "NULL::DOUBLE" if kind == "text" else f"floor(quantile_cont({number}, {p}) * 1e6 + 0.5) / 1e6"
    limit = lambda f: "NULL" if kind == "floating" else f"CAST({f}({c}) AS VARCHAR)"
    return f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
        {limit("min")} AS min_value, {limit("max")} AS max_value, min({number}) AS min_number,
        {quarter(0.25)} AS p25, {quarter(0.5)} AS p50, {quarter(0.75)} AS p75, max({number}) AS max_number FROM orders"""


ORDERS = {"o_orderkey": "whole", "o_custkey": "whole", "o_orderstatus": "text", "o_totalprice": "floating", "o_orderdate": "time", "o_orderpriority": "text"}


@query("t17_profile", " UNION ALL ".join(_profile_sql(c, kind) for c, kind in ORDERS.items()))
def _(t: Tables):
    return rounded_all(op.profile(t("orders")), 6, "p25", "p50", "p75")


@query(
    "t18_json_fields",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(t: Tables):
    return op.json_fields(t("events", "event_id", "props"), "props", "k bigint").drop("props")


HASH_SQL = "((({key} % 2147483648) * 2654435761) % 2147483648) / 2147483648.0::DOUBLE"


@query(
    "t19_sample",
    f"SELECT event_id, event_type, value FROM events WHERE {HASH_SQL.format(key='event_id')} < 0.1",
)
def _(t: Tables):
    return op.sample(t("events", "event_id", "event_type", "value"), "event_id", 0.1)


@query(
    "t19_stratified_sample",
    f"""SELECT event_id, event_type, value FROM events WHERE {HASH_SQL.format(key='event_id')} <
        CASE event_type WHEN 'error' THEN 0.5 WHEN 'purchase' THEN 0.25 ELSE 0.05 END""",
)
def _(t: Tables):
    rows = t("events", "event_id", "event_type", "value")
    return op.sample(rows, "event_id", 0.05, "event_type", {"error": 0.5, "purchase": 0.25})


@query(
    "t20_clean_text",
    r"""SELECT p_partkey, upper(trim(p_name)) AS name, string_split(trim(p_name), ' ')[1] AS first_word,
               regexp_extract(p_brand, '#(\d+)', 1) AS brand_no, len(string_split(trim(p_name), ' ')) AS n_words
        FROM part""",
)
def _(t: Tables):
    part = t("part", "p_partkey", "p_name", "p_brand")
    named = op.clean_text(part, "p_name", {"name": ("upper",), "first_word": ("word", 0), "n_words": ("words",)})
    return op.clean_text(named, "p_brand", {"brand_no": ("extract", r"#(\d+)", 1)}).drop("p_name", "p_brand")
