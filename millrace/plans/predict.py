"""P queries. Models learn a signal planted on the given rows, which carry none themselves."""

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from millrace.functions import held_out, rounded_all, unit_interval
from millrace.operators import predict as op
from millrace.operators.binary import auc, folds
from millrace.plans.binary import PLANTED_SQL, planted_binary
from millrace.plans.registry import Tables, query

X = ["x1", "x2", "x3"]
OLS_SQL = """SELECT l_returnflag, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
    regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2
    FROM lineitem GROUP BY 1"""


def lines(t: Tables):
    return t("lineitem", "l_returnflag", "l_quantity", "l_extendedprice")


@query(
    "p01_simple_ols",
    f"""SELECT l_returnflag, n, floor(slope * 1e6 + 0.5) / 1e6 AS slope, floor(intercept * 1e5 + 0.5) / 1e5 AS intercept,
        floor(r2 * 1e12 + 0.5) / 1e12 AS r2 FROM ({OLS_SQL})""",
)
def _(t: Tables):
    out = op.simple_ols(lines(t), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rounded_all(rounded_all(rounded_all(out, 6, "slope"), 5, "intercept"), 12, "r2")


@query(
    "p02_linear",
    """SELECT 'intercept' AS term, floor(regr_intercept(l_extendedprice, l_quantity) * 1e4 + 0.5) / 1e4 AS value FROM lineitem
       UNION ALL SELECT 'l_quantity', floor(regr_slope(l_extendedprice, l_quantity) * 1e4 + 0.5) / 1e4 FROM lineitem""",
)
def _(t: Tables):
    rows = lines(t)
    model = op.fit_linear(rows, ["l_quantity"], "l_extendedprice")
    return rounded_all(op.coefficients(model, ["l_quantity"], rows), 4, "value")


def planted_linear(t: Tables):
    """y = 10 + 3 x1 - 2 x2 + 0.5 x3 and uniform noise of width 1."""
    rows = t("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    noise = unit_interval(key + F.col("l_partkey") * 31) - 0.5
    x1, x2, x3 = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_linenumber").cast("double")
    return rows.select(
        key.alias("id"), x1.alias("x1"), x2.alias("x2"), x3.alias("x3"), (10 + 3 * x1 - 2 * x2 + 0.5 * x3 + noise).alias("y")
    )


def split(rows):
    mark = held_out("id", 0.25)
    return rows.filter(~mark), rows.filter(mark)


#: The planted relation in SQL.
LINEAR_SQL = """rows AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS x1, l_discount * 100 AS x2, l_linenumber::DOUBLE AS x3,
        10 + 3 * l_quantity - 2 * (l_discount * 100) + 0.5::DOUBLE * l_linenumber::DOUBLE
        + ((((l_orderkey * 8 + l_linenumber + l_partkey * 31) % 2147483648) * 2654435761) % 1000003 + 0.5::DOUBLE) / 1000003.0::DOUBLE - 0.5::DOUBLE AS y
        FROM lineitem)"""
PLANTED = {"intercept": 10.0, "x1": 3.0, "x2": -2.0, "x3": 0.5}


def held_sql(key: str, share: float) -> str:
    """SQL of ``held_out``."""
    return f"((((({key}) % 2147483648) * 48271 + 11) % 2147483648) * 2654435761) % 1000003 < {share * 1000003!r}"


def found_near(rows, values, planted, tolerance, session):
    """(term, planted, n_rows, near): whether each fitted value is as near to the planted one as the tolerance says."""
    listed = [(term, planted[term], bool(abs(v - planted[term]) <= tolerance)) for term, v in values]
    made = session.createDataFrame(listed, "term string, planted double, near boolean")
    return made.withColumn("n_rows", rows.agg(F.count("*")).scalar())


def near_sql(planted, table):
    return " UNION ALL ".join(f"SELECT '{t}' AS term, {v!r}::DOUBLE AS planted, TRUE AS near, (SELECT count(*) FROM {table}) AS n_rows" for t, v in planted.items())


def _regularised(reg, l1):
    def build(t: Tables):
        rows = planted_linear(t)
        model = op.fit_linear(rows, X, "y", reg, l1)
        values = [("intercept", float(model.intercept)), *((c, float(v)) for c, v in zip(X, model.coefficients))]
        return found_near(rows, values, PLANTED, 0.75, rows.sparkSession)

    return build


# The penalty shrinks what is found: by less than 0.2 for a slope, and 0.75 for the intercept that makes up for it.
query("p02_ridge", near_sql(PLANTED, "lineitem"))(_regularised(0.1, 0.0))
query("p02_elastic_net", near_sql(PLANTED, "lineitem"))(_regularised(0.1, 0.5))


def _trees(kind):
    def build(t: Tables):
        train, test = split(planted_linear(t))
        ours = op.regression_report(op.apply(op.fit_trees(train, X, "y", kind), test, X), "y", "prediction")
        flat = op.regression_report(test.withColumn("flat", train.agg(F.avg("y")).scalar()), "y", "flat")
        both = ours.withColumn("mean_rmse", flat.select("rmse").scalar())
        return rounded_all(both.select("n", "mean_rmse", (F.col("rmse") < 0.5 * F.col("mean_rmse")).alias("halved")), 6, "mean_rmse")

    return build


#: Rows held out, the error of the training mean on them, and that the trees halve it.
TREES_SQL = f"""WITH {LINEAR_SQL}, t AS (SELECT *, {held_sql("id", 0.25)} AS held FROM rows), m AS (SELECT avg(y) AS m FROM t WHERE NOT held)
    SELECT count(*) AS n, floor(sqrt(avg((y - m) * (y - m))) * 1e6 + 0.5) / 1e6 AS mean_rmse, TRUE AS halved FROM t, m WHERE held"""
query("p03_forest", TREES_SQL)(_trees("forest"))
query("p03_boosted_trees", TREES_SQL)(_trees("boosted"))


def _classifier(kind):
    def build(t: Tables):
        train, test = split(planted_binary(t))
        model = op.fit_classifier(train, ["x1", "x2"], kind=kind)
        scored = op.apply(model, test, ["x1", "x2"]).select(
            "label", vector_to_array("probability")[1].alias("score")
        )
        return auc(scored).select("positives", "negatives", (F.col("auc") > 0.6).alias("above_chance"))

    return build


#: Rows held out by label, and that the model ranks them better than chance.
CLASSIFIER_SQL = f"""WITH {PLANTED_SQL} SELECT sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, TRUE AS above_chance
    FROM judged WHERE {held_sql("id", 0.25)}"""
for kind in ("logistic", "forest", "boosted"):
    query(f"p04_{kind}_classifier", CLASSIFIER_SQL)(_classifier(kind))


@query(
    "p05_regression_report",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
                  FROM lineitem),
        r AS (SELECT l_returnflag, l_extendedprice AS y, b + a * l_quantity AS p FROM lineitem, m)
       SELECT l_returnflag, count(*) AS n, floor(sqrt(avg((y - p) * (y - p))) * 1e4 + 0.5) / 1e4 AS rmse,
         floor(avg(abs(y - p)) * 1e4 + 0.5) / 1e4 AS mae, floor(avg(abs((y - p) / y)) * 1e7 + 0.5) / 1e7 AS mape,
         floor((1 - avg((y - p) * (y - p)) / var_pop(y)) * 1e9 + 0.5) / 1e9 AS r2 FROM r GROUP BY 1""",
)
def _(t: Tables):
    rows = lines(t)
    line = rows.agg(
        F.struct(
            F.regr_slope("l_extendedprice", "l_quantity").alias("a"),
            F.regr_intercept("l_extendedprice", "l_quantity").alias("b"),
        )
    ).scalar()
    out = op.regression_report(
        rows.withColumn("p", line["b"] + line["a"] * F.col("l_quantity")), "l_extendedprice", "p", ["l_returnflag"]
    )
    return rounded_all(rounded_all(rounded_all(out, 4, "rmse", "mae"), 7, "mape"), 9, "r2")


@query(
    "p06_mean_baseline",
    """WITH m AS (SELECT o_custkey, avg(o_totalprice) AS v FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1)
       SELECT o_orderkey, o_custkey, o_totalprice, floor(coalesce(v, (SELECT avg(o_totalprice) FROM orders
         WHERE o_orderdate < TIMESTAMP '1996-01-01')) * 1e6 + 0.5) / 1e6 AS prediction
       FROM orders LEFT JOIN m USING (o_custkey) WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
)
def _(t: Tables):
    rows = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    train, test = (rows.filter(f"o_orderdate {c} timestamp_ntz'1996-01-01'").drop("o_orderdate") for c in ("<", ">="))
    return rounded_all(op.mean_baseline(train, test, "o_totalprice", ["o_custkey"]), 6, "prediction")


@query("p07_tune", "SELECT reg, place, (SELECT count(*) FROM lineitem) AS n_rows FROM (VALUES (0.0::DOUBLE, 1), (0.1::DOUBLE, 2), (1.0::DOUBLE, 3)) AS v(reg, place)")
def _(t: Tables):
    """Each penalty's place by the error over the folds: the planted relation needs none."""
    rows = folds(planted_linear(t).withColumn("one", F.lit(1)), "id", 3, "one")
    best = op.tune(
        rows, X, LinearRegression(labelCol="y"), {"regParam": [0.0, 0.1, 1.0]}, 3,
        RegressionEvaluator(labelCol="y", metricName="rmse"), "fold",
    )
    tried = sorted((float(s), m[best.getEstimator().regParam]) for m, s in zip(best.getEstimatorParamMaps(), best.avgMetrics))
    placed = [(reg, i) for i, (_, reg) in enumerate(tried, 1)]
    return rows.sparkSession.createDataFrame(placed, "reg double, place int").withColumn("n_rows", rows.agg(F.count("*")).scalar())
