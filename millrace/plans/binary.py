"""E queries: toxicity labels scored by text length, and a planted probability on orders."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import rounded, rounded_all, unit_interval
from millrace.operators import binary as op
from millrace.operators.features import assemble
from millrace.plans.registry import Tables, query
from millrace.plans.tables import HASH_SQL

SCORED_SQL = """scored AS (SELECT doc_id, toxic AS label, n_chars::DOUBLE AS score
                           FROM labels JOIN documents USING (doc_id))"""
CURVE_SQL = f"""{SCORED_SQL},
    points AS (SELECT score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored GROUP BY 1),
    curve AS (SELECT *, sum(pos) OVER (ORDER BY score DESC)::BIGINT AS tp, sum(neg) OVER (ORDER BY score DESC)::BIGINT AS fp,
              sum(pos) OVER ()::BIGINT AS p, sum(neg) OVER ()::BIGINT AS n FROM points)"""


def scored(t: Tables):
    docs = t("documents", "doc_id", "n_chars")
    return t("labels", "doc_id", "toxic").join(docs, "doc_id").select(
        "doc_id", F.col("toxic").alias("label"), F.col("n_chars").cast("double").alias("score")
    )


@query(
    "e01_class_weights",
    f"""WITH {SCORED_SQL} SELECT label, count(*) AS n, count(*) / (SELECT count(*) FROM scored) AS share,
        (SELECT count(*) FROM scored) / ((SELECT count(DISTINCT label) FROM scored) * count(*)) AS weight
        FROM scored GROUP BY label""",
)
def _(t: Tables):
    return op.class_weights(scored(t))


@query(
    "e02_downsample",
    f"""WITH {SCORED_SQL} SELECT doc_id, label, score FROM scored WHERE label = 1
        OR {HASH_SQL.format(key='doc_id')} < 2.0 * (SELECT sum(label) FROM scored) / (SELECT sum(1 - label) FROM scored)""",
)
def _(t: Tables):
    return op.downsample(scored(t), "doc_id", 2.0)


@query(
    "e03_folds",
    f"""WITH {SCORED_SQL} SELECT doc_id, label, score, CAST((row_number() OVER (PARTITION BY label
        ORDER BY ((doc_id % 2147483648) * 2654435761) % 1000003, doc_id) - 1) % 5 AS INTEGER) AS fold FROM scored""",
)
def _(t: Tables):
    return op.folds(scored(t), "doc_id", 5, "label")


THRESHOLDS = [100.0, 500.0, 1000.0, 2000.0, 4000.0, 8000.0, 16000.0]


@query(
    "e04_sweep",
    f"""WITH {SCORED_SQL}, t AS (SELECT unnest([{", ".join(map(str, THRESHOLDS))}])::DOUBLE AS threshold)
        SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
            count(*) FILTER (label = 0 AND score >= threshold) AS fp,
            count(*) FILTER (label = 1 AND score < threshold) AS fn,
            count(*) FILTER (label = 0 AND score < threshold) AS tn FROM scored, t GROUP BY 1""",
)
def _(t: Tables):
    return op.sweep(scored(t), THRESHOLDS)


@query("e05_roc", f"WITH {CURVE_SQL} SELECT score AS threshold, tp, fp, tp / p AS tpr, fp / n AS fpr FROM curve")
def _(t: Tables):
    return op.roc(scored(t))


@query(
    "e05_auc",
    f"""WITH {SCORED_SQL} SELECT (SELECT sum(label)::BIGINT FROM scored) AS positives,
        (SELECT sum(1 - label)::BIGINT FROM scored) AS negatives,
        floor(avg(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END) * 1e9 + 0.5) / 1e9 AS auc
        FROM scored a, scored b WHERE a.label = 1 AND b.label = 0""",
)
def _(t: Tables):
    return op.auc(scored(t)).withColumn("auc", rounded(F.col("auc"), 9))


@query("e06_pr", f"""WITH {CURVE_SQL} SELECT score AS threshold, tp / (tp + fp) AS "precision", tp / p AS recall FROM curve""")
def _(t: Tables):
    return op.pr(scored(t))


@query(
    "e06_average_precision",
    f"""WITH {CURVE_SQL} SELECT floor(sum(pos / p * tp / (tp + fp)) * 1e9 + 0.5) / 1e9 AS average_precision FROM curve""",
)
def _(t: Tables):
    return rounded_all(op.average_precision(scored(t)), 9, "average_precision")


@query(
    "e07_ks",
    f"""WITH {CURVE_SQL} SELECT abs(tp / p - fp / n) AS ks, score AS threshold FROM curve
        ORDER BY ks DESC, threshold DESC LIMIT 1""",
)
def _(t: Tables):
    return op.ks(scored(t))


@query(
    "e08_lift",
    f"""WITH {SCORED_SQL}, r AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY score DESC, doc_id) - 1) * 10
                                  / count(*) OVER ()) AS BIGINT) + 1 AS bucket FROM scored),
        b AS (SELECT bucket, count(*) AS n, sum(label)::BIGINT AS positives, min(score) AS min_score,
              max(score) AS max_score FROM r GROUP BY 1)
        SELECT *, sum(positives) OVER (ORDER BY bucket) / sum(positives) OVER () AS gain,
            (positives / n) / (sum(positives) OVER () / sum(n) OVER ()) AS lift FROM b""",
)
def _(t: Tables):
    return op.lift(scored(t), 10, "doc_id")


# Planted: the chance of a positive order grows with its price; about 5 % are positive.
PLANTED_SQL = f"""planted AS (SELECT o_orderkey AS id, o_totalprice / 500000 AS x1, dayofmonth(o_orderdate) / 31 AS x2,
        1 / (1 + exp(5.5 - 4 * (o_totalprice / 500000))) AS p,
        (((o_orderkey % 2147483648) * 2654435761) % 1000003 + 0.5::DOUBLE) / 1000003.0::DOUBLE AS u FROM orders),
    judged AS (SELECT *, CAST(u < p AS INTEGER) AS label, p AS score FROM planted)"""


def planted_binary(t: Tables):
    x1 = F.col("o_totalprice") / 500000
    p = 1 / (1 + F.exp(5.5 - 4 * x1))
    rows = t("orders", "o_orderkey", "o_totalprice", "o_orderdate").select(
        F.col("o_orderkey").alias("id"),
        x1.alias("x1"),
        (F.dayofmonth("o_orderdate") / 31).alias("x2"),
        p.alias("p"),
        unit_interval("o_orderkey").alias("u"),
    )
    return rows.withColumn("label", (F.col("u") < F.col("p")).cast("int"))


@query(
    "e09_calibration",
    f"""WITH {PLANTED_SQL} SELECT CAST(least(floor(score * 20) + 1, 20) AS INTEGER) AS bin, count(*) AS n,
        floor(avg(score) * 1e9 + 0.5) / 1e9 AS mean_score, floor(avg(label) * 1e9 + 0.5) / 1e9 AS share_positive
        FROM judged GROUP BY 1""",
)
def _(t: Tables):
    rows = planted_binary(t).withColumnRenamed("p", "score")
    return rounded_all(op.calibration(rows, 20), 9, "mean_score", "share_positive")


@query(
    "e09_brier",
    f"""WITH {PLANTED_SQL} SELECT count(*) AS n,
        floor(avg((score - label) * (score - label)) * 1e9 + 0.5) / 1e9 AS brier FROM judged""",
)
def _(t: Tables):
    return rounded_all(op.brier(planted_binary(t).withColumnRenamed("p", "score")), 9, "brier")


EDGES = [5.0, 10.0, 20.0, 35.0, 50.0, 75.0, 100.0, 150.0]
HALF = "2024-01-16"


@query(
    "e10_psi",
    f"""WITH b AS (SELECT len(list_filter([{", ".join(map(str, EDGES))}], lambda e: e <= value)) AS bin,
            count(*) FILTER (ts < TIMESTAMP '{HALF}') AS n_a, count(*) FILTER (ts >= TIMESTAMP '{HALF}') AS n_b
            FROM events GROUP BY 1),
        s AS (SELECT n_a, n_b, greatest(n_a / sum(n_a) OVER (), 1e-6) AS p, greatest(n_b / sum(n_b) OVER (), 1e-6) AS q FROM b)
        SELECT sum(n_a)::BIGINT AS n_a, sum(n_b)::BIGINT AS n_b,
            floor(sum((p - q) * ln(p / q)) * 1e9 + 0.5) / 1e9 AS psi FROM s""",
)
def _(t: Tables):
    rows = t("events", "ts", "value")
    first, last = (rows.filter(f"ts {c} timestamp_ntz'{HALF}'") for c in ("<", ">="))
    return rounded_all(op.psi(first, last, "value", EDGES), 9, "psi")


@query(
    "e11_weighted_binary_model",
    f"""WITH {PLANTED_SQL} SELECT sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, TRUE AS above_chance
        FROM judged WHERE id % 5 = 0""",
)
def _(t: Tables):
    rows = planted_binary(t)
    train, test = rows.filter("id % 5 != 0"), rows.filter("id % 5 = 0")
    weights = F.broadcast(op.class_weights(train).select("label", "weight"))  # two rows
    model = op.fit_binary(train.join(weights, "label"), ["x1", "x2"], weight="weight")
    scores = model.transform(assemble(test, ["x1", "x2"]))
    scores = scores.select("id", "label", vector_to_array("probability")[1].alias("score"))
    return op.auc(scores).select("positives", "negatives", (F.col("auc") > 0.6).alias("above_chance"))
