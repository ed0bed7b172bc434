"""V queries on the embeddings."""

from pyspark.sql import functions as F

from millrace.functions import held_out, rounded
from millrace.operators import vectors as op
from millrace.plans.predict import held_sql
from millrace.plans.registry import Tables, query


@query(
    "v01_normalise",
    """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos
                  FROM embeddings),
            n AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM x GROUP BY 1)
       SELECT vec_id, pos, floor(x / norm * 1e6 + 0.5) / 1e6 AS x FROM x JOIN n USING (vec_id)""",
)
def _(t: Tables):
    unit = op.normalise(t("embeddings", "vec_id", "embedding"), "embedding")
    long = unit.select("vec_id", F.posexplode("unit").alias("pos", "x"))
    return long.withColumn("x", rounded(F.col("x"), 6))


@query(
    "v02_centroids",
    """SELECT label, pos, floor(avg(x) * 1e6 + 0.5) / 1e6 AS mean FROM
       (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
       GROUP BY 1, 2""",
)
def _(t: Tables):
    out = op.centroids(t("embeddings", "label", "embedding"), "label", "embedding")
    return out.withColumn("mean", rounded(F.col("mean"), 6))


NEAREST_SQL = """x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
                              generate_subscripts(embedding, 1) AS pos FROM embeddings),
    c AS (SELECT label AS class, pos, avg(x) AS mean FROM x GROUP BY 1, 2),
    d AS (SELECT vec_id, x.label, class, sum((x - mean) * (x - mean)) AS d
          FROM x JOIN c USING (pos) GROUP BY 1, 2, 3),
    pred AS (SELECT vec_id, label, class AS prediction FROM d
             QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, class) = 1)"""


def centroid_labels(t: Tables):
    rows = t("embeddings")
    cents = op.centroids(rows, "label", "embedding")
    return op.nearest_centroid(rows, cents, "embedding", "vec_id").select("vec_id", "label", "prediction")


query("v03_nearest_centroid", f"WITH {NEAREST_SQL} SELECT * FROM pred")(centroid_labels)


def vectors(t: Tables):
    return t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


KNN_SQL = """near AS (SELECT a.vec_id AS id, b.vec_id AS other, b.label,
        round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS distance
        FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id
        QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY distance, b.vec_id) <= 5)"""


@query(
    "v04_knn_vote",
    f"""WITH {KNN_SQL} SELECT id, label AS prediction, count(*) AS votes FROM near GROUP BY id, label
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1""",
)
def _(t: Tables):
    return op.knn_vote(vectors(t), None, 5)


@query("v05_knn_lsh")
def _(t: Tables):
    return op.knn_lsh(vectors(t), None, 5)


def planted_vectors(t: Tables):
    """The embeddings moved towards a corner of their class, so that there is a signal to learn."""
    moved = F.transform("embedding", lambda x, i: x + F.when(i == F.col("label"), 1.0).otherwise(0.0).cast("float"))
    return t("embeddings").select(
        F.col("vec_id").alias("id"), moved.alias("vec"), "label", held_out("vec_id", 0.25).alias("held_out")
    )


def _fit(kind, **params):
    def build(t: Tables):
        rows = planted_vectors(t)
        model = op.fit_multiclass(rows.filter(~F.col("held_out")), kind, **params)
        right = (F.col("label") == F.col("prediction")).cast("double")
        return op.predict(model, rows).groupBy("held_out", "label").agg(F.count("*").alias("n"), (F.avg(right) > 0.5).alias("learned"))

    return build


#: Rows by class, and that more than half of them are told apart from nine other classes.
LEARNED_SQL = f"SELECT {held_sql('vec_id', 0.25)} AS held_out, label, count(*) AS n, TRUE AS learned FROM embeddings GROUP BY ALL"


query("v06_multiclass_logistic", LEARNED_SQL)(_fit("logistic", maxIter=30))
query("v06_multiclass_forest", LEARNED_SQL)(_fit("forest"))
query("v06_multiclass_perceptron", LEARNED_SQL)(_fit("perceptron", layers=[64, 10]))

query("v07_confusion", f"WITH {NEAREST_SQL} SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2")(
    lambda t: op.confusion(centroid_labels(t))
)


@query(
    "v07_class_report",
    f"""WITH {NEAREST_SQL},
        k AS (SELECT label AS class FROM pred UNION SELECT prediction FROM pred),
        r AS (SELECT class, (SELECT count(*) FROM pred WHERE label = class) AS support,
              (SELECT count(*) FROM pred WHERE prediction = class) AS predicted,
              (SELECT count(*) FROM pred WHERE label = class AND prediction = class) AS correct FROM k)
        SELECT *, correct / nullif(predicted, 0) AS "precision", correct / nullif(support, 0) AS recall,
               2 * correct / nullif(predicted + support, 0) AS f1 FROM r""",
)
def _(t: Tables):
    return op.class_report(centroid_labels(t))
