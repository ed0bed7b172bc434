"""E: checking binary models. Input rows are ``(label 0/1, score double)``.

Curves are computed over distinct scores: rows are counted per score first, and
running counts over the scores are spread by ``running``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import hash_share, key_hash
from millrace.operators.features import assemble, bin
from millrace.operators.ordered import ROWS_PER_TASK, global_position, running
from millrace.sources import stage


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class, share, and the weight that balances the classes."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.select(
        label, "n",
        (F.col("n") / whole["rows"]).alias("share"),
        (whole["rows"] / (whole["classes"] * F.col("n"))).alias("weight"),
    )


def downsample(df: DataFrame, key: str, ratio: float, label: str = "label") -> DataFrame:
    """All positives, and negatives whose hash falls below ``ratio`` negatives per positive."""
    n = df.agg(
        F.struct(F.sum(F.col(label)).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    ).scalar()
    keep = F.try_divide(n["pos"] * F.lit(float(ratio)), n["neg"])
    return df.filter((F.col(label) == 1) | (hash_share(key) < keep))


def folds(df: DataFrame, key: str, k: int, strata: str, out: str = "fold", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Fold 0..k-1, dealt in turn inside each class in hash order; sizes differ by at most one."""
    rows = df.withColumn("_h", key_hash(key))
    placed = running(rows, [strata], ["_h", key], {"_at": F.lit(1)}, include_current=False, rows_per_task=rows_per_task)
    return placed.withColumn(out, F.pmod("_at", F.lit(k)).cast("int")).drop("_h", "_at")


def sweep(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts when score >= threshold is called positive.

    Rows are counted per interval between thresholds; the sums then run over as
    many rows as there are thresholds.
    """
    cuts = sorted(set(thresholds))
    counts = bin(df, "score", cuts, "_i").groupBy("_i").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")
    )
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, float(c)) for i, c in enumerate([float("-inf"), *cuts])], "_i int, threshold double")
    rows = grid.join(counts, "_i", "left").na.fill(0, ["pos", "neg"]).withColumn("_all", F.lit(0))
    up = W.partitionBy("_all").orderBy(F.desc("_i"))
    whole = W.partitionBy("_all")
    return (
        rows.select(
            "threshold", "_i",
            F.sum("pos").over(up).alias("tp"),
            F.sum("neg").over(up).alias("fp"),
            F.sum("pos").over(whole).alias("_p"),
            F.sum("neg").over(whole).alias("_n"),
        )
        .filter("_i > 0")
        .select("threshold", "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn"), (F.col("_n") - F.col("fp")).alias("tn"))
    )


def curve(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per distinct score: its positives and negatives, those at or above it, and all of them. Rows without a score are left out."""
    points = df.filter(F.col("score").isNotNull() & ~F.isnan("score")).groupBy("score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    points = stage(points.withColumn("_down", -F.col("score")))
    out = running(
        points, [], ["_down"],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        {"p": F.col("pos"), "n": F.col("neg")},
        rows_per_task=rows_per_task,
    )
    return out.drop("_down")


def roc(df: DataFrame, **kw) -> DataFrame:
    """True and false positive rate at each distinct score."""
    c = curve(df, **kw)
    return c.select(
        F.col("score").alias("threshold"),
        "tp", "fp",
        F.try_divide("tp", "p").alias("tpr"),
        F.try_divide("fp", "n").alias("fpr"),
    )


def auc(df: DataFrame, **kw) -> DataFrame:
    """Exact area under the ROC curve; a tied pair counts one half."""
    c = curve(df, **kw)
    # Twice the pairs won, as whole numbers.
    won = F.sum((F.col("neg") * (2 * F.col("tp") - F.col("pos"))).cast("decimal(38,0)")).cast("double")
    return c.agg(
        F.max("p").alias("positives"),
        F.max("n").alias("negatives"),
        F.try_divide(won, 2.0 * F.max("p") * F.max("n")).alias("auc"),
    )


def pr(df: DataFrame, **kw) -> DataFrame:
    """Precision and recall at each distinct score."""
    c = curve(df, **kw)
    return c.select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "p").alias("recall"),
    )


def average_precision(df: DataFrame, **kw) -> DataFrame:
    """Mean precision over the positives."""
    c = curve(df, **kw)
    step = F.try_divide("pos", "p") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return c.agg(F.sum(step).alias("average_precision"))


def ks(df: DataFrame, **kw) -> DataFrame:
    """Largest gap between the two rates, and the highest score where it occurs."""
    gap = F.abs(F.col("tpr") - F.col("fpr"))
    best = roc(df, **kw).agg(F.max(F.struct(gap.alias("ks"), F.col("threshold"))).alias("b"))
    return best.select("b.ks", "b.threshold")


def lift(df: DataFrame, n: int, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Gains table over n equal groups from the highest score down, ties by key."""
    rows = df.withColumn("_down", -F.col("score"))
    placed = global_position(rows, "_down", key, "_at", "_total", rows_per_task)
    group = F.floor(F.col("_at") * n / F.col("_total")).cast("bigint") + 1
    counts = placed.groupBy(group.alias("bucket")).agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"),
        F.lit(0).alias("_all"),
    )
    whole, so_far = W.partitionBy("_all"), W.partitionBy("_all").orderBy("bucket")
    rate = F.sum("positives").over(whole) / F.sum("n").over(whole)
    return counts.select(
        "bucket", "n", "positives", "min_score", "max_score",
        F.try_divide(F.sum("positives").over(so_far), F.sum("positives").over(whole)).alias("gain"),
        F.try_divide(F.col("positives") / F.col("n"), rate).alias("lift"),
    )


def calibration(df: DataFrame, bins: int) -> DataFrame:
    """Rows, mean score and share of positives per equal-width bin of a 0..1 score."""
    at = F.least(F.width_bucket("score", F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins)).cast("int")
    return df.groupBy(at.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg("score").alias("mean_score"),
        F.avg(F.col("label").cast("double")).alias("share_positive"),
    )


def brier(df: DataFrame) -> DataFrame:
    """Mean squared gap between score and label."""
    gap = F.col("score") - F.col("label")
    return df.agg(F.count("*").alias("n"), F.avg(gap * gap).alias("brier"))


def psi(a: DataFrame, b: DataFrame, col: str, edges: Sequence[float], floor: float = 1e-6) -> DataFrame:
    """Population stability index of ``col`` between two samples; empty bins count as ``floor``."""
    both = a.select(F.col(col).alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        b.select(F.col(col).alias("x"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = bin(both, "x", edges).groupBy("bin").agg(
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.lit(0).alias("_all")
    )
    whole = W.partitionBy("_all")
    p = F.greatest(F.try_divide(F.col("n_a"), F.sum("n_a").over(whole)), F.lit(floor))
    q = F.greatest(F.try_divide(F.col("n_b"), F.sum("n_b").over(whole)), F.lit(floor))
    shares = counts.select("bin", "n_a", "n_b", p.alias("p"), q.alias("q"))
    return shares.agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"),
        F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))).alias("psi"),
    )


def fit_binary(train: DataFrame, cols: Sequence[str], weight: str | None = None, label: str = "label", **params) -> LogisticRegressionModel:
    """Logistic regression, optionally with row weights."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, **params)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(assemble(train, cols))
