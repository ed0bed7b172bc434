"""F: feature preparation for tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import global_position, join_by, quantiles, running
from millrace.sources import stage


def _one(df: DataFrame, aggs: Mapping[str, Column]) -> Column:
    """Aggregates of a whole table as one struct-valued scalar subquery."""
    return df.agg(F.struct(*[e.alias(n) for n, e in aggs.items()])).scalar()


def _quantiles(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float]) -> dict[str, Column]:
    """Quantiles of several columns from one pass, each column's as a struct-valued scalar subquery."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], [*cols], "column", "value")
    found = stage(quantiles(long, ["column"], "value", dict(probs)).select("column", *probs))
    return {c: found.filter(F.col("column") == c).agg(F.first(F.struct(*probs))).scalar() for c in cols}


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """missing values per column, from one pass."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols],
    )
    long = counts.unpivot(["n_rows"], cols, "column", "n_missing")
    return long.withColumn("share", F.try_divide(F.col("n_missing"), F.col("n_rows")))


def impute(df: DataFrame, spec: Mapping[str, str | tuple]) -> DataFrame:
    """fill with "mean", "median", "mode" or ("constant", x); ``<col>_missing`` tells which rows."""
    out = df
    for c, rule in spec.items():
        if rule == "mean":
            value = df.agg(F.avg(c)).scalar()
        elif rule == "median":
            value = _quantiles(df, [c], {"median": 0.5})[c]["median"]
        elif rule == "mode":
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
            value = counts.agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c)))).scalar()
        else:
            value = F.lit(rule[1])
        out = out.withColumn(f"{c}_missing", F.col(c).isNull()).withColumn(c, F.coalesce(F.col(c), value))
    return out


def impute_by(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """fill with the mean of the row's group. Group means combine per task, then join."""
    means = df.groupBy(*keys).agg(F.avg(col).alias("_mean"))
    joined = join_by(df, means, keys, "left").withColumn(f"{col}_missing", F.col(col).isNull())
    return joined.withColumn(col, F.coalesce(col, "_mean")).drop("_mean")


def category_index(df: DataFrame, col: str) -> DataFrame:
    """``(col, n, index)``: 0 for the most frequent category, ties by name."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    placed = global_position(counts.withColumn("_down", -F.col("n")), "_down", col, "index", "_total")
    return placed.select(col, "n", F.col("index").cast("bigint").alias("index"))


def index_category(df: DataFrame, col: str) -> DataFrame:
    """rows with ``<col>_index``; NULL categories get NULL."""
    table = category_index(df, col).select(col, F.col("index").alias(f"{col}_index"))
    return join_by(df, table, [col], "left")


def one_hot(df: DataFrame, col: str, values: Mapping[str, str]) -> DataFrame:
    """a 0/1 column per stated value; ``values`` maps value to column name."""
    return df.select("*", *[F.coalesce((F.col(col) == v).cast("int"), F.lit(0)).alias(n) for v, n in values.items()])


def bin(df: DataFrame, col: str, edges: Sequence[float], out: str = "bin") -> DataFrame:
    """number of ``edges`` at or below the value: 0 to len(edges); NULL stays NULL."""
    edges = sorted(set(edges))
    splits = [-float("inf"), *edges, float("inf")]
    if len(splits) < 3:
        return df.withColumn(out, F.when(F.col(col).isNotNull(), F.lit(0)))
    tmp = df.withColumn("_x", F.coalesce(F.col(col).cast("double"), F.lit(0.0)))
    tmp = Bucketizer(splits=splits, inputCol="_x", outputCol=out, handleInvalid="keep").transform(tmp).drop("_x")
    return tmp.withColumn(out, F.when(F.col(col).isNotNull(), F.col(out).cast("int")))


def width_bins(df: DataFrame, col: str, low: float, high: float, n: int, out: str = "bin") -> DataFrame:
    """1 to n for equal widths from ``low`` to ``high``, 0 below and n + 1 from ``high`` on."""
    return df.withColumn(out, F.width_bucket(F.col(col), F.lit(low), F.lit(high), F.lit(n)).cast("int"))


def quantile_edges(df: DataFrame, col: str, n: int) -> list[float]:
    """the n - 1 exact inner edges of n equally filled bins."""
    probs = {f"q{i}": i / n for i in range(1, n)}
    row = quantiles(df.select(F.col(col).cast("double").alias(col)), [], col, probs).first()
    return [row[q] for q in probs if row[q] is not None]


def target_encode(df: DataFrame, col: str, y: str, m: float, fold: str, out: str = "encoded") -> DataFrame:
    """mean target of the category over the other folds, shrunk to their overall mean."""
    parts = df.groupBy(col, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    per_fold = parts.groupBy(fold).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    whole = _one(parts, {"s": F.sum("_s"), "n": F.sum("_n")})
    zero = F.lit(0.0)
    prior = per_fold.select(
        fold, F.try_divide(whole["s"] - F.coalesce("_fs", zero), whole["n"] - F.col("_fn")).alias("_prior")
    )
    per_cat = parts.groupBy(col).agg(F.sum("_s").alias("_cs"), F.sum("_n").alias("_cn"))
    table = join_by(join_by(parts, per_cat, [col]), prior, [fold]).select(
        col,
        fold,
        F.try_divide(
            F.coalesce("_cs", zero) - F.coalesce("_s", zero) + m * F.col("_prior"), F.col("_cn") - F.col("_n") + m
        ).alias(out),
    )
    return join_by(df, table, [col, fold])


def history_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, out: str = "history", **kw) -> DataFrame:
    """mean of ``y`` over earlier rows of the same entity; NULL for the first."""
    sums = {"_hs": F.col(y), "_hn": F.col(y).isNotNull().cast("int")}
    rows = running(df, by, order, sums, include_current=False, **kw)
    return rows.withColumn(out, F.try_divide(F.col("_hs").cast("double"), F.col("_hn"))).drop("_hs", "_hn")


def scale(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """"standard" (sample deviation), "minmax" or "robust" (median and IQR); constant columns give NULL."""
    if kind == "robust":
        found = _quantiles(df, cols, {"a": 0.25, "b": 0.5, "c": 0.75})
        made = {c: F.try_divide(F.col(c) - q["b"], q["c"] - q["a"]) for c, q in found.items()}
    else:
        aggs = {}
        for c in cols:
            x = F.col(c).cast("double")
            aggs |= {f"a_{c}": F.avg(x), f"s_{c}": F.stddev(x), f"lo_{c}": F.min(x), f"hi_{c}": F.max(x)}
        if kind == "standard":
            aggs = {n: e for n, e in aggs.items() if n[:2] in ("a_", "s_")}
            one = _one(df, aggs)
            made = {c: F.try_divide(F.col(c) - one[f"a_{c}"], one[f"s_{c}"]) for c in cols}
        else:
            aggs = {n: e for n, e in aggs.items() if n[:3] in ("lo_", "hi_")}
            one = _one(df, aggs)
            made = {c: F.try_divide(F.col(c) - one[f"lo_{c}"], one[f"hi_{c}"] - one[f"lo_{c}"]) for c in cols}
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in df.columns])


def clip(df: DataFrame, col: str, rule: str, factor: float) -> DataFrame:
    """``<col>_outlier`` and ``<col>_clipped``; bounds by "iqr" or "z" (sample deviation)."""
    if rule == "iqr":
        q = _quantiles(df, [col], {"a": 0.25, "c": 0.75})[col]
        low = q["a"] - factor * (q["c"] - q["a"])
        high = q["c"] + factor * (q["c"] - q["a"])
    else:
        one = _one(df, {"m": F.avg(col), "s": F.stddev(col)})
        low, high = one["m"] - factor * one["s"], one["m"] + factor * one["s"]
    rows = df.withColumn("_low", low).withColumn("_high", high)
    inside = F.when(F.col(col).isNotNull(), F.greatest(F.least(F.col(col), F.col("_high")), F.col("_low")))
    outside = (F.col(col) < F.col("_low")) | (F.col(col) > F.col("_high"))
    return rows.withColumn(f"{col}_outlier", outside).withColumn(f"{col}_clipped", inside).drop("_low", "_high")


def log_target(df: DataFrame, y: str, out: str = "log_y") -> DataFrame:
    """``log1p`` of a skewed target above -1."""
    return df.withColumn(out, F.log1p(F.col(y)))


def unlog_target(df: DataFrame, y: str, out: str) -> DataFrame:
    """the inverse of ``log_target``, for predictions."""
    return df.withColumn(out, F.expm1(F.col(y)))


def correlations(df: DataFrame, cols: Sequence[str], y: str | None = None) -> DataFrame:
    """``(a, b, corr)`` of each pair from one pass; with ``y``, pairs (column, y) ranked by size."""
    pairs = [(c, y) for c in cols if c != y] if y else list(combinations(cols, 2))
    one = df.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"))
                for a, b in pairs
            ]
        ).alias("p")
    )
    long = one.select(F.explode("p").alias("p")).select("p.*")
    if not y:
        return long
    # One row per column of the table.
    return long.withColumn("rank", F.expr("row_number() OVER (PARTITION BY b ORDER BY abs(corr) DESC NULLS LAST, a)"))


def balanced(df: DataFrame) -> DataFrame:
    """Training rows, computed once and written, on at least as many partitions as there are cores.

    Trees read their input once per level, each pass as slow as the largest partition. Only files are
    asked for their partitions: asking a plan that shuffles would run it.
    """
    rows, cores = stage(df), df.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """a model vector; rows with a missing feature are left out."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)
