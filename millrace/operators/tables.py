"""T: bulk table operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from millrace.functions import hash_share, micros
from millrace.operators.ordered import ROWS_PER_TASK, counted_quantiles, join_by, running
from millrace.sources import stage


def select_where(df: DataFrame, pred: Column, exprs: Mapping[str, Column]) -> DataFrame:
    """Filter, then derived columns."""
    return df.filter(pred).select(*[e.alias(n) for n, e in exprs.items()])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Spark keeps one row per key and task before the shuffle."""
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")


def duplicates(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Sets of rows equal in ``cols``: lowest id and number of copies.

    Long values are shuffled as SHA-256 digests, counted per task first.
    """
    digest = F.concat_ws("|", *[F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("null")) for c in cols])
    return (
        df.groupBy(digest.alias("_digest"))
        .agg(F.min(id_col).alias(f"first_{id_col}"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .drop("_digest")
    )


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, Column, str]]) -> DataFrame:
    """Join a fact table to dimensions in turn. Spark picks the strategy from sizes."""
    return reduce(lambda left, d: left.join(d[0], d[1], d[2]), dims, fact)


def present(a: DataFrame, b: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Rows of ``a`` with a match in ``b``."""
    return a.join(b, on, "left_semi")


def missing(a: DataFrame, b: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Rows of ``a`` without a match in ``b``."""
    return a.join(b, on, "left_anti")


def band(df: DataFrame, bands: DataFrame, col: str, width: float) -> DataFrame:
    """Join each row to the bands with ``lo <= col < hi``.

    Bands are listed once per grid cell of ``width`` that they touch, so the join
    is an equi-join on the cell and Spark need not compare every row with every band.
    The caller's bands are a short list and go to every executor; rows stay where they are.
    """
    cell = lambda x: F.floor(x / F.lit(width))
    cells = bands.withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    rows = df.withColumn("_cell", cell(F.col(col)))
    return rows.join(F.broadcast(cells), "_cell").filter((F.col("lo") <= F.col(col)) & (F.col(col) < F.col("hi"))).drop("_cell")


def summarise(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Grouped aggregates."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, rsd: float | None = None) -> DataFrame:
    """T10 exact, or T11 approximate when ``rsd`` is given."""
    count = F.count_distinct(col) if rsd is None else F.approx_count_distinct(col, rsd)
    return df.groupBy(*keys).agg(count.alias("n_distinct"))


def subtotals(df: DataFrame, sets: str | Sequence[Sequence[str]], cols: Sequence[str], aggs) -> DataFrame:
    """``sets`` is "rollup", "cube" or a list of grouping sets over ``cols``."""
    if isinstance(sets, str):
        grouped = getattr(df, sets)(*cols)
    else:
        grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *cols)
    return grouped.agg(F.grouping_id().cast("bigint").alias("level"), *[e.alias(n) for n, e in aggs.items()])


def pivot(df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str], agg: Column) -> DataFrame:
    """Long to wide for a stated list of values."""
    return df.groupBy(*keys).pivot(col, list(values)).agg(agg)


def unpivot(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot([*keys], [*cols], name, value)


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] | None = None) -> DataFrame:
    """First k rows overall, or per group with their ``rank``.

    Both forms cut to k rows in every task before the shuffle.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ranked(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    tie: str,
    tiles: int = 4,
    share: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rank family by ascending ``value`` (``tie`` breaks ties) and share of the group.

    Where a group holds more rows than one task should, places have two levels: rows are
    counted by value, running counts over the values give ranks, and the place inside a value is counted
    apart. So a group is cut between its values, and a value that many rows share is cut by ``tie``.
    """
    share = F.col(value) if share is None else share
    small = bool(by) and not df.groupBy(*by).count().filter(F.col("count") > rows_per_task).limit(1).count()
    if small:
        part = W.partitionBy(*by)
        order = part.orderBy(value)
        local = df.select(
            "*",
            F.row_number().over(part.orderBy(value, tie)).alias("_rn"),
            F.rank().over(order).alias("_rank"),
            F.dense_rank().over(order).alias("_dense"),
            F.count("*").over(order.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("_upto"),
            F.count("*").over(part).alias("_n"),
            F.sum(share).over(part).alias("_sum"),
        )
    else:
        rows = stage(df.withColumn("_share", share))
        values = stage(rows.groupBy(*by, value).agg(F.count("*").alias("_c"), F.sum("_share").alias("_s")))
        sums, totals = {"_before": F.col("_c"), "_values": F.lit(1)}, {"_n": F.col("_c"), "_sum": F.col("_s")}
        values = running(values, by, [value], sums, totals, False, rows_per_task)
        found = join_by(rows.drop("_share"), values, [*by, value])
        local = running(found, [*by, value], [tie], {"_rn": F.lit(1)}, None, True, rows_per_task)
        local = local.withColumns(
            {"_rn": F.col("_rn") + F.col("_before"), "_rank": F.col("_before") + 1, "_dense": F.col("_values") + 1, "_upto": F.col("_before") + F.col("_c")}
        )
    rn, n = F.col("_rn"), F.col("_n")
    base, extra = F.floor(n / tiles), n % tiles
    long_rows = extra * (base + 1)
    tile = F.when(rn <= long_rows, F.ceil(rn / (base + 1))).otherwise(
        extra + F.ceil(F.try_divide(rn - long_rows, base))
    )
    return local.select(
        *df.columns,
        rn.cast("bigint").alias("row_number"),
        F.col("_rank").cast("bigint").alias("rank"),
        F.col("_dense").cast("bigint").alias("dense_rank"),
        F.when(n > 1, (F.col("_rank") - 1) / (n - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        (F.col("_upto") / n).alias("cume_dist"),
        tile.cast("bigint").alias("ntile"),
        F.try_divide(share.cast("double"), F.col("_sum").cast("double")).alias("share"),
    )


def set_op(a: DataFrame, b: DataFrame, kind: str) -> DataFrame:
    """Union / union_all / intersect / intersect_all / except / except_all, by column name."""
    b = b if kind.startswith("union") else b.select(*a.columns)
    ops = {
        "union_all": lambda: a.unionByName(b),
        "union": lambda: a.unionByName(b).distinct(),
        "intersect": lambda: a.intersect(b),
        "intersect_all": lambda: a.intersectAll(b),
        "except": lambda: a.subtract(b),
        "except_all": lambda: a.exceptAll(b),
    }
    return ops[kind]()


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row for each column of numbers, times, booleans or text, whatever its type.

    ``n_rows``, ``n_null``, ``n_distinct``; ``min_value`` and ``max_value`` as text, exact for whole numbers of any size,
    NULL for floating ones; and as doubles ``min_number``, ``p25``, ``p50``, ``p75``, ``max_number``: the number, seconds
    since 1970 of a time, NULL for text. Nulls and limits come from one aggregate without a shuffle of rows. Values
    of all columns are counted once, each as a whole number, a floating one or a text; quantiles follow from the counts.
    """
    types = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType, T.StringType))}
    cols = list(cols or types)

    def second(c: str) -> Column:
        ntz = F.col(c).cast("timestamp_ntz")
        return micros(ntz).cast("double") / 1e6

    def number(c: str) -> Column:
        if isinstance(types[c], T.DatetimeType):
            return second(c)
        return F.lit(None).cast("double") if isinstance(types[c], T.StringType) else F.col(c).cast("double")

    def typed(c: str) -> Column:
        kind, none = types[c], F.lit(None)
        floating = isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)
        whole = isinstance(kind, T.IntegralType)
        return F.struct(
            F.lit(c).alias("column"),
            (F.col(c) if whole else none).cast("bigint").alias("l"),
            (F.col(c) if floating else none).cast("double").alias("d"),
            (none if whole or floating else F.col(c)).cast("string").alias("s"),
            number(c).alias("number"),
        )

    def limits(c: str) -> Column:
        floating = isinstance(types[c], T.FractionalType) and not isinstance(types[c], T.DecimalType)
        text = lambda v: (F.lit(None) if floating else v).cast("string")
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("n_rows"), F.sum(F.col(c).isNull().cast("bigint")).alias("n_null"),
            text(F.min(c)).alias("min_value"), text(F.max(c)).alias("max_value"), F.min(number(c)).alias("min_number"), F.max(number(c)).alias("max_number"),
        )

    basic = df.agg(F.array(*[limits(c) for c in cols]).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    long = df.select(F.explode(F.array(*[typed(c) for c in cols])).alias("x")).select("x.*").filter("coalesce(l, d) IS NOT NULL OR s IS NOT NULL")
    counted = stage(long.groupBy("column", "l", "d", "s", "number").agg(F.count("*").alias("n")))
    distinct = counted.groupBy("column").agg(F.count("*").alias("n_distinct"))
    numbers = counted.filter("number IS NOT NULL").select("column", "number", "n")
    quart = counted_quantiles(numbers, ["column"], "number", "n", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("rows", "distinct")
    return basic.join(distinct, "column", "left").join(quart, "column", "left").select(
        "column", "n_rows", F.coalesce("n_null", F.lit(0)).alias("n_null"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "min_value", "max_value", "min_number", "p25", "p50", "p75", "max_number",
    )


def json_fields(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Fields of a JSON text column under a declared schema; bad text gives NULLs."""
    return df.withColumn("_json", F.from_json(col, schema)).select(*df.columns, "_json.*")


def sample(
    df: DataFrame, key: str, fraction: float, strata: str | None = None, fractions: Mapping[str, float] | None = None
) -> DataFrame:
    """The same rows on every run: keys whose hash falls below the wanted share."""
    u = hash_share(key)
    if strata is None:
        return df.filter(u < fraction)
    wanted = F.lit(fraction)
    for value, share in (fractions or {}).items():
        wanted = F.when(F.col(strata) == value, F.lit(share)).otherwise(wanted)
    return df.filter(u < wanted)


def clean_text(df: DataFrame, col: str, rules: Mapping[str, tuple]) -> DataFrame:
    """Derived text columns. A rule is ("trim",), ("lower",), ("upper",),
    ("word", n from 0), ("extract", pattern, group) or ("words",)."""
    made = {
        "trim": lambda c: F.trim(c),
        "lower": lambda c: F.lower(F.trim(c)),
        "upper": lambda c: F.upper(F.trim(c)),
        "word": lambda c, n: F.get(F.split(F.trim(c), r"\s+"), F.lit(n)),
        "extract": lambda c, pattern, group: F.regexp_extract(c, pattern, group),
        "words": lambda c: F.size(F.split(F.trim(c), r"\s+")),
    }
    return df.select("*", *[made[r[0]](F.col(col), *r[1:]).alias(n) for n, r in rules.items()])
