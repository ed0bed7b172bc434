"""Ordered work per key that stays spread out when one key holds much of the table.

A ``Window`` sends all rows of a key to one task. The helpers here count rows per
key first. The rows of all keys above ``ROWS_PER_TASK`` are range-partitioned by key and
order into as many chunks as their number asks for; all other keys stay whole. Spark
draws the borders on the real columns, so any type that sorts can be an order, and
further order columns part the rows that share a value of the first. Windows then run per
(key, chunk), and what must cross a chunk border travels in a table with a few rows per chunk:

* ``running``     sums so far: totals of the earlier chunks are added
* ``carried``     last (or next) non-null value: taken from the nearest chunk that has one
* ``with_halo``   a fixed number of neighbouring rows: copied from the next chunks

When no key is hot the plan is the ordinary window. A key-less order (``by=[]``)
is always cut. Keys are counted, joined and cut as tables; none reaches the driver. The
cut rows are written once to the shared folder, since borders are drawn from a sample and
windows and totals must see the same ones. Counting reads the input once more, so callers
write an input that is costly to compute first (``sources.stage``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.sources import stage

ROWS_PER_TASK = 5_000_000
MIN_CHUNKS = 8
CHUNK = "_chunk"
HALO = "_halo"


@dataclass
class Layout:
    """Rows with the columns a window has to be partitioned by."""

    df: DataFrame
    keys: list[str]
    split: bool

    @property
    def parts(self) -> list[str]:
        return [*self.keys, CHUNK] if self.split else self.keys


def join_by(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left keys.

    The right keys get other names first: both sides often come from one table.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    cond = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def lay_out(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> Layout:
    """Add a chunk column if some key holds more rows than one task should.

    Rows that are equal in ``order`` share a chunk. ``rows_per_task=None`` says that keys are
    known to be small, for example on a time grid, and saves the counting job. Rows without a key
    are one key that is never known to be small.
    """
    keys = list(by)
    if rows_per_task is None:
        if keys:
            return Layout(df, keys, split=False)
        rows_per_task = ROWS_PER_TASK
    if keys:
        counts = stage(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task))
        rows = counts.agg(F.sum("_n")).first()[0]
        if not rows:
            return Layout(df, keys, split=False)
        hot, cold = (join_by(df, counts.select(*keys), keys, how) for how in ("left_semi", "left_anti"))
    else:
        rows, hot, cold = df.count(), df, None
    wanted = max(MIN_CHUNKS, math.ceil(rows / rows_per_task))
    cut = stage(hot.repartitionByRange(wanted, *keys, *order).withColumn(CHUNK, F.spark_partition_id()))
    return Layout(cut if cold is None else cold.withColumn(CHUNK, F.lit(-1)).unionByName(cut), keys, True)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    include_current: bool = True,
    rows_per_task: int | None = ROWS_PER_TASK,
    tops: dict[str, Column] | None = None,
    peers: bool = False,
) -> DataFrame:
    """H1: sums (and ``tops``: largest values) over the rows so far of each key in ascending
    ``order``, and sums per key (``totals``).

    Empty sums are 0. ``order`` must be total within a key, unless ``peers`` asks for all
    rows up to and including those with an equal value of a single order column.
    """
    # Rows that count together must lie in one chunk.
    lay = lay_out(df, by, order[:1] if peers else order, rows_per_task)
    sums, totals, tops = sums or {}, totals or {}, tops or {}
    local = W.partitionBy(*lay.parts)
    frame = local.orderBy(*order)
    if peers:
        frame = frame.rangeBetween(W.unboundedPreceding, W.currentRow)
    else:
        frame = frame.rowsBetween(W.unboundedPreceding, 0 if include_current else -1)
    zero = F.lit(0)
    out = lay.df.select(
        "*",
        *[F.coalesce(F.sum(e).over(frame), zero).alias(n) for n, e in sums.items()],
        *[F.max(e).over(frame).alias(n) for n, e in tops.items()],
        *([] if lay.split else [F.coalesce(F.sum(e).over(local), zero).alias(n) for n, e in totals.items()]),
    )
    if not lay.split:
        return out
    per_chunk = lay.df
    if lay.keys:
        per_chunk = per_chunk if totals else per_chunk.filter(F.col(CHUNK) >= 0)
    per_chunk = per_chunk.groupBy(*lay.parts).agg(
        F.lit(0).alias("_none"),
        *[F.sum(e).alias(f"_s_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_m_{n}") for n, e in tops.items()],
        *[F.sum(e).alias(f"_t_{n}") for n, e in totals.items()],
    )
    key = W.partitionBy(*lay.keys) if lay.keys else W.partitionBy("_none")
    before = key.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    shift = per_chunk.select(
        *lay.parts,
        *[F.sum(f"_s_{n}").over(before).alias(f"_s_{n}") for n in sums],
        *[F.max(f"_m_{n}").over(before).alias(f"_m_{n}") for n in tops],
        *[F.sum(f"_t_{n}").over(key).alias(f"_t_{n}") for n in totals],
    )
    return join_by(out, shift, lay.parts, "left").select(
        *df.columns,
        *[(F.col(n) + F.coalesce(f"_s_{n}", zero)).alias(n) for n in sums],
        *[F.greatest(n, f"_m_{n}").alias(n) for n in tops],
        *[F.coalesce(f"_t_{n}", zero).alias(n) for n in totals],
    )


def global_position(
    df: DataFrame, first: str, second: str, name: str, total: str, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """0-based place of each row in ascending (first, second) order, and the number of rows.

    Counted over the distinct values of ``first``, then inside each value, so a
    value that many rows share is cut like any hot key.
    """
    counts = stage(df.groupBy(first).agg(F.count("*").alias("_n")))
    above = running(counts, [], [first], {"_above": F.col("_n")}, {total: F.col("_n")}, False, rows_per_task)
    rows = join_by(df, above.drop("_n"), [first])
    placed = running(rows, [first], [second], {"_in": F.lit(1)}, None, False, rows_per_task)
    return placed.withColumn(name, F.col("_above") + F.col("_in")).drop("_above", "_in")


def carried(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    last: dict[str, Column] | None = None,
    coming: dict[str, Column] | None = None,
    final: dict[str, Column] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """``last``: the last non-null value at or before each row; ``coming``: the first at or after
    it; ``final``: the last non-null value of the key."""
    lay = lay_out(df, by, order, rows_per_task)
    last, coming, final = last or {}, coming or {}, final or {}
    w = W.partitionBy(*lay.parts).orderBy(*order)
    past = w.rowsBetween(W.unboundedPreceding, 0)
    # A frame from the current row to the end costs the square of the rows; a reversed
    # order with a frame from the start does not.
    back = W.partitionBy(*lay.parts).orderBy(*[F.desc(c) for c in order])
    future = back.rowsBetween(W.unboundedPreceding, 0)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = lay.df.select(
        "*",
        *[F.last(e, ignorenulls=True).over(past).alias(n) for n, e in last.items()],
        *[F.last(e, ignorenulls=True).over(future).alias(n) for n, e in coming.items()],
        *[] if lay.split else [F.last(e, ignorenulls=True).over(whole).alias(n) for n, e in final.items()],
    )
    if not lay.split:
        return out
    place = F.struct(*order)
    per_chunk = lay.df
    if lay.keys and not final:
        per_chunk = per_chunk.filter(F.col(CHUNK) >= 0)
    per_chunk = per_chunk.groupBy(*lay.parts).agg(
        F.lit(0).alias("_none"),
        *[F.max_by(e, F.when(e.isNotNull(), place)).alias(f"_v_{n}") for n, e in (last | final).items()],
        *[F.min_by(e, F.when(e.isNotNull(), place)).alias(f"_v_{n}") for n, e in coming.items()],
    )
    key = W.partitionBy(*(lay.keys or ["_none"])).orderBy(CHUNK)
    before = key.rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy(*(lay.keys or ["_none"])).orderBy(F.desc(CHUNK)).rowsBetween(W.unboundedPreceding, -1)
    shift = per_chunk.select(
        *lay.parts,
        *[F.last(f"_v_{n}", ignorenulls=True).over(before).alias(f"_v_{n}") for n in last],
        *[F.last(f"_v_{n}", ignorenulls=True).over(after).alias(f"_v_{n}") for n in coming],
        *[
            F.last(f"_v_{n}", ignorenulls=True).over(key.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias(n)
            for n in final
        ],
    )
    return join_by(out, shift, lay.parts, "left").select(
        *df.columns, *[F.coalesce(n, f"_v_{n}").alias(n) for n in [*last, *coming]], *final
    )


def with_halo(lay: Layout, order: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
    """Rows plus, for each chunk, copies of the neighbouring rows just outside it.

    Copies carry ``_halo`` = true; run the window per ``lay.parts``, then drop them.
    A chunk lists at most ``before`` + ``after`` of its rows, whatever its size.
    """
    plain = lay.df.withColumn(HALO, F.lit(False))
    if not lay.split:
        return plain
    cols = [c for c in lay.df.columns if c not in lay.parts]
    rest = [c for c in cols if c not in order]
    hot = lay.df.filter(F.col(CHUNK) >= 0).withColumn("_none", F.lit(0))
    key = W.partitionBy(*(lay.keys or ["_none"]))

    def copies(n: int, earlier: bool) -> DataFrame:
        last_first = [F.desc(c) if earlier else F.asc(c) for c in order]
        ends = (
            hot.withColumn("_r", F.row_number().over(W.partitionBy(*lay.parts).orderBy(*last_first)))
            .filter(F.col("_r") <= n)
            .groupBy(*lay.parts, "_none")
            .agg(F.collect_list(F.struct(*order, *rest)).alias("_rows"))
        )
        near = key.orderBy(F.asc(CHUNK) if earlier else F.desc(CHUNK)).rowsBetween(-n, -1)
        outside = F.flatten(F.collect_list("_rows").over(near))
        nearest = F.slice(F.sort_array(outside, asc=not earlier), 1, n)
        return (
            ends.select(*lay.parts, nearest.alias("_near"))
            .select(*lay.parts, F.explode("_near").alias("_row"))
            .select(*lay.parts, "_row.*")
            .withColumn(HALO, F.lit(True))
        )

    if before:
        plain = plain.unionByName(copies(before, earlier=True))
    if after:
        plain = plain.unionByName(copies(after, earlier=False))
    return plain


def neighbours_window(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Callable[[W], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead."""
    lay = lay_out(df, by, order, rows_per_task)
    rows = with_halo(lay, order, before, after)
    made = columns(W.partitionBy(*lay.parts).orderBy(*order))
    out = rows.select("*", *[c.alias(n) for n, c in made.items()])
    return out.filter(~F.col(HALO)).select(*df.columns, *made)


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """Exact interpolated quantiles per key, plus ``rows`` and ``distinct``.

    The ``percentile`` aggregate keeps every distinct value of a group in one buffer.
    Here equal values are counted first, positions come from ``running``, and the
    final aggregate only picks the values next to each wanted position.
    """
    counted = stage(df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n")))
    return counted_quantiles(counted, by, value, "_n", probs, rows_per_task)


def counted_quantiles(
    counted: DataFrame, by: Sequence[str], value: str, n: str, probs: dict[str, float], rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """``quantiles`` of values that are counted already: ``value`` occurs ``n`` times."""
    placed = running(
        counted, by, [value], {"_cum": F.col(n)}, {"_total": F.col(n)}, rows_per_task=rows_per_task
    )
    picks = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(p)
        picks += [
            F.min(F.when(F.col("_cum") > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
        ]
    out = placed.groupBy(*by).agg(
        F.max("_total").alias("rows"), F.count("*").alias("distinct"), *picks
    )

    def interpolated(name: str, p: float) -> Column:
        at = (F.col("rows") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (at - F.floor(at))).alias(name)

    return out.select(*by, "rows", "distinct", *[interpolated(n, p) for n, p in probs.items()])
