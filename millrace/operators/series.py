"""S: time-series analysis and prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import micros, seconds_between
from millrace.operators.ordered import (
    carried,
    join_by,
    neighbours_window,
    running,
)
from millrace.operators.predict import apply, fit_linear, fit_trees
from millrace.operators.tables import top_k
from millrace.sources import stage


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Hour, weekday (Monday 1 to Sunday 7), day, month, year and weekend flag."""
    weekday = F.weekday(ts) + 1
    return df.select(
        "*",
        F.hour(ts).alias("hour"),
        weekday.alias("weekday"),
        F.dayofmonth(ts).alias("day"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        (weekday >= 6).cast("int").alias("weekend"),
    )


def bucket(
    df: DataFrame, ts: str, size: str, aggs: Mapping[str, Column], keys: Sequence[str] = (), slide: str | None = None
) -> DataFrame:
    """Aggregates per tumbling or sliding time bucket, named by its start ``bucket``."""
    grouped = df.groupBy(*keys, F.window(ts, size, slide)).agg(*[e.alias(n) for n, e in aggs.items()])
    return grouped.select(*keys, F.col("window.start").alias("bucket"), *aggs)


def regularise(df: DataFrame, by: Sequence[str], ts: str, step: str) -> DataFrame:
    """Every key at every step from the first to the last of the table, NULL where absent.

    ``ts`` must lie on the grid, one row per key and step. The grid is one sequence per key.
    """
    ends = df.agg(F.struct(F.min(ts).alias("a"), F.max(ts).alias("b"))).scalar()
    grid = df.select(*by).distinct().withColumn(ts, F.explode(F.sequence(ends["a"], ends["b"], F.expr(f"interval {step}"))))
    return join_by(grid, df, [*by, ts], "left")


def fill(df: DataFrame, by: Sequence[str], ts: str, value: str, kind: str, **kw) -> DataFrame:
    """``filled``: the last known value ("forward"), or the straight line between the
    known neighbours ("linear"), which leaves the ends NULL."""
    if kind == "forward":
        return carried(df, by, [ts], {"filled": F.col(value)}, **kw)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))
    rows = carried(df, by, [ts], {"_a": point}, {"_b": point}, **kw)
    a, b = F.col("_a"), F.col("_b")
    part = F.try_divide(seconds_between(F.col(ts), a["t"]), seconds_between(b["t"], a["t"]))
    line = a["v"] + (b["v"] - a["v"]) * part
    return rows.withColumn("filled", F.coalesce(F.col(value).cast("double"), line)).drop("_a", "_b")


def lags(df: DataFrame, by: Sequence[str], ts: str, value: str, ks: Sequence[int], leads: Sequence[int] = (), **kw) -> DataFrame:
    """Values k rows back and ahead, and difference and relative change to the row before."""

    def made(w):
        back = {f"lag_{k}": F.lag(value, k).over(w) for k in ks}
        ahead = {f"lead_{k}": F.lead(value, k).over(w) for k in leads}
        one = F.lag(value, 1).over(w)
        return back | ahead | {"diff": F.col(value) - one, "change": F.try_divide(F.col(value) - one, one)}

    return neighbours_window(df, by, [ts], made, before=max([1, *ks]), after=max([0, *leads]), **kw)


def rolling(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, rows: int, **kw) -> DataFrame:
    """Mean, deviation, least and largest of the last ``rows`` rows."""

    def made(w):
        w = w.rowsBetween(1 - rows, 0)
        return {
            "roll_mean": F.avg(value).over(w),
            "roll_std": F.stddev(value).over(w),
            "roll_min": F.min(value).over(w),
            "roll_max": F.max(value).over(w),
        }

    return neighbours_window(df, by, order, made, before=rows - 1, **kw)


def rolling_time(df: DataFrame, by: Sequence[str], ts: str, value: str, seconds: int, **kw) -> DataFrame:
    """Count, mean, deviation, least and largest over the last ``seconds``, both ends included.

    A RANGE frame visits every row of every window. Here time is cut into blocks of
    ``seconds``: a window is the start of its own block up to the row, and the rest of
    the block before. Rows of the block before join the block shifted by ``seconds``,
    where "still in the window" means "at or after the row", so both parts are running
    aggregates, and a key is spread over its blocks. Both parts' moments are taken about
    the mean of the two blocks, so they add up without losing digits to a large level.
    """
    reach = seconds * 1_000_000
    at = F.when(F.col(ts).isNotNull(), micros(F.col(ts)))
    block = F.floor(at / reach)
    places = F.array(
        F.struct(F.lit(1).alias("own"), block.alias("block"), at.alias("pos")),
        F.struct(F.lit(0).alias("own"), (block + 1).alias("block"), (at + reach).alias("pos")),
    )
    rows = df.withColumn("_p", F.explode(places)).select(
        *df.columns, F.col("_p.own").alias("_own"), F.col("_p.block").alias("_block"), F.col("_p.pos").alias("_at")
    )
    rows = rows.filter("_own = 1 OR _at IS NOT NULL").withColumn("_back", -F.col("_at"))
    level = rows.groupBy(*by, "_block").agg(F.avg(value).alias("_level"))
    rows = join_by(rows, level, [*by, "_block"]).withColumn("_x", F.col(value) - F.col("_level"))
    for own, order, mark in ((1, "_at", "a"), (0, "_back", "b")):
        x = F.when(F.col("_own") == own, F.col("_x"))
        rows = running(
            rows, [*by, "_block"], [order], {f"_n{mark}": x.isNotNull().cast("int"), f"_s{mark}": x, f"_q{mark}": x * x},
            tops={f"_m{mark}": F.when(x.isNotNull(), F.col(value)), f"_l{mark}": F.when(x.isNotNull(), -F.col(value))},
            peers=True, **kw,
        )
    n, total, squares = (F.col(f"_{c}a") + F.col(f"_{c}b") for c in "nsq")
    spread = F.greatest(squares - F.try_divide(total * total, n), F.lit(0.0))
    return rows.filter("_own = 1").select(
        *df.columns,
        n.alias("roll_n"),
        (F.col("_level") + F.try_divide(total, n)).alias("roll_mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("roll_std"),
        (-F.greatest("_la", "_lb")).alias("roll_min"),
        F.greatest("_ma", "_mb").alias("roll_max"),
    )


def ewm(df: DataFrame, by: Sequence[str], ts: str, value: str, alpha: float, span: int, **kw) -> DataFrame:
    """Mean of the last ``span`` rows with weights falling by 1 - alpha; missing values are left out."""

    def made(w):
        past = [(F.lag(value, i).over(w), (1 - alpha) ** i) for i in range(span)]
        top = sum((F.coalesce(v * f, F.lit(0.0)) for v, f in past), F.lit(0.0))
        low = sum((F.when(v.isNotNull(), f).otherwise(0.0) for v, f in past), F.lit(0.0))
        return {"ewm": F.when(low > 0, F.try_divide(top, low))}

    return neighbours_window(df, by, [ts], made, before=span - 1, **kw)


def seasonal(df: DataFrame, ts: str, y: str) -> DataFrame:
    """Mean for the row's weekday and hour (168 groups), and the row's distance from it."""
    keyed = df.withColumn("weekday", F.weekday(ts) + 1).withColumn("hour", F.hour(ts))
    means = keyed.groupBy("weekday", "hour").agg(F.avg(y).alias("expected"))
    return keyed.join(F.broadcast(means), ["weekday", "hour"]).withColumn("anomaly", F.col(y) - F.col("expected"))


def acf(df: DataFrame, by: Sequence[str], ts: str, value: str, ks: Sequence[int], **kw) -> DataFrame:
    """Correlation of a series with itself k rows back: ``(by, lag, pairs, acf)``."""
    rows = lags(df, by, ts, value, ks, **kw)
    found = rows.groupBy(*by).agg(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("lag"),
                    F.count(F.col(value) + F.col(f"lag_{k}")).alias("pairs"),
                    F.corr(value, f"lag_{k}").alias("acf"),
                )
                for k in ks
            ]
        ).alias("x")
    )
    return found.select(*by, F.explode("x").alias("x")).select(*by, "x.*")


def episodes(df: DataFrame, by: Sequence[str], ts: str, value: str, limit: float, step: int, **kw) -> DataFrame:
    """Runs of readings above ``limit`` at most ``step`` seconds apart: start, end, length, peak."""
    high = df.filter(F.col(value) > limit)
    gap = lambda w: {"_before": F.lag(ts).over(w)}
    rows = neighbours_window(high, by, [ts], gap, before=1, **kw)
    begins = F.col("_before").isNull() | (seconds_between(F.col(ts), F.col("_before")) > step)
    placed = running(rows, by, [ts], {"episode": begins.cast("int")}, **kw)
    return placed.groupBy(*by, "episode").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"), F.max(value).alias("peak")
    )


def asof(
    a: DataFrame, b: DataFrame, by: Sequence[str], ts: str, take: Mapping[str, str], tie: Sequence[str] = (),
    how: str = "left", **kw,
) -> DataFrame:
    """Each row of ``a`` with the last row of ``b`` of its key at or before its time.

    ``take`` maps columns of ``b`` to output names; ``tie`` orders rows of ``b`` at one time.
    Both tables pass through one ordered scan; there is no join on time. Rows of ``b`` without
    a time or a key are no one's earlier reading; rows of ``a`` without one find none.
    """
    placed = F.col(ts).isNotNull()
    for c in by:
        placed = placed & F.col(c).isNotNull()
    b = b.filter(placed)
    picked = F.struct(*[F.col(c).alias(n) for c, n in take.items()])
    left = a.select(F.lit(1).alias("_side"), *by, ts, F.struct(*a.columns).alias("_row"))
    right = b.select(F.lit(0).alias("_side"), *by, ts, picked.alias("_found"), F.struct(F.lit(0), *tie).alias("_tie"))
    both = left.unionByName(right, allowMissingColumns=True)
    seen = carried(both, by, [ts, "_side", "_tie"], {"_last": F.col("_found")}, **kw).filter("_side = 1")
    if how == "inner":
        seen = seen.filter(F.col("_last").isNotNull())
    return seen.select("_row.*", *[F.col("_last")[n].alias(n) for n in take.values()])


def time_split(df: DataFrame, ts: str, cuts: Sequence[str]) -> DataFrame:
    """Rolling-origin folds. In fold i the rows before cut i are "train", those from cut i
    to the next cut are "test"; a row appears once per fold it belongs to."""
    at = [F.expr(f"timestamp_ntz'{c}'") for c in cuts]
    parts = []
    for i, cut in enumerate(at):
        inside = F.col(ts) >= cut if i + 1 == len(at) else (F.col(ts) >= cut) & (F.col(ts) < at[i + 1])
        role = F.when(F.col(ts) < cut, "train").when(inside, "test")
        parts.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    folds = F.filter(F.array(*parts), lambda p: p["role"].isNotNull())
    return df.withColumn("_f", F.explode(folds)).select(*df.columns, "_f.fold", "_f.role")


def naive(df: DataFrame, by: Sequence[str], ts: str, value: str, period: int, **kw) -> DataFrame:
    """Forecasts by the last value and by the value one period back, on a regular grid."""
    made = lambda w: {"naive": F.lag(value, 1).over(w), "seasonal_naive": F.lag(value, period).over(w)}
    return neighbours_window(df, by, [ts], made, before=max(1, period), **kw)


FORECAST_COLUMNS = ["lag_1", "lag_season", "past_mean", "sin_hour", "cos_hour", "weekday", "age"]


def _clock(ts: str, start: Column) -> list[Column]:
    """Columns that the time alone gives: hour of day as an angle, weekday (Monday 1), days since ``start``."""
    angle = F.hour(ts) * (3.141592653589793 / 12)
    return [
        F.sin(angle).alias("sin_hour"),
        F.cos(angle).alias("cos_hour"),
        (F.weekday(ts) + 1).cast("double").alias("weekday"),
        (seconds_between(F.col(ts), start) / 86400).alias("age"),
    ]


def forecast_features(df: DataFrame, by: Sequence[str], ts: str, y: str, period: int, **kw) -> DataFrame:
    """Features known before each row: lags, the mean of the last period, hour of day, weekday, age."""

    def made(w):
        return {
            "lag_1": F.lag(y, 1).over(w),
            "lag_season": F.lag(y, period).over(w),
            "past_mean": F.avg(y).over(w.rowsBetween(-period, -1)),
        }

    rows = neighbours_window(df, by, [ts], made, before=period, **kw)
    return rows.select("*", *_clock(ts, df.agg(F.min(ts)).scalar()))


@dataclass
class Forecaster:
    """A fitted model; ``change`` says that it predicts the change against one period before."""

    model: Model
    change: bool

    def apply(self, rows: DataFrame) -> DataFrame:
        out = apply(self.model, rows, FORECAST_COLUMNS)
        return out.withColumn("prediction", F.col("prediction") + F.col("lag_season")) if self.change else out


def fit_forecast(train: DataFrame, y: str, kind: str = "linear", **params) -> Forecaster:
    """A model on ``forecast_features``: "linear", or "forest" or "boosted" trees, which learn
    the change against one period before, as they cannot follow a trend. Rows without full history are left out."""
    known = train.filter(F.col(y).isNotNull())
    if kind == "linear":
        return Forecaster(fit_linear(known, FORECAST_COLUMNS, y), False)
    changes = known.filter(F.col("lag_season").isNotNull()).withColumn("_change", F.col(y) - F.col("lag_season"))
    return Forecaster(fit_trees(changes, FORECAST_COLUMNS, "_change", kind, **params), True)


def forecast_ahead(
    model: Forecaster, history: DataFrame, by: Sequence[str], ts: str, y: str, period: int, steps: int, step: str, start: Column
) -> DataFrame:
    """(by, ts, ahead, prediction) for the next ``steps`` steps of every series after the last row of ``history``.

    A forecast is the next row's lag. Each series is one row with its last ``period`` values (a missing value is its
    mean so far), so a step reads and writes one row per series, whatever the history. ``start`` is where ages count from.
    """
    recent = top_k(history, period, [F.desc(ts)], by)
    past = F.transform(F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(y).alias("v")))), lambda p: p["v"])
    state = recent.groupBy(*by).agg(F.max(ts).alias(ts), past.alias("_past"), F.avg(y).alias("_mean"))
    state = state.filter(F.col("_mean").isNotNull())
    state = stage(state.select(*by, ts, F.transform("_past", lambda v: F.coalesce(v, F.col("_mean"))).alias("_past")))
    out = None
    for ahead in range(1, steps + 1):
        mean = F.aggregate("_past", F.lit(0.0), lambda s, v: s + v) / F.size("_past")
        rows = state.withColumn(ts, F.col(ts) + F.expr(f"interval {step}")).select(
            *by, ts, "_past", F.element_at("_past", -1).alias("lag_1"), F.element_at("_past", 1).alias("lag_season"), mean.alias("past_mean"), *_clock(ts, start)
        )
        done = model.apply(rows)
        next_past = F.concat(F.when(F.size("_past") >= period, F.slice("_past", 2, period)).otherwise(F.col("_past")), F.array(F.col("prediction")))
        state = stage(done.select(*by, ts, next_past.alias("_past"), "prediction"))
        rows = state.select(*by, ts, F.lit(ahead).alias("ahead"), "prediction")
        state = state.drop("prediction")
        out = rows if out is None else out.unionByName(rows)
    return out
