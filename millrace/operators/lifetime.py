"""L: lifetime of units, from their event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import AFTSurvivalRegression, AFTSurvivalRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import micros, seconds_between
from millrace.operators.features import assemble
from millrace.operators.ordered import ROWS_PER_TASK, carried, neighbours_window, running

from millrace.sources import stage


def unit_features(df: DataFrame, by: Sequence[str], ts: str, state: str, states: Sequence[str], value: str) -> DataFrame:
    """One row per unit: events, span, value statistics and a count per state."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_events"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        (seconds_between(F.max(ts), F.min(ts)) / 3600).alias("span_hours"),
        F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
        *[F.count(F.when(F.col(state) == s, 1)).alias(f"n_{s}") for s in states],
    )


def sessions(df: DataFrame, by: Sequence[str], ts: str, gap: int) -> DataFrame:
    """Sessions separated by ``gap`` or more idle seconds.

    Events in one fixed slot of ``gap`` seconds are always in one session, so they
    are reduced to first, last and count per (unit, slot) first. What is left per
    unit is bounded by the time covered, however many events a unit has.
    """
    slots = df.groupBy(*by, F.floor(micros(F.col(ts)) / (gap * 1_000_000)).alias("_slot")).agg(
        F.min(ts).alias("_a"), F.max(ts).alias("_b"), F.count("*").alias("_n")
    )
    order = W.partitionBy(*by).orderBy("_slot")
    idle = seconds_between(F.col("_a"), F.lag("_b").over(order))
    begun = slots.withColumn("_new", F.coalesce((idle >= gap).cast("int"), F.lit(1)))
    numbered = begun.withColumn("session", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "session").agg(
        F.min("_a").alias("start"), F.max("_b").alias("end"), F.sum("_n").alias("n_events")
    )


def state_time(df: DataFrame, by: Sequence[str], order: Sequence[str], state: str, **kw) -> DataFrame:
    """Seconds from each event to the unit's next one, summed per state."""
    ts = order[0]
    rows = neighbours_window(df, by, order, lambda w: {"_next": F.lead(ts).over(w)}, after=1, **kw)
    spent = seconds_between(F.col("_next"), F.col(ts)).cast("decimal(20,6)")
    return rows.groupBy(*by, state).agg(
        F.count("*").alias("n_visits"), F.coalesce(F.sum(spent).cast("double"), F.lit(0.0)).alias("seconds")
    )


def remaining_life(df: DataFrame, by: Sequence[str], order: Sequence[str], end: Column, **kw) -> DataFrame:
    """Seconds from each row to the next end event at or after it. Rows with no such event
    are censored: the time to the unit's last row, with ``observed`` = 0."""
    ts = order[0]
    rows = carried(df, by, order, coming={"_end": F.when(end, F.col(ts))}, final={"_last": F.col(ts)}, **kw)
    return rows.select(
        *df.columns,
        seconds_between(F.coalesce("_end", "_last"), F.col(ts)).alias("remaining"),
        F.col("_end").isNotNull().cast("int").alias("observed"),
    )


def snapshot(df: DataFrame, ts: str, cut: str, back: str, by: Sequence[str], state: str, states: Sequence[str], value: str) -> DataFrame:
    """``unit_features`` of the window of length ``back`` that ends just before ``cut``."""
    at = F.expr(f"timestamp_ntz'{cut}'")
    inside = (F.col(ts) >= F.expr(f"timestamp_ntz'{cut}' - interval {back}")) & (F.col(ts) < at)
    return unit_features(df.filter(inside), by, ts, state, states, value)


def survival(df: DataFrame, t: str, died: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Life table with the Kaplan-Meier estimate at each distinct time.

    Rows are counted per time first; the running sums over times are spread.
    """
    counts = stage(
        df.groupBy(F.col(t).alias("t")).agg(F.sum(died).alias("died"), F.sum(1 - F.col(died)).alias("censored"))
    )
    gone = F.col("died") + F.col("censored")
    table = running(counts, [], ["t"], {"_gone": gone}, {"_all": gone}, include_current=False, rows_per_task=rows_per_task)
    table = stage(table.select("t", "died", "censored", (F.col("_all") - F.col("_gone")).alias("at_risk")))
    stay = 1 - F.col("died") / F.col("at_risk")
    out = running(
        table, [], ["t"],
        {"_log": F.when(stay > 0, F.log(stay)).otherwise(0.0), "_none_left": (stay <= 0).cast("int")},
        rows_per_task=rows_per_task,
    )
    return out.select(
        "t", "at_risk", "died", "censored",
        F.when(F.col("_none_left") > 0, 0.0).otherwise(F.exp("_log")).alias("survival"),
    )


def fit_lifetime(train: DataFrame, cols: Sequence[str], t: str, died: str) -> AFTSurvivalRegressionModel:
    """Weibull accelerated-failure-time model; ``died`` is 1 for an observed end, 0 if censored."""
    rows = assemble(train.withColumn("_seen", F.col(died).cast("double")), cols)
    return AFTSurvivalRegression(labelCol=t, censorCol="_seen").fit(rows)
