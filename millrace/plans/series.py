"""S queries on the events table."""

from pyspark.sql import functions as F

from millrace.functions import money, rounded_all
from millrace.operators import series as op
from millrace.operators.predict import regression_report
from millrace.plans.registry import Tables, query
from millrace.sources import stage

DAILY_SQL = """daily AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day,
        CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS y FROM events GROUP BY 1, 2),
    days AS (SELECT unnest(generate_series((SELECT min(day) FROM daily), (SELECT max(day) FROM daily),
             INTERVAL 1 DAY)) AS day),
    grid AS (SELECT user_id, day, y FROM (SELECT DISTINCT user_id FROM daily) CROSS JOIN days
             LEFT JOIN daily USING (user_id, day))"""


def daily(t: Tables):
    y = F.sum(money("value")).cast("double")
    made = op.bucket(t("events", "ts", "user_id", "value"), "ts", "1 day", {"y": y}, ["user_id"])
    return made.withColumnRenamed("bucket", "day")


def grid(t: Tables):
    """User by day; the daily sums are read three times, so they are written once.

    A user has as many rows as there are days, so windows over it need no splitting.
    """
    return op.regularise(stage(daily(t)), ["user_id"], "day", "1 day")


def r(x, d=7):
    return f"floor(({x}) * 1e{d} + 0.5) / 1e{d}"


@query(
    "s01_calendar",
    """SELECT event_id, hour(ts) AS hour, isodow(ts) AS weekday, day(ts) AS day, month(ts) AS month, year(ts) AS year,
       CAST(isodow(ts) >= 6 AS INTEGER) AS weekend FROM events""",
)
def _(t: Tables):
    return op.calendar(t("events", "event_id", "ts"), "ts").drop("ts")


def measures():
    return {"n": F.count("*"), "total": F.sum(money("value")).cast("double"), "peak": F.max("value")}


BUCKET_SQL = "count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total, max(value) AS peak"


@query(
    "s02_tumbling",
    f"SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bucket, {BUCKET_SQL} FROM events GROUP BY 1, 2",
)
def _(t: Tables):
    return op.bucket(t("events", "ts", "event_type", "value"), "ts", "1 hour", measures(), ["event_type"])


@query(
    "s02_sliding",
    f"""SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours(6 * k) AS bucket, {BUCKET_SQL}
        FROM events, (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY 1""",
)
def _(t: Tables):
    return op.bucket(t("events", "ts", "value"), "ts", "24 hours", measures(), slide="6 hours")


@query("s03_regularise", f"WITH {DAILY_SQL} SELECT * FROM grid")
def _(t: Tables):
    return grid(t)


@query(
    "s04_forward_fill",
    f"""WITH {DAILY_SQL} SELECT *, last_value(y IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM grid""",
)
def _(t: Tables):
    return op.fill(grid(t), ["user_id"], "day", "y", "forward", rows_per_task=None)


@query(
    "s04_linear_fill",
    f"""WITH {DAILY_SQL}, x AS (SELECT *, CASE WHEN y IS NOT NULL THEN day END AS known FROM grid),
        z AS (SELECT *, last_value(known IGNORE NULLS) OVER b AS ta, last_value(y IGNORE NULLS) OVER b AS va,
            first_value(known IGNORE NULLS) OVER a AS tb, first_value(y IGNORE NULLS) OVER a AS vb FROM x
            WINDOW b AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   a AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT user_id, day, y, {r("coalesce(y, va + (vb - va) * (epoch(day) - epoch(ta)) / (epoch(tb) - epoch(ta)))")}
            AS filled FROM z""",
)
def _(t: Tables):
    return rounded_all(op.fill(grid(t), ["user_id"], "day", "y", "linear", rows_per_task=None), 7, "filled")


@query(
    "s05_lags",
    f"""WITH {DAILY_SQL} SELECT *, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7, lead(y, 1) OVER w AS lead_1,
        y - lag(y, 1) OVER w AS diff, (y - lag(y, 1) OVER w) / nullif(lag(y, 1) OVER w, 0) AS change
        FROM grid WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
)
def _(t: Tables):
    return op.lags(grid(t), ["user_id"], "day", "y", [1, 7], [1], rows_per_task=None)


@query(
    "s06_rolling_rows",
    f"""SELECT event_id, {r("avg(value) OVER w")} AS roll_mean, {r("stddev_samp(value) OVER w")} AS roll_std,
        min(value) OVER w AS roll_min, max(value) OVER w AS roll_max FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(t: Tables):
    rows = op.rolling(t("events", "event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value", 7)
    return rounded_all(rows, 7, "roll_mean", "roll_std").drop("user_id", "ts", "value")


@query(
    "s06_rolling_time",
    f"""SELECT event_id, count(*) OVER w AS roll_n, {r("avg(value) OVER w")} AS roll_mean,
          {r("stddev(value) OVER w", 6)} AS roll_std, min(value) OVER w AS roll_min, max(value) OVER w AS roll_max
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)""",
)
def _(t: Tables):
    rows = op.rolling_time(t("events", "event_id", "user_id", "ts", "value"), ["user_id"], "ts", "value", 86400)
    return rounded_all(rounded_all(rows, 7, "roll_mean"), 6, "roll_std").drop("user_id", "ts", "value")


SPAN, ALPHA = 7, 0.3
EWM_TOP = " + ".join(f"coalesce(lag(y, {i}) OVER w * {(1 - ALPHA) ** i!r}, 0)" for i in range(SPAN))
EWM_LOW = " + ".join(f"CASE WHEN lag(y, {i}) OVER w IS NOT NULL THEN {(1 - ALPHA) ** i!r} ELSE 0 END" for i in range(SPAN))


@query(
    "s07_ewm",
    f"""WITH {DAILY_SQL} SELECT user_id, day, y, {r(f"({EWM_TOP})::DOUBLE / nullif(({EWM_LOW})::DOUBLE, 0)")} AS ewm
        FROM grid WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
)
def _(t: Tables):
    return rounded_all(op.ewm(grid(t), ["user_id"], "day", "y", ALPHA, SPAN, rows_per_task=None), 7, "ewm")


@query(
    "s08_seasonal",
    f"""SELECT event_id, value, isodow(ts) AS weekday, hour(ts) AS hour, {r("avg(value) OVER w", 10)} AS expected,
        {r("value - avg(value) OVER w", 10)} AS anomaly FROM events WINDOW w AS (PARTITION BY isodow(ts), hour(ts))""",
)
def _(t: Tables):
    rows = op.seasonal(t("events", "event_id", "ts", "value"), "ts", "value").drop("ts")
    return rounded_all(rows, 10, "expected", "anomaly")


ACF_LAGS = [1, 2, 7]


@query(
    "s09_acf",
    f"WITH {DAILY_SQL}, l AS (SELECT *, "
    + ", ".join(f"lag(y, {k}) OVER (PARTITION BY user_id ORDER BY day) AS l{k}" for k in ACF_LAGS)
    + " FROM grid) "
    + " UNION ALL ".join(
        f"SELECT user_id, {k} AS lag, count(y + l{k}) AS pairs, {r(f'corr(y, l{k})')} AS acf FROM l GROUP BY 1"
        for k in ACF_LAGS
    ),
)
def _(t: Tables):
    return rounded_all(op.acf(grid(t), ["user_id"], "day", "y", ACF_LAGS, rows_per_task=None), 7, "acf")


LIMIT = 60.0


@query(
    "s10_episodes",
    f"""WITH h AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bucket, max(value) AS v FROM events GROUP BY 1, 2),
        x AS (SELECT *, lag(bucket) OVER (PARTITION BY event_type ORDER BY bucket) AS b FROM h WHERE v > {LIMIT}),
        e AS (SELECT *, sum(CASE WHEN b IS NULL OR bucket - b > INTERVAL 1 HOUR THEN 1 ELSE 0 END)
              OVER (PARTITION BY event_type ORDER BY bucket)::BIGINT AS episode FROM x)
        SELECT event_type, episode, min(bucket) AS start, max(bucket) AS "end", count(*) AS n, max(v) AS peak
        FROM e GROUP BY 1, 2""",
)
def _(t: Tables):
    hourly = op.bucket(t("events", "ts", "event_type", "value"), "ts", "1 hour", {"v": F.max("value")}, ["event_type"])
    return op.episodes(hourly, ["event_type"], "bucket", "v", LIMIT, 3600, rows_per_task=None)


@query(
    "s10_episodes_overall",
    f"""WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, max(value) AS v FROM events GROUP BY 1),
        x AS (SELECT *, lag(bucket) OVER (ORDER BY bucket) AS b FROM h WHERE v > 150),
        e AS (SELECT *, sum(CASE WHEN b IS NULL OR bucket - b > INTERVAL 1 HOUR THEN 1 ELSE 0 END)
              OVER (ORDER BY bucket)::BIGINT AS episode FROM x)
        SELECT episode, min(bucket) AS start, max(bucket) AS "end", count(*) AS n, max(v) AS peak FROM e GROUP BY 1""",
)
def _(t: Tables):
    hourly = op.bucket(t("events", "ts", "value"), "ts", "1 hour", {"v": F.max("value")})
    return op.episodes(stage(hourly), [], "bucket", "v", 150.0, 3600)


@query(
    "s11_asof",
    """SELECT c.event_id, c.user_id, c.ts, v.event_id AS view_id, v.ts AS view_ts
       FROM (SELECT * FROM events WHERE event_type = 'click') c
       ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND c.ts >= v.ts""",
)
def _(t: Tables):
    rows = t("events", "event_id", "user_id", "ts", "event_type")
    clicks, views = (rows.filter(f"event_type = '{k}'").drop("event_type") for k in ("click", "view"))
    return op.asof(
        clicks, views, ["user_id"], "ts", {"event_id": "view_id", "ts": "view_ts"}, ["event_id"], how="inner"
    )


CUTS = ["2024-01-15", "2024-01-20", "2024-01-25"]


@query(
    "s12_time_split",
    " UNION ALL ".join(
        f"""SELECT event_id, {i} AS fold, CASE WHEN ts < TIMESTAMP '{c}' THEN 'train' ELSE 'test' END AS role
            FROM events WHERE {f"ts < TIMESTAMP '{CUTS[i + 1]}'" if i + 1 < len(CUTS) else "TRUE"}"""
        for i, c in enumerate(CUTS)
    ),
)
def _(t: Tables):
    return op.time_split(t("events", "event_id", "ts"), "ts", CUTS).drop("ts")


@query(
    "s13_naive",
    f"""WITH {DAILY_SQL} SELECT *, lag(y, 1) OVER w AS naive, lag(y, 7) OVER w AS seasonal_naive FROM grid
        WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
)
def _(t: Tables):
    return op.naive(grid(t), ["user_id"], "day", "y", 7, rows_per_task=None)


def planted_cycle(t: Tables):
    """Hourly means per event type of a daily sine with trend, moved a little by the event's value."""
    day = (F.dayofmonth("ts") - 1) * 0.5
    y = 50 + 20 * F.sin(F.hour("ts") * (3.141592653589793 / 12)) + day + 0.02 * F.col("value")
    rows = t("events", "ts", "event_type", "value").withColumn("y", y)
    made = op.bucket(rows, "ts", "1 hour", {"y": F.avg("y")}, ["event_type"])
    return op.regularise(stage(made), ["event_type"], "bucket", "1 hour")


ORIGINS = ["2024-01-15", "2024-01-20", "2024-01-25"]
AHEAD = 4
CYCLE_SQL = f"""h AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bucket,
        avg(50 + 20 * sin(hour(ts) * (3.141592653589793::DOUBLE / 12)) + (day(ts) - 1) * 0.5::DOUBLE + 0.02::DOUBLE * value) AS y FROM events GROUP BY 1, 2),
    hours AS (SELECT unnest(generate_series((SELECT min(bucket) FROM h), (SELECT max(bucket) FROM h), INTERVAL 1 HOUR)) AS bucket),
    grid AS (SELECT event_type, bucket, y FROM (SELECT DISTINCT event_type FROM h) CROSS JOIN hours LEFT JOIN h USING (event_type, bucket)),
    lagged AS (SELECT *, lag(y, 24) OVER (PARTITION BY event_type ORDER BY bucket) AS season FROM grid),
    folds AS (SELECT column_fold AS fold, column_a AS a, column_b AS b FROM (VALUES {", ".join(
        f"({i}, TIMESTAMP '{o}', TIMESTAMP '{(ORIGINS + ['2100-01-01'])[i + 1]}')" for i, o in enumerate(ORIGINS))}) AS v(column_fold, column_a, column_b)),
    tests AS (SELECT fold, bucket, a, y, season FROM lagged JOIN folds ON bucket >= a AND bucket < b WHERE y IS NOT NULL AND season IS NOT NULL)"""


@query(
    "s14_forecast",
    f"""WITH {CYCLE_SQL} SELECT fold, count(*) AS n, {r("sqrt(avg((y - season) * (y - season)))", 6)} AS seasonal_rmse,
          TRUE AS regression_better, TRUE AS trees_better, count(*) FILTER (bucket < a + INTERVAL {AHEAD} HOUR) AS n_ahead, TRUE AS ahead_better
        FROM tests GROUP BY fold""",
)
def _(t: Tables):
    """Rolling origins: models fitted before each, against the value of one day before, step by step and some hours ahead."""
    cycle = stage(planted_cycle(t))
    rows = stage(op.forecast_features(cycle, ["event_type"], "bucket", "y", 24, rows_per_task=None))
    start = cycle.agg(F.min("bucket")).scalar()
    split = op.time_split(rows, "bucket", ORIGINS)
    test = split.filter("role = 'test' AND y IS NOT NULL AND lag_season IS NOT NULL")
    seasonal = regression_report(test, "y", "lag_season", ["fold"]).select("fold", "n", F.col("rmse").alias("seasonal_rmse"))
    scores = []
    for fold, origin in enumerate(ORIGINS):
        train = stage(split.filter(f"role = 'train' AND fold = {fold}"))
        judged = test.filter(f"fold = {fold}")
        models = {"linear": op.fit_forecast(train, "y"), "forest": op.fit_forecast(train, "y", "forest", numTrees=8, maxDepth=4)}
        step = {kind: regression_report(m.apply(judged), "y", "prediction", ["fold"]).select("fold", F.col("rmse").alias(kind)) for kind, m in models.items()}
        before = cycle.filter(f"bucket < timestamp_ntz'{origin}'")
        ahead = op.forecast_ahead(models["linear"], before, ["event_type"], "bucket", "y", 24, AHEAD, "1 hour", start)
        ahead = judged.join(ahead, ["event_type", "bucket"])
        far = [regression_report(ahead, "y", p, ["fold"]).select("fold", F.col("n").alias("n_ahead"), F.col("rmse").alias(f"far_{p}")) for p in ("prediction", "lag_season")]
        scores.append(step["linear"].join(step["forest"], "fold").join(far[0], "fold").join(far[1].drop("n_ahead"), "fold"))
    every = scores[0].unionByName(scores[1]).unionByName(scores[2])
    out = seasonal.join(every, "fold").select(
        "fold", "n", "seasonal_rmse", (F.col("linear") < F.col("seasonal_rmse")).alias("regression_better"), (F.col("forest") < F.col("seasonal_rmse")).alias("trees_better"),
        "n_ahead", (F.col("far_prediction") < F.col("far_lag_season")).alias("ahead_better"),
    )
    return rounded_all(out, 6, "seasonal_rmse")
