"""L queries: users as units, an error event as the end of a life."""

from pyspark.sql import functions as F

from millrace.functions import rounded_all, unit_interval
from millrace.operators import lifetime as op
from millrace.plans.predict import found_near, near_sql
from millrace.plans.registry import Tables, query
from millrace.plans.series import r
from millrace.plans.tables import EVENT_TYPES

UNIT_SQL = f"""user_id, count(*) AS n_events, min(ts) AS first_ts, max(ts) AS last_ts,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE / 3600 AS span_hours,
    {r("avg(value)", 10)} AS mean_value, max(value) AS max_value, """ + ", ".join(
    f"count(*) FILTER (event_type = '{e}') AS n_{e}" for e in EVENT_TYPES
)


def log(t: Tables):
    return t("events", "event_id", "user_id", "ts", "event_type", "value")


@query("l01_unit_features", f"SELECT {UNIT_SQL} FROM events GROUP BY 1")
def _(t: Tables):
    out = op.unit_features(log(t), ["user_id"], "ts", "event_type", EVENT_TYPES, "value")
    return rounded_all(out, 10, "mean_value")


@query(
    "l02_sessions",
    """WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session FROM x)
       SELECT user_id, session, min(ts) AS start, max(ts) AS "end", count(*) AS n_events FROM s GROUP BY 1, 2""",
)
def _(t: Tables):
    return op.sessions(log(t), ["user_id"], "ts", 6 * 3600)


@query(
    "l03_state_time",
    """WITH x AS (SELECT user_id, event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))
                  - epoch_us(ts) AS us FROM events)
       SELECT user_id, event_type, count(*) AS n_visits, coalesce(sum(us), 0)::BIGINT / 1e6 AS seconds FROM x GROUP BY 1, 2""",
)
def _(t: Tables):
    return op.state_time(log(t), ["user_id"], ["ts", "event_id"], "event_type")


LIFE_SQL = """life AS (SELECT event_id, user_id, ts,
        first_value(CASE WHEN event_type = 'error' THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id
            ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e,
        max(ts) OVER (PARTITION BY user_id) AS last_ts FROM events),
    lives AS (SELECT event_id, user_id, ts, (epoch_us(coalesce(e, last_ts)) - epoch_us(ts)) / 1e6 AS remaining,
        CAST(e IS NOT NULL AS INTEGER) AS observed FROM life)"""


def lives(t: Tables):
    end = F.col("event_type") == "error"
    return op.remaining_life(log(t), ["user_id"], ["ts", "event_id"], end).select(
        "event_id", "user_id", "ts", "remaining", "observed"
    )


@query("l04_remaining_life", f"WITH {LIFE_SQL} SELECT * FROM lives")
def _(t: Tables):
    return lives(t)


@query(
    "l05_snapshot",
    f"""SELECT {UNIT_SQL} FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND ts < TIMESTAMP '2024-01-20'
        GROUP BY 1""",
)
def _(t: Tables):
    out = op.snapshot(log(t), "ts", "2024-01-20", "7 days", ["user_id"], "event_type", EVENT_TYPES, "value")
    return rounded_all(out, 10, "mean_value")


@query(
    "l06_survival",
    f"""WITH {LIFE_SQL}, d AS (SELECT floor(remaining / 3600) AS t, observed FROM lives),
        c AS (SELECT t, sum(observed)::BIGINT AS died, sum(1 - observed)::BIGINT AS censored FROM d GROUP BY 1),
        n AS (SELECT *, sum(died + censored) OVER (ORDER BY t DESC)::BIGINT AS at_risk FROM c)
        SELECT CAST(t AS BIGINT) AS t, at_risk, died, censored,
            {r("product(1 - died / at_risk) OVER (ORDER BY t)", 9)} AS survival FROM n""",
)
def _(t: Tables):
    hours = lives(t).select(F.floor(F.col("remaining") / 3600).alias("t"), F.col("observed").alias("died"))
    return rounded_all(op.survival(hours, "t", "died"), 9, "survival")


def planted_lives(t: Tables):
    """Weibull times with log scale 2 + 1.5 x1 and shape 2, watched for 30 days."""
    x1 = F.col("o_totalprice") / 500000
    days = F.exp(2 + 1.5 * x1) * F.sqrt(-F.log(unit_interval("o_orderkey")))
    rows = t("orders", "o_orderkey", "o_totalprice").select(F.col("o_orderkey").alias("id"), x1.alias("x1"), days.alias("full"))
    return rows.select("id", "x1", F.least("full", F.lit(30.0)).alias("t"), (F.col("full") <= 30).cast("int").alias("died"))


LIFE_PLANTED = {"intercept": 2.0, "x1": 1.5, "scale": 0.5}


@query("l07_lifetime_model", near_sql(LIFE_PLANTED, "orders"))
def _(t: Tables):
    rows = planted_lives(t)
    model = op.fit_lifetime(rows, ["x1"], "t", "died")
    found = [("intercept", float(model.intercept)), ("x1", float(model.coefficients[0])), ("scale", float(model.scale))]
    return found_near(rows, found, LIFE_PLANTED, 0.15, rows.sparkSession)
