"""Windows, gap filling, kernel averages and interval joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.catalog.registry import UNWEIGHTED, approx, approx_sql, query, rounded
from daybook.operators import fill, joins, shape, stats, windows
from daybook.plans.measurements import daily_weight
from daybook.plans.strength import daily_volume as volume_job
from daybook.plans.strength import daily_volume_with_energy
from daybook.plans.strength import strength_metrics as strength_job
from daybook.plans.views import metric_trend, volume_trend

AS_OF = "2024-02-05"
_SERIES = ["exercise_name"]


@query("""SELECT exercise_name, date, set_order, round(max(one_rep_max) OVER (PARTITION BY exercise_name
    ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cummax FROM rated""")
def running_max(t):
    rows = windows.with_series_maxima(t.rated_sets, "one_rep_max", _SERIES, {"cummax": None})
    return rows.select("exercise_name", "date", "set_order", rounded("cummax"))


# NaN in place of every fifth order line's weight; in SQL it is NULL from the start.
_NAN_SQL = """SELECT * REPLACE (CASE WHEN set_order % 5 <> 0 THEN one_rep_max END AS one_rep_max) FROM rated"""


def _with_nan(t):
    nan = F.when(F.col("set_order") % 5 == 0, F.lit(float("nan")))
    return t.sets.withColumn("weight", F.coalesce(nan, "weight")).withColumn("body_mass", F.coalesce(nan, "body_mass"))


@query(f"""WITH r AS ({_NAN_SQL}) SELECT exercise_name, date, set_order, CASE WHEN max(one_rep_max) OVER (PARTITION BY
    exercise_name, date) IS NOT NULL THEN round(max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) END AS cummax FROM r""")
def running_max_nan(t):
    nan = F.when(F.col("set_order") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("one_rep_max"))
    rows = windows.with_series_maxima(t.rated_sets.withColumn("one_rep_max", nan), "one_rep_max", _SERIES, {"cummax": None})
    return rows.select("exercise_name", "date", "set_order", rounded("cummax"))


@query(f"""WITH r AS ({_NAN_SQL}) SELECT * FROM (SELECT date, exercise_name, reps, round(one_rep_max, 6) AS one_rep_max,
    round(max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cummax_one_rep_max,
    round(max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
        RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW), 6) AS rolling_90d_max FROM r) WHERE one_rep_max > 0""")
def strength_metrics_nan(t):
    rows = strength_job(_with_nan(t), unweighted=UNWEIGHTED)
    return rows.select("date", "exercise_name", "reps", rounded("one_rep_max"),
                       rounded("cummax_one_rep_max"), rounded("rolling_90d_max"))


@query("""SELECT exercise_name, date, set_order, round(max(one_rep_max) OVER (PARTITION BY exercise_name
    ORDER BY date RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW), 6) AS rolling_90d_max FROM rated""")
def trailing_max_90d(t):
    rows = windows.with_series_maxima(t.rated_sets, "one_rep_max", _SERIES, {"rolling_90d_max": 90})
    return rows.select("exercise_name", "date", "set_order", rounded("rolling_90d_max"))


@query("""SELECT exercise_name, date, set_order, one_rep_max = max(one_rep_max) OVER (PARTITION BY exercise_name
    ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS is_best_lift FROM rated""")
def best_in_30d(t):
    rows = windows.best_in_span(t.rated_sets, "one_rep_max", _SERIES, 30)
    return rows.select("exercise_name", "date", "set_order", "is_best_lift")


@query(f"""SELECT date, exercise_name, reps, round(one_rep_max, 6) AS one_rep_max,
    round(cummax, 6) AS cummax_one_rep_max, round(rolling, 6) AS rolling_90d_max FROM (
    SELECT *, max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cummax,
    max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
        RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW) AS rolling FROM rated)
    WHERE one_rep_max > 0""")
def strength_metrics(t):
    rows = strength_job(t.sets, unweighted=UNWEIGHTED)
    return rows.select("date", "exercise_name", "reps", rounded("one_rep_max"),
                       rounded("cummax_one_rep_max"), rounded("rolling_90d_max"))


@query("""WITH d AS (SELECT date, sum(one_rep_max) AS v FROM rated WHERE one_rep_max > 0 GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d)
    SELECT date, round(coalesce(v, 0), 6) AS one_rep_max FROM s LEFT JOIN d USING (date)""")
def daily_volume(t):
    rated = t.rated_sets.where(F.col("one_rep_max") > 0)
    return volume_job(rated).select("date", rounded("one_rep_max"))


@query("""WITH d AS (SELECT date, sum(one_rep_max) AS v FROM rated GROUP BY 1),
    e AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS e FROM orders GROUP BY 1)
    SELECT date, round(v, 6) AS one_rep_max, round(coalesce(e, 0), 3) AS total_energy_burned
    FROM d FULL JOIN e USING (date)""")
def full_outer_daily(t):
    energy = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.sum("o_totalprice").alias("total_energy_burned"))
    both = daily_volume_with_energy(t.rated_sets, energy)
    return both.select("date", rounded("one_rep_max"), rounded("total_energy_burned", 3))


_SPINE = f"""spine AS (SELECT user_id, CAST(unnest(generate_series(min(date), DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE)
    AS date FROM readings GROUP BY user_id),
    filled AS (SELECT s.user_id, s.date, event_id, value FROM spine s LEFT JOIN readings r
        ON r.user_id = s.user_id AND r.date = s.date)"""


def _filled(t):
    readings = t.readings.select("user_id", "date", "event_id", "value")
    return fill.date_spine_fill(readings, AS_OF, ["user_id"])


@query(f"WITH {_SPINE} SELECT * FROM filled")
def date_spine_fill(t):
    return _filled(t)


@query(f"""WITH {_SPINE}, names AS (SELECT unnest(['click', 'view', 'signup', 'other']) AS metric)
    SELECT s.user_id, s.date, n.metric, r.event_id, r.value FROM spine s CROSS JOIN names n
    LEFT JOIN readings r ON r.user_id = s.user_id AND r.date = s.date AND r.event_type = n.metric""")
def date_metric_spine(t):
    rows = t.readings.withColumnRenamed("event_type", "metric")
    return fill.date_spine_fill(rows, AS_OF, ["user_id"], metrics=["click", "view", "signup", "other"]).select(
        "user_id", "date", "metric", "event_id", "value")


@query("""WITH d AS (SELECT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS v
        FROM orders GROUP BY 1, 2, 3),
    s AS (SELECT o_orderstatus, o_orderpriority, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM d GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderpriority, date, round(coalesce(v, 0), 3) AS spent FROM s
    LEFT JOIN d USING (o_orderstatus, o_orderpriority, date)""")
def dense_zero_fill(t):
    keys = ["o_orderstatus", "o_orderpriority"]
    days = stats.daily(t.orders.withColumn("date", F.to_date("o_orderdate")), "o_totalprice", "sum", keys)
    return fill.dense_fill(days, "o_totalprice", keys, out="spent").select(*keys, "date", rounded("spent", 3))


@query(f"""WITH {_SPINE} SELECT user_id, date, event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id
    ORDER BY date, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM filled""")
def forward_fill(t):
    return fill.forward_fill(_filled(t), "value", ["user_id"], order=["event_id"])


_NEIGHBOURS = """pos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, event_id) AS p FROM filled),
    around AS (SELECT *,
        last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER up AS p0,
        last_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER up AS d0,
        last_value(value IGNORE NULLS) OVER up AS v0,
        first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER down AS p1,
        first_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER down AS d1,
        first_value(value IGNORE NULLS) OVER down AS v1 FROM pos
        WINDOW up AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               down AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_BY_POSITION = """CASE WHEN value IS NOT NULL THEN value WHEN v1 IS NULL THEN v0
    ELSE v0 + (v1 - v0) * (p - p0) / (p1 - p0) END"""
_BY_DATE = """CASE WHEN value IS NOT NULL THEN value WHEN v1 IS NULL OR d1 = d0 THEN v0
    ELSE v0 + (v1 - v0) * (date - d0) / (d1 - d0) END"""


@query(f"""WITH {_SPINE}, {_NEIGHBOURS} SELECT user_id, date, event_id, {approx_sql(_BY_POSITION)} AS value FROM around""")
def interpolate_positional(t):
    rows = fill.interpolate(_filled(t), "value", ["user_id"], order=["event_id"])
    return rows.select("user_id", "date", "event_id", approx("value"))


@query(f"""WITH {_SPINE}, {_NEIGHBOURS} SELECT user_id, date, event_id, {approx_sql(_BY_DATE)} AS value FROM around""")
def interpolate_by_date(t):
    rows = fill.interpolate(_filled(t), "value", ["user_id"], order=["event_id"], by="date")
    return rows.select("user_id", "date", "event_id", approx("value"))


# All readings of everyone at one time of the day: days are cut along what decides among ties.
@query(f"""WITH filled AS (SELECT 0 AS user_id, date, event_id, value FROM readings), {_NEIGHBOURS}
    SELECT date, event_id, {approx_sql(_BY_POSITION)} AS value FROM around""")
def interpolate_ties(t):
    noon = t.readings.select("date", "event_id", "value", F.to_timestamp("date").alias("at"))
    rows = fill.interpolate(noon, "value", order=["at", "event_id"], bound=100)
    return rows.select("date", "event_id", approx("value"))


# Values that are no finite numbers, in the order of the values themselves: NULL, NaN with it, comes before minus infinity.
@query("""WITH r AS (SELECT user_id, date, event_id, CASE event_id % 7 WHEN 0 THEN '-Infinity'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE
        WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE round(value, 2) END AS value FROM readings)
    SELECT user_id, date, event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY date, value NULLS FIRST
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM r""")
def forward_fill_infinite(t):
    odd = F.element_at(F.array(*[F.lit(float(x)) for x in ("-inf", "inf", "nan")], F.lit(None)), (F.col("event_id") % 7 + 1).cast("int"))
    value = F.when(F.col("event_id") % 7 < 4, odd).otherwise(F.round("value", 2))
    rows = t.readings.select("user_id", "date", "event_id", value.alias("value"))
    return fill.forward_fill(rows, "value", ["user_id"], bound=5)


@query(f"""WITH mass AS (SELECT user_id, date, event_id, CASE WHEN value > 5 THEN value END AS value FROM readings
        WHERE event_type = 'signup'),
    spine AS (SELECT user_id, CAST(unnest(generate_series(min(date), DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE)
        AS date FROM mass GROUP BY user_id),
    filled AS (SELECT s.user_id, s.date, event_id, value FROM spine s LEFT JOIN mass r
        ON r.user_id = s.user_id AND r.date = s.date), {_NEIGHBOURS}
    SELECT user_id, date, {approx_sql(f"min(2.20462 * {_BY_POSITION})")} AS body_mass FROM around GROUP BY 1, 2""")
def weight_series(t):
    readings = t.readings.select(
        "user_id", "date", "event_id", F.col("event_type").alias("type"),
        F.when(F.col("value") > 5, F.col("value")).alias("value"),
    )
    weight = daily_weight(readings, AS_OF, keys=["user_id"], order=["event_id"], kind="signup")
    return weight.select("user_id", "date", approx("body_mass"))


@query(f"""WITH mass AS (SELECT user_id, date, event_id, CASE WHEN value > 5 THEN value END AS value FROM readings
        WHERE event_type = 'signup'),
    spine AS (SELECT user_id, CAST(unnest(generate_series(min(date), DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE)
        AS date FROM mass GROUP BY user_id),
    filled AS (SELECT s.user_id, s.date, event_id, value FROM spine s LEFT JOIN mass r
        ON r.user_id = s.user_id AND r.date = s.date),
    last AS (SELECT user_id, date, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id
        ORDER BY date, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM filled)
    SELECT user_id, date, round(min(2.20462 * value), 9) AS body_mass FROM last GROUP BY 1, 2""")
def weight_series_ffill(t):
    readings = t.readings.select(
        "user_id", "date", "event_id", F.col("event_type").alias("type"),
        F.when(F.col("value") > 5, F.col("value")).alias("value"),
    )
    weight = daily_weight(readings, AS_OF, "ffill", keys=["user_id"], order=["event_id"], kind="signup")
    return weight.select("user_id", "date", rounded("body_mass", 9))


@query("""WITH f AS (SELECT user_id, min(date) FILTER (WHERE click IS NOT NULL) AS c,
        min(date) FILTER (WHERE view IS NOT NULL) AS v FROM user_days GROUP BY 1)
    SELECT user_id, date, CASE WHEN click IS NULL AND date > c THEN 1.0::DOUBLE ELSE click END AS click,
        CASE WHEN view IS NULL AND date > v THEN 1.0::DOUBLE ELSE view END AS view
    FROM user_days JOIN f USING (user_id)""")
def fill_after_first_seen(t):
    days = t.user_days.select("user_id", "date", "click", "view")
    return fill.fill_after_first_seen(days, ["click", "view"], ["user_id"])


_TREND_EPS = 0.05


@query(f"""WITH m AS (SELECT user_id, event_id, date, event_type AS metric, value FROM readings
        WHERE event_type IN ('click', 'purchase', 'view') AND value IS NOT NULL),
    k AS (SELECT a.event_id, sum(b.value * exp(-{_TREND_EPS} * abs(a.date - b.date)))
        / sum(exp(-{_TREND_EPS} * abs(a.date - b.date))) AS avg
        FROM m a JOIN m b ON a.user_id = b.user_id AND a.metric = b.metric GROUP BY 1)
    SELECT user_id, date, metric, value, value > 0 AS positive_value, {approx_sql("avg")} AS exp_moving_avg,
    'Date: ' || date || ' <br>Value: ' || CAST(round_even(value, 0) AS BIGINT) || ' '
    || CASE WHEN value > 100 THEN '<br>Note: high' ELSE '' END AS label FROM m JOIN k USING (event_id)""")
def ewma_by_metric(t):
    scores = t.readings.select(
        "user_id", "date", F.col("event_type").alias("metric"), "value",
        F.when(F.col("value") > 100, "high").otherwise("").alias("note"))
    trend = metric_trend(scores, ["click", "purchase", "view"], _TREND_EPS, ["user_id"])
    return trend.select("user_id", "date", "metric", "value", "positive_value", approx("exp_moving_avg"), "label")


@query(f"""WITH m AS (SELECT user_id, event_id, date, event_type AS metric, value FROM readings
        WHERE event_type IN ('click', 'view') AND value IS NOT NULL AND event_id % 7 <> 0),
    k AS (SELECT a.event_id, sum(b.value * exp(-{_TREND_EPS} * abs(a.date - b.date)))
        / sum(exp(-{_TREND_EPS} * abs(a.date - b.date))) AS avg
        FROM m a JOIN m b ON a.user_id = b.user_id AND a.metric = b.metric GROUP BY 1)
    SELECT user_id, date, metric, value, {approx_sql("avg")} AS exp_moving_avg FROM m JOIN k USING (event_id)""")
def ewma_nan(t):
    """Every seventh value is NaN."""
    scores = t.readings.select(
        "user_id", "date", F.col("event_type").alias("metric"), F.lit("").alias("note"),
        F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    trend = metric_trend(scores, ["click", "view"], _TREND_EPS, ["user_id"])
    return trend.select("user_id", "date", "metric", "value", approx("exp_moving_avg"))


@query(f"""WITH a AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY 1),
    d AS (SELECT event_type AS metric, CAST(ts AS DATE) AS date, sum(value - mean) AS value
        FROM events JOIN a USING (event_type) GROUP BY 1, 2),
    k AS (SELECT a.metric, a.date, any_value(a.value) AS value,
        sum(b.value * exp(-0.3 * abs(a.date - b.date))) / sum(exp(-0.3 * abs(a.date - b.date))) AS avg
        FROM d a JOIN d b ON a.metric = b.metric GROUP BY 1, 2)
    SELECT metric, date, value > 0 AS positive_value, {approx_sql("avg")} AS exp_moving_avg,
    {approx_sql("greatest(avg, 0)")} AS band_above, {approx_sql("least(avg, 0)")} AS band_below FROM k""")
def ewma_bands(t):
    rows = stats.attach(t.events, ["event_type"], _mean=F.avg("value"))
    days = rows.groupBy(F.col("event_type").alias("metric"), F.to_date("ts").alias("date")).agg(
        F.sum(F.col("value") - F.col("_mean")).alias("value")).withColumn("note", F.lit(""))
    trend = metric_trend(days, ["click", "error", "purchase", "signup", "view"], 0.3)
    return trend.select("metric", "date", "positive_value", approx("exp_moving_avg"), approx("band_above"),
                        approx("band_below"))


def _volume_sql(where: str, eps: float) -> str:
    return f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) / 1000 AS v FROM orders GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM o),
    d AS (SELECT date, coalesce(v, 0) AS v FROM s LEFT JOIN o USING (date) {where}),
    k AS (SELECT a.date, any_value(a.v) AS v, sum(b.v * exp(-{eps} * abs(a.date - b.date)))
        / sum(exp(-{eps} * abs(a.date - b.date))) AS avg FROM d a CROSS JOIN d b GROUP BY 1)
    SELECT date, round(v, 6) AS one_rep_max, {approx_sql("avg")} AS exp_moving_avg FROM k"""


def _volume(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("date"), (F.col("o_totalprice") / 1000).alias("one_rep_max"))
    return fill.dense_fill(stats.daily(rows, "one_rep_max", "sum"), "one_rep_max")


@query(_volume_sql("", 0.005))
def volume_ewma(t):
    rows = volume_trend(_volume(t), 0.005, exclude_zeros=False)
    return rows.select("date", rounded("one_rep_max"), approx("exp_moving_avg"))


@query(_volume_sql("WHERE coalesce(v, 0) > 0", 0.3))
def volume_ewma_nonzero(t):
    rows = volume_trend(_volume(t), 0.3)
    return rows.select("date", rounded("one_rep_max"), approx("exp_moving_avg"))


@query(f"""WITH w AS (SELECT user_id, event_id, ts AS s, ts + INTERVAL 1 HOUR AS e FROM events WHERE event_type = 'signup')
    SELECT w.user_id, w.event_id, {approx_sql("avg(m.value) FILTER (WHERE m.event_type = 'click')")} AS click_mean,
    round(sum(m.value) FILTER (WHERE m.event_type = 'view'), 6) AS view_sum,
    round(sum(m.value) FILTER (WHERE m.event_type = 'purchase'), 6) AS purchase_sum
    FROM w LEFT JOIN events m ON m.user_id = w.user_id AND m.ts BETWEEN w.s AND w.e GROUP BY 1, 2""")
def interval_enrich(t):
    wanted = {"click_mean": ("click", "avg"), "view_sum": ("view", "sum"), "purchase_sum": ("purchase", "sum")}
    signups = t.events.where(F.col("event_type") == "signup").select(
        "user_id", "event_id", F.col("ts").alias("start"), (F.col("ts") + F.expr("interval 1 hour")).alias("end"))
    events = t.events.select("user_id", "event_type", F.col("ts").alias("start"), "value")
    rows = joins.enrich_intervals(signups, events, wanted, ["user_id"], m_end=None, kind="event_type")
    return rows.select("user_id", "event_id", approx("click_mean"), rounded("view_sum"), rounded("purchase_sum"))


@query(f"""WITH w AS (SELECT user_id, event_id, ts AS s, ts + to_minutes(30 + CAST(floor(value) AS INTEGER)) AS e
        FROM events WHERE event_type IN ('signup', 'error')),
    m AS (SELECT user_id, event_type, value, ts AS s, ts + to_seconds(CAST(floor(value * 60) AS INTEGER)) AS e FROM events)
    SELECT w.user_id, w.event_id, {approx_sql("avg(m.value) FILTER (WHERE m.event_type = 'click')")} AS click_mean,
    round(sum(m.value) FILTER (WHERE m.event_type = 'view'), 6) AS view_sum
    FROM w LEFT JOIN m ON m.user_id = w.user_id AND m.s >= w.s AND m.e <= w.e GROUP BY 1, 2""")
def interval_enrich_spans(t):
    def lasting(rows, seconds):
        return rows.withColumn("start", F.col("ts")).withColumn(
            "end", F.col("ts") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))

    spans = lasting(t.events, F.floor(F.col("value") * 60)).select("user_id", "event_type", "start", "end", "value")
    chosen = t.events.where(F.col("event_type").isin("signup", "error"))
    intervals = lasting(chosen, (F.floor("value") + 30) * 60).select("user_id", "event_id", "start", "end")
    wanted = {"click_mean": ("click", "avg"), "view_sum": ("view", "sum")}
    rows = joins.enrich_intervals(intervals, spans, wanted, ["user_id"], kind="event_type")
    return rows.select("user_id", "event_id", approx("click_mean"), rounded("view_sum"))


@query(f"""WITH v AS (SELECT * REPLACE (CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 1e18 ELSE value END AS value)
        FROM events),
    w AS (SELECT user_id, event_id, ts AS s, ts + INTERVAL 1 HOUR AS e FROM events WHERE event_type = 'signup')
    SELECT w.user_id, w.event_id, {approx_sql("avg(m.value) FILTER (WHERE m.event_type = 'click')")} AS click_mean,
    {approx_sql("CASE WHEN count(*) FILTER (WHERE m.event_type = 'view') > 0 THEN coalesce(sum(m.value) FILTER (WHERE m.event_type = 'view'), 0) END")}
        AS view_sum
    FROM w LEFT JOIN v m ON m.user_id = w.user_id AND m.ts BETWEEN w.s AND w.e GROUP BY 1, 2""")
def interval_enrich_outliers(t):
    """Some values are huge and some missing; neither may touch an interval that does not hold them."""
    value = F.when(F.col("event_id") % 89 == 0, F.lit(None)).when(F.col("event_id") % 97 == 0, 1e18).otherwise(F.col("value"))
    wanted = {"click_mean": ("click", "avg"), "view_sum": ("view", "sum")}
    signups = t.events.where(F.col("event_type") == "signup").select(
        "user_id", "event_id", F.col("ts").alias("start"), (F.col("ts") + F.expr("interval 1 hour")).alias("end"))
    events = t.events.select("user_id", "event_type", F.col("ts").alias("start"), value.alias("value"))
    rows = joins.enrich_intervals(signups, events, wanted, ["user_id"], m_end=None, kind="event_type")
    return rows.select("user_id", "event_id", approx("click_mean"), approx("view_sum"))


@query("""WITH m AS (SELECT max(event_id) AS m FROM events)
    SELECT event_id, DATE '2024-02-05' - CAST(m - event_id AS INTEGER) AS date,
    strftime(DATE '2024-02-05' - CAST(m - event_id AS INTEGER), '%Y-%m-%d') AS date_text FROM events, m""")
def backdate_entries(t):
    from daybook.functions.dates import iso_text

    dated = shape.backdate(t.events.select("event_id"), "event_id", AS_OF)
    return dated.withColumn("date_text", iso_text(F.col("date")))
