"""Projections, filters, scalar expressions and plain aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.catalog.registry import approx, approx_sql, query, rounded
from daybook.functions import dates, numeric, text
from daybook.operators import shape, stats, windows
from daybook.operators.fill import coalesce_mean
from daybook.plans.measurements import clean_measurements, select_workouts


@query("""SELECT p_partkey AS part_key, p_name AS full_name, p_brand AS the_brand_name, p_size AS size FROM part""")
def normalize_columns(t):
    odd = t.part.select(
        F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("FULL NAME"),
        F.col("p_brand").alias("The  Brand \t Name"), F.col("p_size").alias("Size"),
    )
    return shape.lower_names(shape.snake_names(odd))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_columns(t):
    return t.orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority", "no_such_column")


@query("""SELECT event_id, coalesce(quality, 0) AS quality, coalesce(toxic, 9) AS toxic,
    coalesce(CASE WHEN event_type <> 'view' THEN event_type END, '') AS event_type
    FROM events LEFT JOIN labels ON event_id = doc_id""")
def constant_fill(t):
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    joined = t.events.join(t.labels, F.col("event_id") == F.col("doc_id"), "left")
    filled = joined.select("event_id", "quality", "toxic", kind.alias("event_type"))
    return filled.fillna({"quality": 0, "toxic": 9, "event_type": ""})


@query("""SELECT user_id, date, coalesce(click, (purchase + view) / 2) AS click, purchase, view FROM user_days""",
       name="coalesce_mean")
def coalesce_mean_query(t):
    return coalesce_mean(t.user_days.select("user_id", "date", "click", "purchase", "view"), "click", "purchase", "view")


@query("""SELECT event_id, event_type AS type, CASE WHEN event_type <> 'error' THEN value END AS value,
    CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
    CAST(day(ts) AS INTEGER) AS day, CAST(dayofyear(ts) AS INTEGER) AS yday, CAST(isodow(ts) - 1 AS INTEGER) AS wday,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    CASE WHEN event_type <> 'view' THEN 'Watch ' || user_id END AS device,
    epoch_us(date_trunc('second', ts) + INTERVAL 8 HOUR) AS enddate FROM events""")
def parse_measurements(t):
    raw = t.events.select(
        "event_id",
        F.concat(F.lit("HKQuantityTypeIdentifier"), "event_type").alias("type"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_type") == "view", "<<HKDevice: 0x1>>").otherwise(
            F.concat(F.lit("<<HKDevice: 0x1>, name:Watch "), F.col("user_id").cast("string"), F.lit(", model:M>"))
        ).alias("device"),
        F.lit("10.1").alias("sourceVersion"), F.lit("-").alias("creationDate"), F.lit("-").alias("startDate"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" -0800")).alias("endDate"),
    )
    cleaned = clean_measurements(raw).drop("endclock")
    return cleaned.withColumn("enddate", F.unix_micros("enddate"))


@query("""SELECT event_id, CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(dayofyear(ts) AS INTEGER) AS yday,
    CAST(isodow(ts) - 1 AS INTEGER) AS wday, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(minute(ts) AS INTEGER) AS minute FROM events""")
def date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in dates.date_parts(F.col("ts")).items()])


@query("SELECT doc_id, nullif(regexp_extract(text, ' ([a-z]+tion) ', 1), '') AS word FROM documents")
def regex_capture(t):
    return t.documents.select("doc_id", text.capture(F.col("text"), " ([a-z]+tion) ").alias("word"))


@query("""SELECT p_partkey, upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
    upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) ||
    ' (' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ')-Brand''s' AS title FROM part""")
def title_case(t):
    messy = F.concat(F.upper("p_name"), F.lit(" ("), F.lower("p_type"), F.lit(")-brand's"))
    return t.part.select("p_partkey", text.title_case(messy).alias("title"))


@query("""SELECT event_id, upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' Per Day' AS metric FROM events""")
def pretty_metric(t):
    return t.events.select(
        "event_id", text.pretty_name(F.concat("event_type", F.lit("_per_day"))).alias("metric")
    )


@query("""SELECT exercise_name, date,
    'Date: ' || date || ' <br>Exercise: ' || exercise_name || ' <br>Estimated 1RM: '
    || CAST(round_even(one_rep_max, 0) AS BIGINT) AS lift,
    'Date: ' || date || ' <br>Value: ' || CAST(round_even(reps / 4, 0) AS BIGINT) || ' '
    || CASE WHEN set_order > 3 THEN '<br>Note: set ' || set_order ELSE '' END AS metric FROM rated""")
def label_text(t):
    note = F.when(F.col("set_order") > 3, F.concat(F.lit("set "), F.col("set_order").cast("string"))).when(
        F.col("set_order") == 3, "")
    return t.rated_sets.select(
        "exercise_name", "date",
        text.lift_label(F.col("date"), F.col("exercise_name"), F.col("one_rep_max")).alias("lift"),
        text.metric_label(F.col("date"), F.col("reps") / 4, note).alias("metric"),
    )


@query(f"""WITH p AS (SELECT *, CASE WHEN l_discount <> 0 THEN l_quantity / (l_discount * 100) END AS n FROM lineitem)
    SELECT l_orderkey, l_linenumber, {approx_sql("CASE WHEN l_discount = 0 THEN 0 ELSE floor(n) + (n - floor(n)) * 0.6 END")}
    AS pace FROM p""")
def pace(t):
    distance = F.col("l_discount") * 100
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", approx(numeric.pace(F.col("l_quantity"), distance), "pace")
    )


@query("SELECT exercise_name, date, set_order, round(one_rep_max, 6) AS one_rep_max FROM rated")
def epley_one_rep_max(t):
    return t.rated_sets.select("exercise_name", "date", "set_order", rounded("one_rep_max"))


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS date, sum(value) AS value FROM events GROUP BY 1, 2),
    r AS (SELECT *, sum(value) OVER (PARTITION BY user_id ORDER BY date) AS total FROM d)
    SELECT user_id, date, round(total, 4) AS total FROM r WHERE total BETWEEN 200 AND 800""")
def display_range(t):
    days = stats.daily(t.events.withColumn("date", F.to_date("ts")), "value", "sum", ["user_id"])
    running = windows.running_sum(days, "value", ["user_id"], "total")
    shown = shape.display_range(running, "total", 200.0, 800.0)
    return shown.select("user_id", "date", rounded("total", 4))


@query("""SELECT user_id, event_type AS type, epoch_us(date_trunc('second', ts) + INTERVAL 8 HOUR) AS date,
    value AS duration FROM events WHERE event_type IN ('click', 'view', 'purchase')""")
def workouts_select(t):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" -0800"))
    raw = t.events.select(
        "user_id", F.concat(F.lit("HKWorkoutActivityType"), "event_type").alias("workoutActivityType"),
        F.col("value").cast("string").alias("duration"), stamp.alias("startDate"), stamp.alias("endDate"),
    )
    picked = select_workouts(raw, ["click", "view", "purchase"], keys=["user_id"])
    return picked.withColumn("date", F.unix_micros("date"))


@query(f"""SELECT date, {approx_sql("min(weight * 2.20462)")} AS body_mass FROM sets GROUP BY date""")
def daily_min(t):
    pounds = t.sets.select("date", numeric.kg_to_lb(F.col("weight")).alias("body_mass"))
    return stats.daily(pounds, "body_mass", "min").select("date", approx("body_mass"))


@query("""SELECT exercise_name, date, round(max(one_rep_max), 6) AS daily_max FROM rated GROUP BY 1, 2""")
def daily_max(t):
    best = stats.daily(t.rated_sets, "one_rep_max", "max", ["exercise_name"], out="daily_max")
    return best.select("exercise_name", "date", rounded("daily_max"))


@query("SELECT DISTINCT exercise_name FROM sets")
def distinct_keys(t):
    return stats.distinct_keys(t.sets, ["exercise_name"], ordered=True)


@query("SELECT date, exercise_name, set_order, weight, reps FROM sets")
def sorted_output(t):
    return t.sets.select("date", "exercise_name", "set_order", "weight", "reps").orderBy(
        "date", "exercise_name", "set_order")


@query("""WITH long AS (
        SELECT p_brand, 'p_type' AS a, p_type AS v FROM part
        UNION ALL SELECT p_brand, 'size_class', CASE WHEN p_size > 45 THEN 'huge' WHEN p_size > 10 THEN
            CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END END FROM part),
    n AS (SELECT p_brand, a, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2, 3),
    r AS (SELECT *, rank() OVER (PARTITION BY p_brand, a ORDER BY n DESC) AS r FROM n),
    m AS (SELECT p_brand, a, CASE WHEN count(*) = 1 THEN any_value(v) ELSE 'Unclear' END AS v FROM r WHERE r = 1 GROUP BY 1, 2)
    SELECT b.p_brand, coalesce(x.v, 'Unclear') AS p_type, coalesce(y.v, 'Unclear') AS size_class
    FROM (SELECT DISTINCT p_brand FROM part) b
    LEFT JOIN m x ON x.p_brand = b.p_brand AND x.a = 'p_type'
    LEFT JOIN m y ON y.p_brand = b.p_brand AND y.a = 'size_class'""")
def mode_or_unclear(t):
    size = F.col("p_size")
    odd = F.when(size % 2 == 0, "even").otherwise("odd")
    parts = t.part.withColumn("size_class", F.when(size > 45, "huge").when(size > 10, odd))
    return stats.mode_or_unclear(parts, ["p_brand"], ["p_type", "size_class"], "Unclear")


@query("SELECT * FROM user_days")
def pivot_first(t):
    return t.user_days


@query("""WITH n AS (SELECT user_id, count(*) AS n, max(CAST(ts AS DATE)) AS last_date FROM events GROUP BY 1),
    d AS (SELECT *, CAST(DATE '2024-02-15' - last_date AS INTEGER) AS days_since_last FROM n)
    SELECT user_id, n, last_date, days_since_last, round(n / (60 + days_since_last), 8) AS sorting_metric
    FROM d WHERE n >= 50 AND days_since_last <= 16""")
def recency_ranked_keys(t):
    rows = t.events.select("user_id", F.to_date("ts").alias("date"))
    ranked = stats.recency_ranked(rows, "user_id", dates.date_lit("2024-02-15"), max_age=16)
    return ranked.withColumn("sorting_metric", rounded("sorting_metric", 8))


@query("""WITH n AS (SELECT o_custkey, rank() OVER (ORDER BY count(*) DESC) AS r FROM orders GROUP BY 1)
    SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM n WHERE r <= 10)""")
def top_k_with_ties(t):
    return windows.restrict_to_top(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", 10)


@query("""WITH b AS (SELECT exercise_name, date_trunc('month', date) AS m, count(*) AS n FROM sets GROUP BY 1, 2),
    q AS (SELECT exercise_name, median(n) AS median FROM b GROUP BY 1)
    SELECT exercise_name, median, CAST(row_number() OVER (ORDER BY median, exercise_name) AS INTEGER) AS sort_key FROM q""")
def category_order_by_median(t):
    bins = t.sets.groupBy("exercise_name", F.trunc("date", "MM").alias("m")).agg(F.count("*").alias("n"))
    return stats.order_by_median(bins, "exercise_name", "n")


@query("""WITH q AS (SELECT exercise_name, median(weight) AS median FROM sets GROUP BY 1)
    SELECT exercise_name, round(median, 6) AS median, CAST(row_number() OVER (ORDER BY median, exercise_name) AS INTEGER) AS sort_key
    FROM q""")
def category_order_by_raw_median(t):
    """Over the sets themselves, in parts of few sets and few exercises."""
    order = stats.order_by_median(t.sets.select("exercise_name", "weight"), "exercise_name", "weight", bound=200)
    return order.withColumn("median", F.round("median", 6))


@query("""SELECT exercise_name, date, set_order, round(one_rep_max, 6) AS one_rep_max FROM rated
    QUALIFY one_rep_max = max(one_rep_max) OVER (PARTITION BY exercise_name, date)""")
def group_argmax_rows(t):
    rows = t.rated_sets.select("exercise_name", "date", "set_order", "one_rep_max")
    return windows.group_max_rows(rows, "one_rep_max", ["exercise_name", "date"]).select(
        "exercise_name", "date", "set_order", rounded("one_rep_max"))


