"""Goal progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.catalog.registry import approx, approx_sql, query, rounded
from daybook.functions.dates import date_lit
from daybook.plans.goals import (
    baseline_max, baseline_rows, goal_progress_count, goal_progress_max, goal_progress_sum, goal_progress_weekly,
)

_GOALS = {
    "small ring": 2600.0, "red widget (Barbell)": 2650.0, "old rod": 2000.0, "new gizmo (Dumbbell)": 2500.5,
    "blue bolt": 2700.0, "never lifted": 10.0,
}
_NAMES = ", ".join(f"'{n}'" for n in _GOALS)


@query("""SELECT exercise_name, round(max(one_rep_max), 6) AS baseline FROM rated
    WHERE date >= DATE '1997-10-01' AND date < DATE '1998-01-01' GROUP BY 1""")
def goal_baseline(t):
    return baseline_max(t.rated_sets, "1997-10-01", date_lit("1998-01-01")).select("exercise_name", rounded("baseline"))


@query(f"""WITH goals(exercise_name, goal) AS (VALUES {", ".join(f"('{n}', {g}::DOUBLE)" for n, g in _GOALS.items())}),
    mine AS (SELECT exercise_name, date, one_rep_max FROM rated WHERE exercise_name IN ({_NAMES})),
    base AS (SELECT exercise_name, max(one_rep_max) AS baseline FROM mine
        WHERE date >= DATE '1997-10-01' AND date < DATE '1998-01-01' GROUP BY 1),
    y AS (SELECT * FROM mine WHERE year(date) = 1998 UNION ALL SELECT exercise_name, DATE '1998-01-01', baseline FROM base),
    c AS (SELECT *, max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS cummax, max(one_rep_max) OVER (PARTITION BY exercise_name, date) AS top FROM y)
    SELECT c.exercise_name, date, round(one_rep_max, 6) AS one_rep_max, round(baseline, 6) AS baseline, round(cummax, 6) AS cummax,
    goal, {approx_sql("(cummax - baseline) / (goal - baseline)")} AS progress FROM c LEFT JOIN base USING (exercise_name)
    LEFT JOIN goals USING (exercise_name) WHERE one_rep_max >= top""")
def goal_max_progress(t):
    rows = goal_progress_max(t.rated_sets, _GOALS, 1998, "1997-10-01")
    return rows.select("exercise_name", "date", rounded("one_rep_max"), rounded("baseline"), rounded("cummax"), "goal",
                       approx("progress"))


_MAPPING = {"click": "Reading", "view": "Reading", "purchase": "Buying", "error": "Failing", "signup": "Nothing"}
_COUNTS = {"Reading": (30, 20.0), "Buying": (24, 10.0), "Failing": (48, 5.0)}


@query("""WITH g(activity, times, least) AS (VALUES ('Reading', 30, 20), ('Buying', 24, 10), ('Failing', 48, 5)),
    m(event_type, activity) AS (VALUES ('click', 'Reading'), ('view', 'Reading'), ('purchase', 'Buying'), ('error', 'Failing')),
    s AS (SELECT user_id, CAST(ts AS DATE) AS date, activity, times, row_number() OVER (PARTITION BY user_id, activity
        ORDER BY CAST(ts AS DATE), event_id) AS n FROM events JOIN m USING (event_type) JOIN g USING (activity)
        WHERE value >= least AND year(ts) = 2024)
    SELECT user_id, date, activity, n AS cumulative_count, CAST(times AS DOUBLE) AS goal, round(n / times, 6) AS progress_percentage FROM s
    UNION ALL SELECT user_id, DATE '2024-01-01', activity, 0, 0, 0 FROM (SELECT DISTINCT user_id FROM events), g""")
def goal_count_progress(t):
    rows = goal_progress_count(
        t.events.select("user_id", "event_type", "ts", "value"), _MAPPING, _COUNTS, 2024, keys=["user_id"],
        kind="event_type", ts="ts", amount="value")
    return rows.withColumn("progress_percentage", F.round("progress_percentage", 6))


_SUMS = {"click": ("ProfessionalMeetings", 50), "view": ("FriendMeetings", 100)}


@query("""WITH l AS (SELECT user_id, date, 'ProfessionalMeetings' AS Goal, 50 AS g, click AS n FROM user_days
        UNION ALL SELECT user_id, date, 'FriendMeetings', 100, view FROM user_days),
    c AS (SELECT user_id, date, Goal, g, sum(n) AS Count FROM l WHERE n > 0 GROUP BY ALL),
    s AS (SELECT *, sum(Count) OVER (PARTITION BY user_id, Goal ORDER BY date) AS Cumulative FROM c)
    SELECT user_id, date, Goal, Count, Cumulative, round(Cumulative / g, 6) AS progress_percentage FROM s
    UNION ALL SELECT user_id, DATE '2024-01-01', unnest(['ProfessionalMeetings', 'FriendMeetings']), 0, 0, 0
    FROM (SELECT DISTINCT user_id FROM events)""")
def goal_sum_progress(t):
    rows = goal_progress_sum(t.user_days, _SUMS, ["user_id"])
    zero = baseline_rows(t.events, [n for n, _ in _SUMS.values()], "Goal", 2024, ["user_id"], Count=F.lit(0.0),
                         Cumulative=F.lit(0.0), progress_percentage=F.lit(0.0))
    return zero.unionByName(rows.withColumn("progress_percentage", F.round("progress_percentage", 6)))


@query("""WITH w AS (SELECT user_id, date - CAST(dayofweek(date) AS INTEGER) AS date, CAST(count(*) AS DOUBLE) AS Count
        FROM user_days WHERE purchase > 0 GROUP BY 1, 2 HAVING count(*) >= 3)
    SELECT user_id, date, 'FlossingWeeks' AS Goal, Count,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY date) AS DOUBLE) AS Cumulative,
    round(row_number() OVER (PARTITION BY user_id ORDER BY date) / 26, 6) AS progress_percentage FROM w""")
def goal_weekly_streak(t):
    rows = goal_progress_weekly(t.user_days, ("purchase", "FlossingWeeks", 26, 3), ["user_id"])
    return rows.withColumn("progress_percentage", F.round("progress_percentage", 6))
