"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.catalog.registry import UNWEIGHTED, approx, approx_sql, query
from daybook.plans.strength import strength_metrics
from daybook.plans.views import activity_heatmap
from daybook.plans.views import one_rep_max_view as view_job

_POSITIVE = """pos AS (SELECT exercise_name, date, reps, one_rep_max,
        max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
            RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW) AS rolling FROM rated),
    lifts AS (SELECT * FROM pos WHERE one_rep_max > 0)"""


def _lifts(t):
    return strength_metrics(t.sets, unweighted=UNWEIGHTED)


@query(f"""WITH {_POSITIVE}, b AS (SELECT *, one_rep_max = max(one_rep_max) OVER (PARTITION BY exercise_name ORDER BY date
        RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS is_best_lift FROM lifts
        WHERE exercise_name IN ('small ring', 'red widget (Barbell)', 'old rod', 'new gizmo (Dumbbell)'))
    SELECT date, exercise_name, reps, round(one_rep_max, 6) AS one_rep_max, round(rolling, 6) AS line, is_best_lift,
    CASE WHEN is_best_lift THEN 0.5::DOUBLE ELSE 0.05::DOUBLE END AS emphasis, reps = 1 AS single_rep,
    'Date: ' || date || ' <br>Exercise: ' || exercise_name || ' <br>Estimated 1RM: '
    || CAST(round_even(one_rep_max, 0) AS BIGINT) AS label FROM b""")
def one_rep_max_view(t):
    names = ["small ring", "red widget (Barbell)", "old rod", "new gizmo (Dumbbell)"]
    view = view_job(_lifts(t), names, "rolling", highlight=True, single_reps=True)
    return view.withColumn("one_rep_max", F.round("one_rep_max", 6)).withColumn("line", F.round("line", 6))


def _heat_sql(category: str, value: str, metric: str, k: int, keep: str, buckets: str, title: str, dedupe: bool) -> str:
    join = "(SELECT DISTINCT exercise_name, Anterior_Posterior, Push_Pull_Legs FROM classes)" if dedupe else "classes"
    return f"""WITH {_POSITIVE}, a AS (SELECT min(date) AS lo FROM lifts),
    i AS (SELECT exercise_name, one_rep_max, year(lo) * 12 + month(lo) - 1 AS m0, year(date) * 12 + month(date) - 1 AS m FROM lifts, a),
    b AS (SELECT exercise_name, one_rep_max, m0 + (m - m0) // {k} * {k} AS s FROM i),
    c AS (SELECT make_date(s // 12, s % 12 + 1, 1) AS time_bin, {category}, {value} AS v FROM b
        LEFT JOIN {join} USING (exercise_name) GROUP BY 1, 2),
    f AS (SELECT * FROM c WHERE {category} NOT IN ('Unclear', 'unclear') AND {category} IS NOT NULL),
    n AS (SELECT {category}, rank() OVER (ORDER BY count(*) DESC) AS r FROM f GROUP BY 1),
    g AS (SELECT time_bin, {title} AS cat, v FROM f {keep}),
    q AS (SELECT cat, row_number() OVER (ORDER BY median(v), cat) AS sort_key FROM g GROUP BY 1)
    SELECT time_bin, cat AS {category}, {"v" if metric == "Frequency" else approx_sql("v")} AS {metric}, {buckets} AS bucket,
    CAST(sort_key AS INTEGER) AS sort_key FROM g JOIN q USING (cat)"""


def _case(*pairs: tuple[int, str], last: str) -> str:
    return "CASE " + " ".join(f"WHEN v <= {hi} THEN '{label}'" for hi, label in pairs) + f" ELSE '{last}' END"


_UPPER = "upper(substr({0}, 1, 1)) || substr({0}, 2)"
_WORDS = " || ' ' || ".join(_UPPER.format(f"split_part(exercise_name, ' ', {i})") for i in (1, 2))
_TITLE = _WORDS + " || CASE WHEN split_part(exercise_name, ' ', 3) <> '' THEN ' ' || split_part(exercise_name, ' ', 3) ELSE '' END"


@query(_heat_sql("Push_Pull_Legs", "count(*)", "Frequency", 2, "", _case((30, "0-30"), (100, "30-100"), (300, "100-300"), last="300+"),
                 _UPPER.format("Push_Pull_Legs"), False))
def heatmap_push_pull(t):
    return activity_heatmap(_lifts(t), t.classes, "Frequency", "Push_Pull_Legs", 2)


@query(_heat_sql("Anterior_Posterior", "sum(one_rep_max)", "Volume", 4, "",
                 _case((10000, "0-10000"), (30000, "10000-30000"), (100000, "30000-100000"), last="100000+"),
                 _UPPER.format("Anterior_Posterior"), True))
def heatmap_side(t):
    tiles = activity_heatmap(_lifts(t), t.classes, "Volume", "Anterior_Posterior", 4, dedupe=True)
    return tiles.withColumn("Volume", approx("Volume"))


@query(_heat_sql("exercise_name", "sum(one_rep_max)", "Volume", 2,
                 "WHERE exercise_name IN (SELECT exercise_name FROM n WHERE r <= 10)",
                 _case((300, "0-300"), (1000, "300-1000"), (3000, "1000-3000"), (10000, "3000-10000"), last="10000+"), _TITLE, True)
       .replace("LEFT JOIN (SELECT DISTINCT exercise_name, Anterior_Posterior, Push_Pull_Legs FROM classes) USING (exercise_name)", ""))
def heatmap_series(t):
    tiles = activity_heatmap(_lifts(t), None, "Volume", "exercise_name", 2)
    return tiles.withColumn("Volume", approx("Volume"))


@query(_heat_sql("exercise_name", "sum(one_rep_max)", "Volume", 2,
                 "WHERE exercise_name IN (SELECT exercise_name FROM n WHERE r <= 10)",
                 _case((300, "0-300"), (1000, "300-1000"), (3000, "1000-3000"), (10000, "3000-10000"), last="10000+"), _TITLE, False))
def heatmap_series_classes(t):
    """A set counts once per class of its exercise."""
    tiles = activity_heatmap(_lifts(t), t.classes, "Volume", "exercise_name", 2)
    return tiles.withColumn("Volume", approx("Volume"))
