"""Bins, buckets, reshaping, classification joins, scores and the diary."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook import config
from daybook.catalog.registry import query, rounded
from daybook.operators import joins, labels, shape
from daybook.operators.scores import ScoreSpec, ScoreTerm, composite_score
from daybook.functions.numeric import interaction
from daybook.plans.diary import diary_scores, diary_wide
from daybook.plans.diary import diary_sparse as sparse_job
from daybook.sources.literal import literal_table


def _bins_sql(k: int) -> str:
    return f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders),
    a AS (SELECT min(date) AS lo FROM o),
    i AS (SELECT o_orderkey, date, year(lo) * 12 + month(lo) - 1 AS m0, year(date) * 12 + month(date) - 1 AS m FROM o, a),
    b AS (SELECT *, m0 + (m - m0) // {k} * {k} AS s FROM i)
    SELECT o_orderkey, date, make_date(s // 12, s % 12 + 1, 1) AS time_bin FROM b"""


def _month_bins(t, k):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return shape.month_bins(rows, k)


@query(_bins_sql(2))
def month_bins_2(t):
    return _month_bins(t, 2)


@query(_bins_sql(4))
def month_bins_4(t):
    return _month_bins(t, 4)


@query("""SELECT exercise_name, date_trunc('month', date)::DATE AS month, count(*) AS n, CASE WHEN count(*) <= 3 THEN '0-3'
    WHEN count(*) <= 10 THEN '3-10' WHEN count(*) <= 30 THEN '10-30' WHEN count(*) <= 100 THEN '30-100' ELSE '100+' END
    AS bucket FROM sets GROUP BY 1, 2""")
def bucketize_frequency(t):
    cells = t.sets.groupBy("exercise_name", F.trunc("date", "MM").alias("month")).agg(F.count("*").alias("n"))
    return cells.withColumn("bucket", shape.bucket(F.col("n"), config.BUCKET_BREAKS["Frequency", "series", 2]))


@query("""SELECT exercise_name, date, sum(reps) * 10 - 20 AS v, CASE WHEN sum(reps) * 10 - 20 < 0 THEN NULL
    WHEN sum(reps) * 10 - 20 <= 300 THEN '0-300' WHEN sum(reps) * 10 - 20 <= 1000 THEN '300-1000'
    WHEN sum(reps) * 10 - 20 <= 3000 THEN '1000-3000' WHEN sum(reps) * 10 - 20 <= 10000 THEN '3000-10000' ELSE '10000+' END
    AS bucket FROM sets GROUP BY 1, 2""")
def bucketize_volume(t):
    cells = t.sets.groupBy("exercise_name", "date").agg((F.sum("reps") * 10 - 20).alias("v"))
    return cells.withColumn("bucket", shape.bucket(F.col("v"), config.BUCKET_BREAKS["Volume", "series", 2]))


# Breaks of each order priority's own, from its clerks' numbers.
@query("""WITH b AS (SELECT o_orderpriority, unnest([0.0, 1.0, 2.0 + length(o_orderpriority), 9.0, 'Infinity'::DOUBLE]) * 20000 AS bound
        FROM (SELECT DISTINCT o_orderpriority FROM orders) WHERE o_orderpriority <> '5-LOW'),
    v AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 7 = 0 THEN 20000.0 WHEN o_orderkey % 11 = 0 THEN 0.0
        WHEN o_orderkey % 13 = 0 THEN -1.0 ELSE o_totalprice END AS v FROM orders),
    r AS (SELECT o_orderpriority, bound AS lo, lead(bound) OVER (PARTITION BY o_orderpriority ORDER BY bound) AS hi FROM (SELECT DISTINCT * FROM b))
    SELECT o_orderkey, CASE WHEN hi IS NULL THEN NULL WHEN isinf(hi) THEN CAST(CAST(lo AS BIGINT) AS VARCHAR) || '+'
        ELSE CAST(CAST(lo AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(hi AS BIGINT) AS VARCHAR) END AS bucket
    FROM v LEFT JOIN r ON r.o_orderpriority = v.o_orderpriority AND hi IS NOT NULL AND v <= hi AND (v > lo OR (v = 0 AND lo = 0))""")
def bucketize_by_key(t):
    kinds = t.orders.select("o_orderpriority").where("o_orderpriority <> '5-LOW'").distinct()
    steps = F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0) + F.char_length("o_orderpriority"), F.lit(9.0), F.lit(float("inf")))
    breaks = kinds.select("o_orderpriority", (F.explode(steps)).alias("step")).select("o_orderpriority", (F.col("step") * 20000).alias("bound"))
    key = F.col("o_orderkey")
    value = F.when(key % 7 == 0, 20000.0).when(key % 11 == 0, 0.0).when(key % 13 == 0, -1.0).otherwise(F.col("o_totalprice"))
    rows = t.orders.select("o_orderkey", "o_orderpriority", value.alias("v"))
    return shape.bucket_by_key(rows, "v", breaks, ["o_orderpriority"]).select("o_orderkey", "bucket")


@query("""SELECT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part WHERE p_size > 3
    UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 3""")
def explode_labels(t):
    named = t.part.select("p_partkey", F.when(F.col("p_size") > 3, F.col("p_name")).alias("names"))
    return shape.explode_labels(named, "names", "label", " ").drop("names")


@query("""SELECT s.exercise_name, Muscle_Group, Push_Pull_Legs, count(*) AS n, sum(reps) AS reps FROM sets s
    LEFT JOIN classes c ON c.exercise_name = s.exercise_name GROUP BY ALL""")
def classify_join_fanout(t):
    return joins.classified_totals(t.sets, t.classes, ["Muscle_Group", "Push_Pull_Legs"], ["reps"])


@query("""WITH c AS (SELECT DISTINCT exercise_name, Anterior_Posterior, Push_Pull_Legs FROM classes)
    SELECT s.exercise_name, Anterior_Posterior, Push_Pull_Legs, count(*) AS n, sum(reps) AS reps FROM sets s LEFT JOIN c
    ON c.exercise_name = s.exercise_name GROUP BY ALL""")
def classify_join_dedup(t):
    return joins.classified_totals(t.sets, t.classes, config.CLASS_CATEGORIES[::-1], ["reps"], dedupe=config.CLASS_CATEGORIES)


# Classes of the words part names are made of; the words not listed have none.
_WORDS = {
    "small": ("anterior", "push"), "large": ("anterior", "pull"), "red": ("posterior", "push"),
    "blue": ("posterior", "legs"), "bolt": ("anterior", "legs"), "ring": ("anterior", "pull"),
    "gear": ("posterior", "pull"), "rod": ("posterior", "legs"), "plate": ("anterior", "push"),
}
_WORDS_SQL = ", ".join(f"('{w}', '{a}', '{p}')" for w, (a, p) in _WORDS.items())


@query(f"""WITH dim(Muscle_Group, ap, ppl) AS (VALUES {_WORDS_SQL}),
    x AS (SELECT p_brand AS exercise_name, replace(p_name, ' ', ', ') AS muscle_groups, p_size AS match_score,
        unnest(string_split(p_name, ' ')) AS label FROM part),
    m AS (SELECT * FROM x LEFT JOIN dim ON label = Muscle_Group),
    n AS (SELECT exercise_name, 'ap' AS a, ap AS v, count(*) AS n FROM m WHERE ap IS NOT NULL GROUP BY ALL
        UNION ALL SELECT exercise_name, 'ppl', ppl, count(*) FROM m WHERE ppl IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, rank() OVER (PARTITION BY exercise_name, a ORDER BY n DESC) AS r FROM n),
    u AS (SELECT exercise_name, a, CASE WHEN count(*) = 1 THEN any_value(v) ELSE 'Unclear' END AS v FROM r WHERE r = 1 GROUP BY 1, 2)
    SELECT m.exercise_name, muscle_groups, match_score, Muscle_Group, coalesce(p.v, 'Unclear') AS Anterior_Posterior,
    coalesce(q.v, 'Unclear') AS Push_Pull_Legs FROM m LEFT JOIN u p ON p.exercise_name = m.exercise_name AND p.a = 'ap'
    LEFT JOIN u q ON q.exercise_name = m.exercise_name AND q.a = 'ppl'""")
def label_rollup(t):
    answers = t.part.select(
        F.col("p_brand").alias("exercise_name"), F.replace("p_name", F.lit(" "), F.lit(", ")).alias("muscle_groups"),
        F.col("p_size").alias("match_score"))
    groups = labels.muscle_group_table(t.spark, _WORDS)
    return labels.rollup_labels(answers, groups)


# --- scores: five event types as five terms -------------------------------------------
_TERMS = ScoreSpec((
    ScoreTerm("click", 0, 4, 1.0, 2.0), ScoreTerm("error", 0, 4, -1.0), ScoreTerm("purchase", 0, 4, 0.5, 2.8675),
    ScoreTerm("signup", 0, 4, 2.0), ScoreTerm("view", 0, 4, -0.5, 2.0),
))
_REST = ("click", "error")
_SUM_SQL = """(coalesce(pow(click, 2), 0) - coalesce(error, 0) + coalesce(0.5 * pow(purchase, 2.8675), 0)
    + coalesce(2 * signup, 0) - coalesce(0.5 * pow(view, 2), 0))"""
_LO, _HI = "(-4 - 0.5 * 16)", "(16 + 0.5 * pow(4, 2.8675) + 2 * 4)"
_KNOWN_SQL = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ("click", "error", "purchase", "signup", "view"))
_REST_SQL = "coalesce(click = 0 AND error = 0 AND purchase = 1 AND signup = 1 AND view = 1, false)"


def _score_sql(cutoff: float, rescale: bool, extra: str = "true") -> str:
    value = f"({_SUM_SQL} - {_LO}) / ({_HI} - {_LO}) * 200 - 100" if rescale else _SUM_SQL
    return f"""SELECT user_id, date, round(CASE WHEN ({_KNOWN_SQL}) / 5.0 >= {cutoff} AND NOT {_REST_SQL} AND {extra}
        THEN {value} END, 6) AS score FROM user_days"""


def _score(t, cutoff, spec=_TERMS, **options):
    score = composite_score(spec, cutoff, zero_baseline=_REST, **options)
    return t.user_days.select("user_id", "date", rounded(score, name="score"))


@query(_score_sql(0.2, False))
def composite_score_raw(t):
    return _score(t, 0.2, ScoreSpec(_TERMS.terms, rescale=False))


@query(_score_sql(1, True))
def composite_score_full(t):
    return _score(t, 1.0)


@query(_score_sql(0.5, True))
def composite_score_partial(t):
    return _score(t, 0.5)


@query(_score_sql(0.5, True, "date NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'"))
def composite_score_excluded(t):
    return _score(t, 0.5, exclude_ranges=[("2024-01-05", "2024-01-08")])


@query("""WITH i AS (SELECT *, 0.5 * sqrt(pow(nullif(click, 0), 6.6582) + pow(nullif(error, 0), 6.6582)) AS x FROM user_days)
    SELECT user_id, date, round(x, 4) AS x, round(CASE WHEN view IS NOT NULL AND x IS NOT NULL AND NOT (view = 0 AND x = 1)
    THEN pow(view, 2.8675) - x END, 4) AS score FROM i""")
def composite_score_interaction(t):
    days = t.user_days.withColumn("x", interaction(F.col("click"), F.col("error")))
    spec = ScoreSpec((ScoreTerm("view", 1, 4, 1, 2.8675), ScoreTerm("x", 1, 4, -1)), rescale=False)
    score = composite_score(spec, 1.0, zero_baseline=("view",))
    return days.select("user_id", "date", rounded("x", 4), rounded(score, 4, "score"))


_PAIR = {
    "all_terms": _TERMS,
    "raw_pair": ScoreSpec((ScoreTerm("signup", 0, 4, 2.0), ScoreTerm("view", 0, 4, -0.5, 2.0)), rescale=False),
}
_NOTE_SQL = "CASE WHEN error > 3 THEN 'very bad day' WHEN error > 2 THEN 'bad day' ELSE '' END"
_ALL_SQL = f"({_SUM_SQL.replace('click', 'elevated')} - {_LO}) / ({_HI} - {_LO}) * 200 - 100"
_KNOWN_TIDY = _KNOWN_SQL.replace("click", "elevated")
_REST_TIDY = "coalesce(elevated = 0 AND error = 1 AND purchase = 1 AND signup = 1 AND view = 1, false)"
_PAIR_SQL = "(coalesce(2 * signup, 0) - coalesce(0.5 * pow(view, 2), 0))"
_PAIR_N = "CAST(signup IS NOT NULL AS INTEGER) + CAST(view IS NOT NULL AS INTEGER)"
_PAIR_REST = "coalesce(signup = 1 AND view = 1, false)"
_TIDY = f"""n AS (SELECT *, {_NOTE_SQL} AS note FROM user_days),
    e AS (SELECT *, CASE WHEN regexp_matches(note, 'v.ry') THEN 5.0 WHEN regexp_matches(note, 'bad') THEN 4.0
        ELSE click END AS elevated FROM n),
    wide AS (SELECT user_id, date, note,
        CASE WHEN ({_KNOWN_TIDY}) = 5 AND NOT {_REST_TIDY} THEN {_ALL_SQL} END AS all_terms,
        CASE WHEN ({_KNOWN_TIDY}) >= 2.5 AND NOT {_REST_TIDY} THEN {_ALL_SQL} END AS all_terms_partial,
        CASE WHEN ({_PAIR_N}) = 2 AND NOT {_PAIR_REST} THEN {_PAIR_SQL} END AS raw_pair,
        CASE WHEN ({_PAIR_N}) >= 1 AND NOT {_PAIR_REST} THEN {_PAIR_SQL} END AS raw_pair_partial FROM e)"""


@query(f"""WITH {_TIDY}
    SELECT user_id, date, note, 'all_terms' AS metric, round(all_terms, 6) AS value, round(all_terms_partial, 6) AS value_partial FROM wide
    UNION ALL SELECT user_id, date, note, 'raw_pair', round(raw_pair, 6), round(raw_pair_partial, 6) FROM wide""")
def tidy_scores(t):
    note = F.when(F.col("error") > 3, "very bad day").when(F.col("error") > 2, "bad day").otherwise("")
    days = t.user_days.withColumn("note", note).withColumnRenamed("click", "elevated").withColumn(
        "anxiety", F.col("error")).withColumn("depressed", F.col("signup"))
    specs = {
        name: ScoreSpec(tuple(ScoreTerm("elevated" if c.column == "click" else c.column, c.low, c.high, c.weight, c.power)
                              for c in s.terms), s.rescale)
        for name, s in _PAIR.items()
    }
    tidy = diary_scores(days, [("bad", 4.0), ("v.ry", 5.0)], ["user_id"], specs)
    return tidy.select("user_id", "date", "note", "metric", rounded("value"), rounded("value_partial"))


@query("""SELECT user_id, date, metric, value FROM (UNPIVOT (SELECT user_id, date, coalesce(click, -1) AS click,
    coalesce(view, -1) AS view, coalesce(error, -1) AS error FROM user_days)
    ON click, view, error INTO NAME metric VALUE value)""")
def unpivot_scores(t):
    days = t.user_days.select("user_id", "date", "click", "view", "error").fillna(-1.0)
    return shape.unpivot_columns(days, ["user_id", "date"], ["click", "view", "error"])


# --- diary: events as main diary, symptom definitions and entries -------------------------
_SYMPTOMS = (
    (1, "click", "Liberty"), (2, "error", "Negative  Liberty"), (3, "purchase", "Floss"),
    (4, "signup", "Asked how friends are"), (5, "view", "Positive Liberty"),
)
_NAMES = ("liberty", "negative_liberty", "floss", "asked_how_friends_are", "positive_liberty")
_DIARY_AS_OF = "2024-02-05"


def _diary(t, job=None):
    days = t.user_days
    note = F.when(F.col("view") > 2, F.concat(F.lit("view "), F.col("view").cast("int").cast("string")))
    main = days.select(
        "user_id", F.lit(7).alias("ID"),
        F.date_format(F.date_add("date", 6), "yyyy-MM-dd").alias("DATE (YYYY-MM-DD)"), note.alias("NOTE"),
        F.col("click").alias("elevated"), F.col("error").alias("depressed"), F.col("signup").alias("anxiety"))
    kinds = literal_table(t.spark, ["ID", "event_type", "NAME"], _SYMPTOMS)
    entries = t.levels.join(kinds, "event_type").select(
        "user_id", F.col("ID").alias("SYMPTOM"), F.datediff("date", F.lit("2024-01-01").cast("date")).alias("ENTRY"),
        F.when(F.col("level") > 0, F.col("level")).alias("VALUE"), "event_id")
    # One ordinal scale for everybody, so that the last day is the same for all users.
    if job:
        return job(main, kinds.select("ID", "NAME"), entries, _DIARY_AS_OF, ["user_id"], "event_id")
    return diary_wide(main, kinds.select("ID", "NAME"), entries, _DIARY_AS_OF, ["user_id"], None, "event_id")


def _after_first(col: str, src: str | None = None) -> str:
    src = src or col
    return (f"CASE WHEN {src} IS NULL AND date > min(CASE WHEN {src} IS NOT NULL THEN date END) OVER (PARTITION BY user_id) "
            f"THEN 1.0::DOUBLE ELSE {src} END AS {col}")


_DIARY_SQL = f"""top AS (SELECT user_id, max(date) AS last FROM levels GROUP BY 1),
    entry AS (SELECT l.user_id, DATE '{_DIARY_AS_OF}' - CAST(last - date AS INTEGER) AS date, event_type, event_id,
        CASE WHEN level > 0 THEN level END AS v FROM levels l JOIN top ON top.user_id = l.user_id),
    sym AS (SELECT user_id, date, {", ".join(
        f"arg_min(v, event_id) FILTER (WHERE event_type = '{e}' AND v IS NOT NULL) AS {n}"
        for (_, e, _), n in zip(_SYMPTOMS, _NAMES))} FROM entry GROUP BY 1, 2),
    main AS (SELECT user_id, date + 6 AS date, coalesce(CASE WHEN view > 2 THEN 'view ' || CAST(view AS INTEGER) END, '') AS note,
        click AS elevated, error AS depressed, signup AS anxiety FROM user_days),
    joined AS (SELECT main.*, coalesce(liberty, (positive_liberty + negative_liberty) / 2) AS liberty, floss, asked_how_friends_are
        FROM main LEFT JOIN sym ON sym.user_id = main.user_id AND sym.date = main.date),
    diary AS (SELECT user_id, date, note, {", ".join(_after_first(c) for c in (
        "elevated", "depressed", "anxiety", "liberty", "floss", "asked_how_friends_are"))} FROM joined)"""


@query(f"WITH {_DIARY_SQL} SELECT * FROM diary")
def diary_clean(t):
    return _diary(t).select(
        "user_id", "date", "note", "elevated", "depressed", "anxiety", "liberty", "floss", "asked_how_friends_are")


# The symptoms of the sparse diary, an entry per row.
@query(f"""WITH {_DIARY_SQL} SELECT user_id, date, note, elevated, name, value FROM (
    SELECT user_id, date, note, elevated, liberty, floss, asked_how_friends_are FROM diary)
    UNPIVOT (value FOR name IN (liberty, floss, asked_how_friends_are))""")
def diary_sparse(t):
    return _diary(t, sparse_job).select("user_id", "date", "note", "elevated", F.explode("symptoms").alias("name", "value"))


@query(f"WITH {_DIARY_SQL} SELECT user_id, date, floss - 1.0 AS floss, asked_how_friends_are - 1.0 AS asked_how_friends_are FROM diary")
def counters_from_scores(t):
    return shape.counters_from_scores(_diary(t), ["user_id", "date"], ["floss", "asked_how_friends_are"])
