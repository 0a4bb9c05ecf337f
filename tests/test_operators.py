"""Operators on hand-made frames with written-out results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from daybook import config
from daybook.functions import dates, numeric, text
from daybook.operators import fill, joins, kernel, labels, scores, shape, stats, windows
from daybook.sources.literal import literal_table


def day(s):
    return dt.date.fromisoformat(s)


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


# --- columns -------------------------------------------------------------------------

@pytest.mark.parametrize("given, wanted", [
    ("bench press (barbell)", "Bench Press (Barbell)"),
    ("KNEE RAISE (CAPTAIN'S CHAIR)", "Knee Raise (Captain's Chair)"),
    ("iso-lateral row", "Iso-Lateral Row"),
    (None, None),
])
def test_title_case(spark, given, wanted):
    assert one(spark, text.title_case(F.lit(given).cast("string")))[0] == wanted


def test_regex_capture_misses_are_null(spark):
    c = lambda s: text.capture(F.lit(s), config.DEVICE_NAME_PATTERN)
    assert tuple(one(spark, c("<x>, name:Watch A, m:M>").alias("a"), c("no device").alias("b"))) == ("Watch A", None)


def test_numbers_and_times_from_text(spark):
    got = one(
        spark, numeric.to_number(F.lit("80.5")).alias("a"), numeric.to_number(F.lit("n/a")).alias("b"),
        numeric.to_number(F.lit("NaN")).alias("c"),
        dates.instant(F.lit("2021-04-07 23:42:40 -0800")).cast("string").alias("d"),
        dates.instant(F.lit("2021-04-07 23:42:40-08:00")).cast("string").alias("e"),
        dates.instant(F.lit("soon")).alias("f"),
        dates.wall_clock(F.lit("2021-04-07 23:42:40 -0800")).cast("string").alias("g"),
        dates.wall_clock(F.lit("soon")).alias("h"),
    )
    assert tuple(got) == (80.5, None, None, "2021-04-08 07:42:40", "2021-04-08 07:42:40", None,
                          "2021-04-07 23:42:40", None)


def test_labels_round_half_to_even_and_keep_the_blank(spark):
    d = F.lit(day("2024-01-02"))
    got = one(spark, text.lift_label(d, F.lit("Row"), F.lit(2.5)).alias("a"),
              text.metric_label(d, F.lit(-0.3), F.lit("")).alias("b"),
              text.metric_label(d, F.lit(3.5), F.lit("fun")).alias("c"))
    assert tuple(got) == ("Date: 2024-01-02 <br>Exercise: Row <br>Estimated 1RM: 2",
                          "Date: 2024-01-02 <br>Value: 0 ", "Date: 2024-01-02 <br>Value: 4 <br>Note: fun")


def test_template(spark):
    filled = text.fill_template("a {x} {y}{z} {other}", {"x": F.lit(1), "y": F.lit("b"), "z": F.lit("c")})
    assert one(spark, filled)[0] == "a 1 bc {other}"


def test_one_rep_max_rules(frame):
    df = frame("n string, w double, r double, b double", [
        ("Row", 100.0, 3.0, 180.0), ("Squat (Barbell)", 100.0, 0.0, 180.0), ("Chin Up", 10.0, 15.0, 180.0),
        ("Chin Up", 10.0, 15.0, None), ("Row", None, 3.0, 180.0),
    ])
    got = df.select(numeric.one_rep_max(*[F.col(c) for c in "nwrb"]).alias("m")).collect()
    assert [r.m for r in got] == pytest.approx([110.0, 144.0, 270.0, None, None])


def test_pace(frame):
    df = frame("a double, d double", [(30.0, 4.0), (30.0, 0.0), (30.0, None), (None, 4.0)])
    got = [r[0] for r in df.select(numeric.pace(F.col("a"), F.col("d"))).collect()]
    assert got == pytest.approx([7.3, 0.0, None, None])


def test_parts_and_interaction_keep_null(spark):
    up, down = numeric.signed_parts(F.lit(None).cast("double"))
    x = numeric.interaction(F.lit(4.0), F.lit(4.0))
    zero = numeric.interaction(F.lit(0.0), F.lit(4.0))
    got = one(spark, up.alias("u"), down.alias("d"), x.alias("x"), zero.alias("z"))
    assert (got.u, got.d, got.z) == (None, None, None)
    assert got.x == pytest.approx(0.5 * math.sqrt(2 * 4**6.6582))


@pytest.mark.parametrize("d, week", [("2024-01-06", "2023-12-31"), ("2024-01-07", "2024-01-07"), ("2024-01-08", "2024-01-07")])
def test_weeks_start_on_sunday(spark, d, week):
    assert one(spark, dates.sunday_week(F.lit(day(d))))[0] == day(week)


@pytest.mark.parametrize("k, d, start", [
    (2, "2020-01-20", "2020-01-01"), (2, "2020-02-29", "2020-01-01"), (2, "2020-03-01", "2020-03-01"),
    (4, "2020-12-31", "2020-09-01"), (4, "2021-01-01", "2021-01-01"),
])
def test_month_bins_count_from_the_first_month(spark, k, d, start):
    assert one(spark, dates.month_bin(F.lit(day(d)), F.lit(day("2020-01-20")), k))[0] == day(start)


# --- names, reshaping, buckets -----------------------------------------------------------

def test_names(spark):
    df = spark.range(1).select(F.lit(1).alias("Set Order"), F.lit(2).alias("Self-Acceptance  Score"))
    assert shape.lower_names(df).columns == ["set_order", "self-acceptance__score"]
    assert shape.snake_names(df).columns == ["set_order", "self-acceptance_score"]
    assert shape.first_column(df, "Self-Acceptance  Score").columns == ["Self-Acceptance  Score", "Set Order"]


def test_bucket_edges(frame):
    df = frame("v double", [(-0.5,), (0.0,), (3.0,), (3.1,), (100.0,), (101.0,), (None,)])
    breaks = config.BUCKET_BREAKS["Frequency", "series", 2]
    got = [r[0] for r in df.select(shape.bucket(F.col("v"), breaks)).collect()]
    assert got == [None, "0-3", "0-3", "3-10", "30-100", "100+", None]


def test_pivot_takes_the_first_known_value(frame):
    df = frame("d string, n string, v double, o int", [
        ("a", "x", None, 1), ("a", "x", 2.0, 3), ("a", "x", 9.0, 4), ("a", "y", None, 2), ("b", "y", 5.0, 1),
    ])
    assert rows(shape.pivot_first(df, ["d"], "n", "v", "o", ["x", "y"])) == [("a", 2.0, None), ("b", None, 5.0)]


def test_unpivot_pairs(frame):
    df = frame("d string, a double, a_partial double, b double, b_partial double", [("x", 1.0, 1.5, None, 2.5)])
    assert rows(shape.unpivot_pairs(df, ["d"], ["a", "b"])) == [("x", "a", 1.0, 1.5), ("x", "b", None, 2.5)]


def test_explode_keeps_null_lists(frame):
    df = frame("n string, g string", [("a", "x, y"), ("b", None)])
    assert rows(shape.explode_labels(df, "g", "l").select("n", "l")) == [("a", "x"), ("a", "y"), ("b", None)]


def test_backdate(frame):
    df = frame("u string, e int", [("a", 3), ("a", 10), ("b", 1)])
    got = rows(shape.backdate(df, "e", "2024-03-01", ["u"]))
    assert got == [("a", 10, day("2024-03-01")), ("a", 3, day("2024-02-23")), ("b", 1, day("2024-03-01"))]


# --- aggregates -----------------------------------------------------------------------

def test_mode_or_unclear(frame):
    df = frame("k string, v string, w string", [
        ("one", "a", "x"), ("one", "a", None), ("one", "b", None), ("tie", "a", "x"), ("tie", "b", "x"),
        ("none", None, None), ("null", "a", None), ("null", None, None), ("null", None, None),
    ])
    assert rows(stats.mode_or_unclear(df, ["k"], ["v", "w"], "Unclear")) == [
        ("none", "Unclear", "Unclear"), ("null", "a", "Unclear"), ("one", "a", "x"), ("tie", "Unclear", "x")]


def test_top_k_keeps_ties(frame):
    df = frame("s string", [(s,) for s in "aaabbccdd"] + [("e",)])
    assert [r[0] for r in rows(windows.top_k_with_ties(df, "s", 2).select("s"))] == ["a", "b", "c", "d"]


def test_recency(frame):
    df = frame("s string, date date", [("old", "2020-01-01")] * 3 + [("new", "2024-01-01")] * 3 + [("few", "2024-01-01")])
    got = stats.recency_ranked(df, "s", dates.date_lit("2024-01-11"), min_rows=3, max_age=100)
    assert [tuple(r) for r in got.collect()] == [("new", 3, day("2024-01-01"), 10, 3 / 70)]


def test_median_order(frame):
    df = frame("c string, v double", [("a", 5.0), ("a", 1.0), ("b", 2.0), ("c", 3.0)])
    assert [(r.c, r.sort_key) for r in stats.order_by_median(df, "c", "v").orderBy("sort_key").collect()] == [
        ("b", 1), ("a", 2), ("c", 3)]


# --- windows ---------------------------------------------------------------------------

def test_trailing_maxima_edges(frame):
    df = frame("s string, date date, v double", [
        ("a", "2024-01-01", 9.0), ("a", "2024-01-30", 1.0), ("a", "2024-01-31", 2.0),
        ("a", "2024-03-30", 3.0), ("a", "2024-03-31", 4.0), ("a", "2024-03-31", 1.0),
    ])
    got = windows.with_series_maxima(df, "v", ["s"], {"all": None, "m": 30, "q": 90}).orderBy("date", "v")
    assert [(r["all"], r.m, r.q) for r in got.collect()] == [
        (9, 9, 9), (9, 9, 9), (9, 2, 9), (9, 3, 9), (9, 4, 4), (9, 4, 4)]


def test_all_null_days_have_no_maximum(frame):
    df = frame("s string, date date, v double", [("a", "2024-01-01", 9.0), ("a", "2024-01-02", None)])
    got = windows.with_series_maxima(df, "v", ["s"], {"c": None}).orderBy("date").collect()
    assert [r.c for r in got] == [9.0, None]


def test_settled_maxima_are_the_same_and_leave_the_rows_in_place(spark, frame, tmp_path):
    df = frame("s string, date date, v double", [("a", f"2024-01-{d:02}", float(d % 7)) for d in range(1, 29)] * 3)
    lazy = windows.with_series_maxima(df, "v", ["s"], {"c": None, "w": 7})
    done = windows.with_series_maxima(df, "v", ["s"], {"c": None, "w": 7}, settle_in=str(tmp_path))
    assert rows(lazy) == rows(done)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_best_and_group_rows(frame):
    df = frame("s string, date date, v double", [
        ("a", "2024-01-01", 5.0), ("a", "2024-01-01", 5.0), ("a", "2024-01-01", 4.0), ("a", "2024-01-31", 3.0)])
    best = windows.best_in_span(df, "v", ["s"], 30)
    assert [r[-1] for r in rows(best)] == [False, True, True, True]
    assert rows(windows.group_max_rows(df, "v", ["s", "date"])) == [
        ("a", day("2024-01-01"), 5.0), ("a", day("2024-01-01"), 5.0), ("a", day("2024-01-31"), 3.0)]


def test_numbers_run_through_days_and_chunks(frame, monkeypatch):
    monkeypatch.setattr(windows, "_CHUNK", 3)
    df = frame("s string, date date", [("a", "2024-01-02")] * 7 + [("a", "2024-01-01")] * 3 + [("b", "2024-01-05")])
    got = windows.number_by_day(df, ["s"])
    assert sorted(map(tuple, got.collect())) == (
        [("a", day("2024-01-01"), n) for n in (1, 2, 3)] + [("a", day("2024-01-02"), n) for n in range(4, 11)]
        + [("b", day("2024-01-05"), 1)])


# --- filling ----------------------------------------------------------------------------

def test_spine_ends_at_as_of_and_drops_later_rows(frame):
    df = frame("u string, date date, v double", [("a", "2024-01-01", 1.0), ("a", "2024-01-05", 2.0), ("b", "2024-01-09", 3.0)])
    got = rows(fill.date_spine_fill(df, "2024-01-03", ["u"]))
    assert got == [("a", day("2024-01-01"), 1.0), ("a", day("2024-01-02"), None), ("a", day("2024-01-03"), None)]


def test_dense_fill(frame):
    df = frame("date date, v double", [("2024-01-01", 1.0), ("2024-01-03", None)])
    assert rows(fill.dense_fill(df, "v", out="w")) == [
        (day("2024-01-01"), 1.0), (day("2024-01-02"), 0.0), (day("2024-01-03"), 0.0)]


@pytest.mark.parametrize("keys", [[], ["u"]])
def test_fill_after_first_seen(frame, keys):
    df = frame("u string, date date, `a-b` double, c double", [
        ("x", "2024-01-01", None, None), ("x", "2024-01-02", 3.0, None), ("x", "2024-01-03", None, None)])
    assert [r[2:] for r in rows(fill.fill_after_first_seen(df, ["a-b", "c"], keys))] == [
        (None, None), (3.0, None), (1.0, None)]


def test_interpolation_by_position_and_date(frame):
    data = [("2024-01-01", 1, None), ("2024-01-02", 1, 10.0), ("2024-01-02", 2, None), ("2024-01-05", 1, None),
            ("2024-01-06", 1, 40.0), ("2024-01-07", 1, None)]
    df = frame("date date, o int, v double", data)
    at = lambda got: [r.v for r in got.orderBy("date", "o").collect()]
    assert at(fill.interpolate(df, "v", order=["o"])) == pytest.approx([None, 10, 20, 30, 40, 40])
    assert at(fill.interpolate(df, "v", order=["o"], by="date")) == pytest.approx([None, 10, 10, 32.5, 40, 40])
    assert at(fill.forward_fill(df, "v", order=["o"])) == [None, 10, 10, 10, 40, 40]


def test_interpolation_keeps_rows_without_a_key(frame):
    df = frame("u string, date date, v double", [
        (None, "2024-01-01", 1.0), (None, "2024-01-02", None), (None, "2024-01-03", 3.0), ("a", "2024-01-02", None)])
    assert rows(fill.interpolate(df, "v", ["u"])) == [
        ("a", day("2024-01-02"), None), (None, day("2024-01-01"), 1.0), (None, day("2024-01-02"), 2.0),
        (None, day("2024-01-03"), 3.0)]


# --- kernel, intervals -----------------------------------------------------------------------

@pytest.mark.parametrize("eps", [0.0, 0.005, 0.3, 5.0])
def test_kernel_against_brute_force_over_decades(frame, eps):
    import random

    rng = random.Random(7)
    data = [(rng.choice("ab"), str(day("1975-01-01") + dt.timedelta(days=rng.randrange(18_000))), rng.uniform(-9, 9))
            for _ in range(300)]
    data += [("a", "1999-12-31", 1.0), ("a", "1999-12-31", 2.0), ("a", "1999-12-31", None)]
    got = kernel.with_ewma(frame("s string, date date, v double", data), "v", eps, ["s"])
    for r in got.collect():
        if r.v is None:
            continue
        w = [(math.exp(-eps * abs((r.date - day(d)).days)), v) for s, d, v in data if s == r.s and v is not None]
        assert r.exp_moving_avg == pytest.approx(sum(a * b for a, b in w) / sum(a for a, _ in w), rel=1e-9, abs=1e-9)


def _intervals(spark, points, seed=3, n=120):
    import random

    rng = random.Random(seed)
    base = dt.datetime(2024, 3, 1)
    at = lambda: base + dt.timedelta(seconds=rng.randrange(4 * 86_400))
    iv = []
    for i in range(40):
        s = at()
        iv.append((rng.choice("hab"), i, s, s + dt.timedelta(seconds=rng.randrange(-100, 40_000))))
    iv += [("h", 98, iv[0][2], None), (None, 99, iv[0][2], iv[0][3])]
    ms = []
    for _ in range(n):
        s = rng.choice([at(), rng.choice(iv)[2]])
        length = 0 if points else rng.choice([0, 5, 600, 30_000, 200_000])
        ms.append((rng.choice("hhhab"), rng.choice(["hr", "en", "xx"]), s, s + dt.timedelta(seconds=length),
                   rng.choice([None, 1.5, 2.0, 7.25])))
    ivs = spark.createDataFrame(iv, "u string, id int, s timestamp_ntz, e timestamp_ntz")
    mss = spark.createDataFrame(ms, "u string, type string, start timestamp_ntz, end timestamp_ntz, value double")
    return iv, ms, ivs, mss


@pytest.mark.parametrize("points", [True, False])
@pytest.mark.parametrize("seed", [3, 4])
def test_intervals_against_brute_force(spark, points, seed):
    iv, ms, ivs, mss = _intervals(spark, points, seed)
    got = joins.enrich_intervals(
        ivs, mss, {"hr": ("hr", "avg"), "en": ("en", "sum")}, ["u"], "s", "e",
        m_end=None if points else "end")
    found = {r.id: (r.hr, r.en) for r in got.collect()}
    assert len(found) == len(iv)
    for u, i, s, e in iv:
        inside = [m for m in ms if e is not None and m[0] == u and m[2] >= s and m[3] <= e]
        hr = [m[4] for m in inside if m[1] == "hr" and m[4] is not None]
        en = [m[4] for m in inside if m[1] == "en"]
        assert found[i][0] == (pytest.approx(sum(hr) / len(hr)) if hr else None)
        assert found[i][1] == (pytest.approx(sum(x or 0 for x in en)) if en else None)


def test_equal_intervals_stay_apart(spark):
    iv, ms, ivs, mss = _intervals(spark, True)
    twice = ivs.unionByName(ivs)
    args = ({"hr": ("hr", "avg")}, ["u"], "s", "e")
    once = joins.enrich_intervals(ivs, mss, *args, m_end=None)
    both = joins.enrich_intervals(twice, mss, *args, m_end=None)
    assert rows(both) == sorted(rows(once) * 2, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_outer_join_by_day(frame):
    a = frame("date date, v double", [("2024-01-01", 1.0), ("2024-01-02", 2.0)])
    b = frame("date date, e double", [("2024-01-02", 5.0), ("2024-01-02", 6.0), ("2024-01-03", None)])
    got = joins.full_outer_daily(a, b, ["date"], {"e": 0.0}).select("date", "v", "e")
    assert rows(got) == [(day("2024-01-01"), 1.0, 0.0), (day("2024-01-02"), 2.0, 5.0), (day("2024-01-02"), 2.0, 6.0),
                         (day("2024-01-03"), None, 0.0)]


def test_classification_fan_out_and_dedupe(frame):
    sets = frame("exercise_name string, r int", [("a", 1), ("b", 2)])
    dim = frame("exercise_name string, g string, c string", [("a", "x", "push"), ("a", "y", "push")])
    assert len(rows(joins.classify(sets, dim))) == 3
    assert rows(joins.classify(sets, dim, dedupe=["c"])) == [("a", 1, "push"), ("b", 2, None)]


def test_classified_totals_are_those_of_the_fanned_out_rows(frame):
    sets = frame("exercise_name string, r int", [("a", 1), ("a", None), ("a", 4), ("b", None), (None, 7), (None, 8)])
    dim = frame("exercise_name string, g string, c string", [("a", "x", "push"), ("a", "x", "pull"), ("a", "y", None), (None, "z", "legs")])
    for by, dedupe in ((["g", "c"], ()), (["g"], ()), (["c"], ("c",))):
        want = joins.classify(sets, dim, dedupe=dedupe).groupBy("exercise_name", *by).agg(F.count("*").alias("n"), F.sum("r").alias("r"))
        assert rows(joins.classified_totals(sets, dim, by, ["r"], dedupe=dedupe)) == rows(want)


@pytest.mark.parametrize("key", ["classify_join_fanout", "classify_join_dedup"])
def test_sets_are_added_up_before_they_fan_out(spark, key, tmp_path):
    """A thousand sets of an exercise with sixty class rows do not become sixty thousand rows."""
    from daybook import catalog

    spark.range(60).select(
        "id", F.lit("red rod").alias("p_name"), F.concat(F.lit("Brand#"), "id").alias("p_brand"), F.lit("LARGE").alias("p_type"),
        F.col("id").cast("int").alias("p_size")).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1000).select(
        (F.col("id") % 60).alias("l_partkey"), F.lit("2024-01-01").cast("timestamp").alias("l_shipdate"), F.lit(1.0).alias("l_extendedprice"),
        F.lit(2.0).alias("l_quantity"), F.lit(1).alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = catalog.queries()[key](spark, str(tmp_path))
    got = found.collect()
    assert sum(r.n for r in got) == 1000 * (60 if key.endswith("fanout") else len(got))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (outer,) = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
    assert "Aggregate" in plan[outer + 1]


# --- labels -----------------------------------------------------------------------------

def test_last_rule_wins(frame):
    df = frame("t string, e double", [("good day, great day", 1.0), ("great", 1.0), (None, 2.0), ("dull", 3.0), ("a.b", 0.0)])
    rules = [("great", 4.0), ("good", 5.0), ("a.b", 6.0)]
    got = [r[0] for r in df.select(labels.ordered_rules(F.col("t"), F.col("e"), rules)).collect()]
    assert got == [5.0, 4.0, 2.0, 3.0, 6.0]
    text_only = labels.ordered_rules(F.lit("axb"), F.lit(0.0), [("a.b", 6.0)], regex=False)
    assert df.select(text_only).first()[0] == 0.0


@pytest.mark.parametrize("answer, names", [
    ('[{"exercise_name": "Row", "muscle_groups": "lats", "match_score": 90}]', ["Row"]),
    ('Sure:\n```json\n[{"exercise_name": "Row"}, {"exercise_name": "Dip"}]\n```', ["Row", "Dip"]),
    ('```json\n[{"exercise_name": "Row"}]\n```\nDone.', []),
    ('[{"exercise_name": "Row", ]', []),
    ("I cannot.", []),
    (None, []),
])
def test_answers(frame, answer, names):
    got = labels.parse_answers(frame("a string", [(answer,)]), "a")
    assert [r.exercise_name for r in got.collect()] == names


def test_rollup(spark, frame):
    answers = frame("exercise_name string, muscle_groups string, match_score int", [
        ("Bench", "chest, triceps", 95), ("Row", "lats, quads", 90), ("Odd", "wings", 10), ("None", None, 0)])
    got = labels.rollup_labels(answers, labels.muscle_group_table(spark))
    assert got.columns == ["exercise_name", "muscle_groups", "match_score", "Muscle_Group", "Anterior_Posterior",
                           "Push_Pull_Legs"]
    assert rows(got.drop("muscle_groups", "match_score")) == [
        ("Bench", "chest", "anterior", "push"), ("Bench", "triceps", "anterior", "push"),
        ("None", None, "Unclear", "Unclear"), ("Odd", None, "Unclear", "Unclear"),
        ("Row", "lats", "Unclear", "Unclear"), ("Row", "quads", "Unclear", "Unclear")]


def test_batches_hold_every_name_once(frame):
    names = [f"name {i}" for i in range(57)]
    got = labels.batch_names(frame("n string", [(n,) for n in names * 2] + [(None,)]), "n", 10, "Of {names}.")
    found = got.orderBy("batch").collect()
    assert [r.n_names for r in found] == [10] * 5 + [7]
    assert sorted(n for r in found for n in r.names.split(", ")) == sorted(names)
    assert all(r.request == f"Of {r.names}." for r in found)


# --- scores ------------------------------------------------------------------------------

def test_score_bounds_and_validity(frame):
    spec = scores.score_specs()["subjective_well_being"]
    cols = [t.column for t in spec.terms]
    best = {t.column: (t.high if t.weight > 0 else t.low) for t in spec.terms}
    worst = {t.column: (t.low if t.weight > 0 else t.high) for t in spec.terms}
    resting = {c: 0 if c in config.ZERO_BASELINE else 1 for c in cols}
    half = {**best, "energy": None, "fun": None, "conflict": None, "depressed": None}
    df = frame(", ".join(f"{c} double" for c in cols), [
        tuple(None if d[c] is None else float(d[c]) for c in cols)
        for d in (best, worst, resting, half, {**best, "energy": None})])
    got = df.select(scores.composite_score(spec, 1.0).alias("full"), scores.composite_score(spec, 0.5).alias("part")).collect()
    assert [r.full for r in got] == [pytest.approx(100), pytest.approx(-100), None, None, None]
    assert got[3].part is None and got[4].part is not None and got[2].part is None


def test_score_transform_and_exclusion(frame):
    spec = scores.ScoreSpec((scores.ScoreTerm("x", 0, 10, 2.0, transform=lambda x: x + 1),), rescale=False)
    df = frame("date date, x double", [("2024-01-01", 3.0), ("2024-02-01", 3.0)])
    got = df.select(scores.composite_score(spec, exclude_ranges=[("2024-01-01", "2024-01-31")])).collect()
    assert [r[0] for r in got] == [None, 8.0]


def test_small_tables_are_local_relations(spark):
    df = literal_table(spark, ["a", "b"], [("x", 1), ("y", None)])
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == [("x", 1), ("y", None)]
