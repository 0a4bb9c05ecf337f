"""Sources, sinks, and the whole way from exports to result tables."""

import csv
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from daybook import schemas
from daybook.plans.build import Exports, build_all
from daybook.plans.classify import classification_requests, classify_exercises
from daybook.plans.diary import diary_wide
from daybook.plans.goals import goal_progress_count, goal_progress_habits, goal_progress_max
from daybook.plans.measurements import (
    clean_measurements, clean_workouts, fill_metrics, enrich_workouts, measurement_spans, select_workouts,
    workout_energy,
)
from daybook.plans.strength import daily_volume_with_energy
from daybook.plans.views import activity_heatmap, metric_trend, one_rep_max_view, series_choices, volume_trend
from daybook.sources.archives import read_archive_lines
from daybook.sources.bundles import load_diary_export, load_health_export
from daybook.sources.csvs import read_csv, save_all, save_csv
from daybook.sources.xmls import read_elements

D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return fx.write_all(tmp_path_factory.mktemp("exports"))


@pytest.fixture(scope="module")
def tables(spark, paths, tmp_path_factory):
    exports = Exports(**paths, staging=str(tmp_path_factory.mktemp("staging")), note_rules=[("trip", 4.5), ("great", 5.0)])
    return build_all(spark, exports, fx.AS_OF)


# --- sources ------------------------------------------------------------------------------

def test_elements_are_found_at_any_depth_and_in_any_split(spark, tmp_path):
    path = tmp_path / "export.xml"
    path.write_text(fx.health_xml())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        split = read_elements(spark, str(path), "Record", schemas.HEALTH_RECORD)
        assert split.rdd.getNumPartitions() > 3
        got = sorted(map(tuple, split.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = read_elements(spark, str(path), "Record", schemas.HEALTH_RECORD, split=False)
    assert got == sorted(map(tuple, whole.collect()), key=str)
    assert len(got) == len(fx.WEIGHTS) + len(fx.HEART)
    assert sum(r[3] == "<<HKDevice: 0x1>, name:Watch A, manufacturer:M>" for r in got) == len(got) - 1


def test_element_spellings(spark, tmp_path):
    path = tmp_path / "odd.xml"
    path.write_text("""<A><Record type='a "b" > c' value="1&lt;2 &amp; 3"\n\tdevice="x"></Record><Record/><Record
 type="/" ><Record type="in"/></Record><Recorder type="no"/></A>""")
    got = read_elements(spark, str(path), "Record", schemas.HEALTH_RECORD).select("type", "value", "device")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [('a "b" > c', "1<2 & 3", "x"), (None, None, None), ("/", None, None), ("in", None, None)], key=str)


def test_archive_lines_keep_their_text(spark, paths):
    lines = read_archive_lines(spark, paths["diary"], ["entry.csv"])
    text = "\n".join(r.value for r in lines.orderBy("line_no").collect()) + "\n"
    assert text == fx.diary()["entry.csv"]
    assert {r.member for r in lines.select("member").distinct().collect()} == {"entry.csv"}


def test_missing_member_is_an_error(spark, tmp_path):
    path = fx.write_zip(tmp_path / "x.zip", {"a.txt": "b"})
    with pytest.raises(FileNotFoundError):
        load_health_export(spark, path, str(tmp_path / "s"))


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID\n1\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "a.csv"), schemas.DIARY_SYMPTOM)


def test_diary_bundle(spark, paths, tmp_path):
    main, symptoms, entries = load_diary_export(spark, paths["diary"], str(tmp_path / "s"))
    assert main.count() == fx.DIARY_DAYS and symptoms.count() == len(fx.SYMPTOMS)
    assert main.where(F.col("NOTE").contains("\n")).count() == 1
    in_order = [tuple(r)[:3] for r in entries.orderBy("row_order").collect()]
    wanted = list(csv.reader(io.StringIO(fx.diary()["entry_custom_symptom.csv"])))[1:]
    assert in_order == [(int(a), int(b), float(c)) for a, b, c in wanted]


def test_saved_tables_read_back(spark, frame, tmp_path):
    df = frame("date date, note string, v double", [("2024-01-01", 'a, "b"', 1.5), ("2024-01-02", None, None)])
    path = save_csv(df, "t", f"{tmp_path}/")
    assert path == f"{tmp_path}/t.csv"
    again = spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(path)
    assert again.select("date", "v").exceptAll(df.select("date", "v")).count() == 0
    paths = save_all({"t": df}, str(tmp_path / "out"))
    assert spark.read.parquet(paths["t"]).exceptAll(df).count() == 0


def test_many_archives_are_told_apart(spark, tmp_path):
    for name in ("a", "b"):
        fx.write_zip(tmp_path / f"{name}.zip", {"apple_health_export/export.xml": fx.health_xml()})
        fx.write_zip(tmp_path / f"{name}.diary", fx.diary())
    records, workouts = load_health_export(spark, str(tmp_path / "*.zip"), str(tmp_path / "s"), by_archive=True)
    _, _, entries = load_diary_export(spark, str(tmp_path / "*.diary"), str(tmp_path / "s"), by_archive=True)
    for df in (records, workouts, entries):
        counts = [r["count"] for r in df.groupBy("archive").count().collect()]
        assert len(counts) == 2 and counts[0] == counts[1]


# --- jobs -----------------------------------------------------------------------------------

@pytest.mark.parametrize("name, schema", [
    ("non_weightlifting_exercise", schemas.WORKOUTS), ("weight", schemas.WEIGHT), ("weightlifting", schemas.STRENGTH),
    ("mental_health", schemas.SCORES), ("volume", schemas.VOLUME),
])
def test_result_columns(tables, name, schema):
    assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema]


def test_metric_sets(frame):
    df = frame("date date, metric string, value double", [("2024-01-01", "Fat", 5.0), ("2024-01-03", "Other", 6.0)])
    got = fill_metrics(df, "2024-01-04", "nutrition").collect()
    assert len(got) == 4 * 5 and [r.value for r in got if r.value is not None] == [5.0]
    assert fill_metrics(df, "2024-01-04", metrics=["Fat", "Other"]).count() == 8


def test_measurements(spark, paths, tmp_path):
    records, _ = load_health_export(spark, paths["health"], str(tmp_path / "s"))
    cleaned = clean_measurements(records)
    assert not {"sourceversion", "creationdate", "startdate"} & set(cleaned.columns)
    late = cleaned.where("type = 'BodyMass' and value = 80").first()
    assert (late.date, late.hour, late.minute, late.wday, late.yday, late.device) == (D("2023-09-03"), 23, 42, 6, 246, "Watch A")
    assert late.enddate == dt.datetime(2023, 9, 4, 7, 42, 40)
    assert cleaned.where("type = 'BodyMass' and value is null").count() == 1
    assert cleaned.where("device is null").count() == 1


def test_weight(tables):
    got = {r.date: r.body_mass for r in tables["weight"].collect()}
    assert len(got) == (fx.AS_OF - D("2023-09-01")).days + 1
    lb = lambda kg: pytest.approx(kg * 2.20462)
    assert got[D("2023-09-01")] is None and got[D("2023-09-02")] is None
    assert got[D("2023-09-03")] == lb(80)
    # By time of day 81.0 comes first, so the four missing rows lie between 80.0 and 84.0.
    assert got[D("2023-09-04")] == lb(80.8) and got[D("2023-09-07")] == lb(83.2)
    assert got[fx.AS_OF] == lb(78)


def test_workouts(tables):
    got = {(r.type, r.date, r.duration) for r in tables["non_weightlifting_exercise"].collect()}
    assert ("Cooldown", dt.datetime(2024, 2, 6, 18), None) in got and ("Soccer", dt.datetime(2024, 2, 1, 7, 30), 45.0) in got
    assert len(got) == 6 and not any(t == "Tennis" for t, _, _ in got)


def test_workout_enrichment(spark, paths, tmp_path):
    records, workouts = load_health_export(spark, paths["health"], str(tmp_path / "s"))
    spans = measurement_spans(records, ["HeartRate", "ActiveEnergyBurned", "DistanceWalkingRunning"])
    got = {r.startdate.date(): r for r in enrich_workouts(clean_workouts(workouts), spans).collect()}
    first = got[D("2024-01-05")]
    assert first.hr_mean == 120.0 and first.total_distance is None and first.pace == 0.0
    assert got[D("2024-02-03")].hr_mean is None and got[D("2024-02-03")].pace == pytest.approx(7.3)
    assert len(got) == len(fx.WORKOUTS)


def test_energy_beside_volume(spark, paths, tables, tmp_path):
    _, workouts = load_health_export(spark, paths["health"], str(tmp_path / "s"))
    energy = workout_energy(workouts)
    both = daily_volume_with_energy(tables["weightlifting"], energy)
    assert energy.count() == 4 and both.where("total_energy_burned > 0 and one_rep_max is null").count() == 4
    assert both.where("one_rep_max is not null").count() == tables["weightlifting"].select("date").distinct().count()


def test_strength(tables):
    df = tables["weightlifting"]
    assert df.columns == [f.name for f in schemas.STRENGTH.fields]
    got = df.collect()
    assert all(0 < r.one_rep_max <= r.rolling_90d_max <= r.cummax_one_rep_max for r in got)
    assert {r.exercise_name for r in got} == {"Bench Press (Barbell)", "Chin Up", "Lateral Raise (Dumbbell)", "Unknown"}
    weight = {r.date: r.body_mass for r in tables["weight"].collect()}
    model = {}
    for row in fx.strength_rows():
        d, name = D(row["Date"][:10]), row["Exercise Name"] or "Unknown"
        load = weight[d] if name == "Chin Up" else row["Weight"] + (44 if "(Barbell)" in name else 0)
        if load is not None:
            model.setdefault((name, d), []).append(load * (1 + row["Reps"] / 30))
    for r in got:
        past = [max(v) for (n, d), v in model.items() if n == r.exercise_name and d <= r.date]
        recent = [max(v) for (n, d), v in model.items() if n == r.exercise_name and 0 <= (r.date - d).days < 90]
        assert r.cummax_one_rep_max == pytest.approx(max(past)) and r.rolling_90d_max == pytest.approx(max(recent))
    assert len(got) == sum(x > 0 for v in model.values() for x in v)


def test_volume(tables):
    got = sorted((r.date, r.one_rep_max) for r in tables["volume"].collect())
    assert [d for d, _ in got] == [got[0][0] + dt.timedelta(days=i) for i in range(len(got))]
    assert sum(v for _, v in got) == pytest.approx(tables["weightlifting"].agg(F.sum("one_rep_max")).first()[0])
    assert any(v == 0 for _, v in got)


def test_diary_tables(tables):
    scores, counters = tables["mental_health"], tables["non_exercise_goal"]
    assert scores.columns == [f.name for f in schemas.SCORES.fields]
    assert scores.count() == 4 * fx.DIARY_DAYS
    assert scores.where("value is not null and (value_partial is null or value <> value_partial)").count() == 0
    assert scores.where("note is null").count() == 0
    floss = [r.floss for r in counters.orderBy("date").collect()]
    known = [i for i, v in enumerate(floss) if v is not None]
    assert known[0] >= fx.FIRST_FLOSS and known == list(range(known[0], fx.DIARY_DAYS))
    assert all(v >= 0 for v in floss if v is not None)


def test_first_entry_wins_and_rules_apply(spark, paths, tables, tmp_path):
    wide = diary_wide(*load_diary_export(spark, paths["diary"], str(tmp_path / "s")), as_of=fx.AS_OF)
    assert wide.agg(F.max("fun")).first()[0] <= 4
    assert wide.columns[0] == "date" and "positive_liberty" not in wide.columns
    trip = wide.where(F.col("note").contains("trip")).first()
    health = {r.date: r for r in tables["mental_health"].where("metric = 'mental_health'").collect()}
    plain = 5.0 ** 2.8675
    if trip.anxiety and trip.depressed:
        plain -= 0.5 * (trip.anxiety ** 6.6582 + trip.depressed ** 6.6582) ** 0.5
    assert health[trip.date].value_partial == pytest.approx(plain)


# --- views and goals on the built tables -------------------------------------------------------

def test_views(spark, tables):
    lifts = tables["weightlifting"].cache()
    shown = one_rep_max_view(lifts, highlight=True).collect()
    assert {r.exercise_name for r in shown} == {"Chin Up", "Bench Press (Barbell)"}
    assert {r.emphasis for r in shown} == {0.5, 0.05}
    assert {r.emphasis for r in one_rep_max_view(lifts, ["Chin Up"], "cummax").collect()} == {0.2}
    trend = metric_trend(tables["mental_health"]).collect()
    assert trend and all(r.metric == "mental_health" for r in trend)
    assert all(r.band_above >= 0 >= r.band_below for r in trend)
    shown = metric_trend(tables["mental_health"], within_axis=True).collect()
    inside = {r.date: r.exp_moving_avg for r in trend if -101 <= r.value <= 101}
    assert {r.date: r.exp_moving_avg for r in shown} == pytest.approx(inside)
    assert volume_trend(tables["volume"]).count() == tables["volume"].where("one_rep_max > 0").count()
    assert series_choices(lifts, fx.AS_OF).count() == 0
    tiles = activity_heatmap(lifts, metric="Volume", category="exercise_name", bin_months=4)
    assert tiles.agg(F.sum("Volume")).first()[0] == pytest.approx(lifts.agg(F.sum("one_rep_max")).first()[0])


def test_goals(spark, paths, tables, tmp_path):
    counts = goal_progress_count(tables["non_weightlifting_exercise"]).collect()
    real = {(r.activity, r.date, r.cumulative_count) for r in counts if r.cumulative_count}
    # 2024-01-31 23:30 at -0800 is February 1st in UTC, and New Year's Eve's yoga is in 2024.
    assert real == {("Soccer", D("2024-01-05"), 1), ("Soccer", D("2024-02-01"), 2), ("Cardio", D("2024-02-03"), 1),
                    ("Stretching", D("2024-01-01"), 1)}
    assert sum(r.cumulative_count == 0 for r in counts) == 3
    workouts = load_health_export(spark, paths["health"], str(tmp_path / "s"))[1]
    by_clock = goal_progress_count(select_workouts(workouts, keep_clock=True), date_basis="wall").collect()
    # By the clock they are January 31st and last year's.
    assert {(r.activity, r.date, r.cumulative_count) for r in by_clock if r.cumulative_count} == {
        ("Soccer", D("2024-01-05"), 1), ("Soccer", D("2024-01-31"), 2), ("Cardio", D("2024-02-03"), 1)}
    best = goal_progress_max(tables["weightlifting"]).collect()
    assert {r.exercise_name for r in best} == {"Chin Up", "Bench Press (Barbell)"}
    start = [r for r in best if r.date == D("2024-01-01")]
    assert all(r.one_rep_max == r.baseline for r in start) and len(start) == 2
    habits = goal_progress_habits(tables["non_exercise_goal"])
    assert habits.where("Count = 0").count() == 4
    total = tables["non_exercise_goal"].agg(F.sum("asked_how_friends_are")).first()[0]
    assert habits.where("Goal = 'AskFriendsUpdates'").agg(F.max("Cumulative")).first()[0] == total


def test_labelling(spark, tables, frame):
    asked = classification_requests(tables["weightlifting"], "Match {names} with {groups}").collect()
    assert len(asked) == 1 and "Chin Up" in asked[0].request and asked[0].request.endswith("glutes, abductors")
    answers = frame("content string", [('```json\n[{"exercise_name": "Chin Up", "muscle_groups": "lats, biceps", "match_score": 99}]\n```',)])
    classes = classify_exercises(answers)
    assert classes.schema.simpleString() == schemas.CLASSIFICATIONS.simpleString()
    tiles = activity_heatmap(tables["weightlifting"], classes).collect()
    assert {r.Push_Pull_Legs for r in tiles} == {"Pull"}
    chins = tables["weightlifting"].where("exercise_name = 'Chin Up'").count()
    assert sum(r.Frequency for r in tiles) == 2 * chins
    single = activity_heatmap(tables["weightlifting"], classes, dedupe=True).collect()
    assert sum(r.Frequency for r in single) == chins
