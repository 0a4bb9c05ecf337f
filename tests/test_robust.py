"""Odd inputs: files that differ, hidden elements, NaN and infinity, dense and endless intervals, many people, many ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from daybook import schemas
from daybook.operators import fill, joins, kernel, stats, windows
from daybook.plans.build import Exports, build_all
from daybook.plans.diary import symptom_days
from daybook.plans.measurements import workout_energy
from daybook.plans.views import activity_heatmap
from daybook.sources.bundles import load_diary_export, load_health_export
from daybook.sources.csvs import read_strength_log
from daybook.sources.xmls import read_elements

NAN, INF = float("nan"), float("inf")


def test_logs_of_another_column_order_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Exercise Name,Set Order,Weight,Reps\n2024-01-01,Row,1,50,10\n")
    (tmp_path / "b.csv").write_text("Date,Exercise Name,Set Order,Reps,Weight\n2024-01-02,Row,1,10,50\n")
    names = [f.name for f in schemas.STRENGTH_LOG.fields]
    head = {"Date": "2024-01-01", "Exercise Name": "Row", "Set Order": "1", "Weight": "50", "Reps": "10"}
    if not set(names) <= set(head):
        pytest.skip("other columns")
    with pytest.raises(Exception, match="(?i)header"):
        read_strength_log(spark, str(tmp_path / "*.csv")).collect()


def test_nan_in_a_log_is_missing(spark, tmp_path):
    names = [f.name for f in schemas.STRENGTH_LOG.fields]
    row = {"Weight": "NaN", "Reps": "5", "Set Order": "1", "Exercise Name": "Row", "Date": "2024-01-01"}
    (tmp_path / "log.csv").write_text(",".join(names) + "\n" + ",".join(row.get(n, "") for n in names) + "\n")
    assert read_strength_log(spark, str(tmp_path / "log.csv")).first()["Weight"] is None


def test_elements_in_comments_are_an_error(spark, tmp_path):
    path = tmp_path / "x.xml"
    for inner, bad in (("<!-- <Record type='ghost'/> -->", True), ("<![CDATA[<Record type='ghost'/>]]>", True), ("<!-- plain -->", False)):
        path.write_text(f"<A>{inner}<Record type='real'/></A>")
        rows = read_elements(spark, str(path), "Record", schemas.HEALTH_RECORD)
        if bad:
            with pytest.raises(Exception, match="split=False"):
                rows.collect()
        else:
            assert [r.type for r in rows.collect()] == ["real"]


def test_several_archives_need_a_key(spark, tmp_path):
    for name in ("a", "b"):
        fx.write_zip(tmp_path / f"{name}.zip", {"apple_health_export/export.xml": fx.health_xml()})
        fx.write_zip(tmp_path / f"{name}.diary", fx.diary())
    with pytest.raises(ValueError, match="2 archives"):
        load_health_export(spark, str(tmp_path / "*.zip"), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="2 archives"):
        load_diary_export(spark, str(tmp_path / "*.diary"), str(tmp_path / "s"))


def test_every_recorded_symptom_has_a_column(spark):
    names = spark.createDataFrame([(1, "Floss"), (2, "New  Symptom")], "ID int, NAME string")
    entries = spark.createDataFrame([(1, 5, 2.0, 1), (2, 5, 3.0, 2)], "SYMPTOM int, ENTRY int, VALUE double, row_order int")
    row = symptom_days(names, entries, "2024-01-01").first()
    assert row["floss"] == 2.0 and row["new_symptom"] == 3.0 and row["energy"] is None


def test_two_people_at_once_are_two_runs(spark, tmp_path):
    for name in ("ann", "bob"):
        (tmp_path / name).mkdir()
        fx.write_all(tmp_path / name)
    own = fx.write_all(tmp_path / "ann")
    every = {k: p.replace("/ann/", "/*/") for k, p in own.items()}
    both = build_all(spark, Exports(**every, staging=str(tmp_path / "s"), person="/(ann|bob)/"), fx.AS_OF)
    single = build_all(spark, Exports(**own, staging=str(tmp_path / "t")), fx.AS_OF)
    for name, table in single.items():
        want = sorted(map(str, table.collect()))
        for person in ("ann", "bob"):
            got = both[name].filter(F.col("person") == person).select(*table.columns)
            assert sorted(map(str, got.collect())) == want, name
    plans = [t._jdf.queryExecution().executedPlan().toString() for t in both.values()]
    assert not any("Scan text" in p or "export.xml" in p for p in plans)


def test_energy_counts_on_the_day_of_its_entry(spark):
    row = ("HKWorkoutActivityTypeRunning", "100", "2024-01-01 23:30:00 -0800", "2024-01-02 00:30:00 -0800", "2024-01-03 08:00:00 -0800")
    df = spark.createDataFrame([row], "workoutActivityType string, totalEnergyBurned string, startDate string, endDate string, creationDate string")
    assert workout_energy(df, ["Running"]).first()["date"] == dt.date(2024, 1, 3)


@pytest.mark.parametrize("value", [NAN, INF, 1e18])
def test_values_outside_an_interval_do_not_touch_it(spark, value):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [("hr", t(10, 5), value), ("hr", t(10, 31), 1.0), ("hr", t(10, 39), 2.0), ("hr", t(10, 35), NAN)]
    ms = spark.createDataFrame([(k, s, s, v) for k, s, v in rows], "type string, start timestamp_ntz, end timestamp_ntz, value double")
    iv = spark.createDataFrame([(1, t(10, 30), t(10, 40)), (2, dt.datetime(1990, 1, 1), dt.datetime(9998, 1, 1)), (3, t(10, 30), t(10, 29))],
                               "id int, start timestamp_ntz, end timestamp_ntz")
    for end in ("end", None):
        got = {r.id: (r.mean, r.total) for r in joins.enrich_intervals(iv, ms, {"mean": ("hr", "avg"), "total": ("hr", "sum")}, m_end=end).collect()}
        assert got[1] == (1.5, 3.0) and got[3] == (None, None)
        assert got[2][1] == (3.0 if value != value else value + 3.0)


def test_a_dense_hour_is_not_paired(spark):
    base = dt.datetime(2024, 1, 1, 10)
    ms = spark.range(3000).select(F.lit("hr").alias("type"), (F.lit(base) + F.make_dt_interval(secs=F.col("id") * 0.1)).alias("start"), F.lit(1.0).alias("value"))
    ms = ms.withColumn("end", F.col("start") + F.expr("interval 50 minutes"))
    iv = spark.range(3000).select("id", (F.lit(base) + F.make_dt_interval(secs=F.col("id") * 0.1 + 600)).alias("start"))
    iv = iv.withColumn("end", F.col("start") + F.expr("interval 1 second"))
    rows = joins.enrich_intervals(iv, ms, {"n": ("hr", "sum")})
    assert rows.filter("n is not null").count() == 0 and rows.count() == 3000
    largest = 0
    rows.write.format("noop").mode("overwrite").save()
    plan = rows._jdf.queryExecution().executedPlan()
    rows._jdf.collectToPython()
    stack = [plan]
    while stack:
        node = stack.pop()
        if "Join" in node.nodeName():
            largest = max(largest, node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        if node.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    assert largest < 200_000


def test_nan_is_missing_in_operators(frame):
    rows = [("a", "2024-01-01", 1.0), ("a", "2024-01-02", NAN), ("a", "2024-01-03", 3.0)]
    df = frame("s string, date date, v double", rows)
    top = {str(r.date): r.m for r in windows.with_series_maxima(df, "v", ["s"], {"m": None}).collect()}
    assert top == {"2024-01-01": 1.0, "2024-01-02": None, "2024-01-03": 3.0}
    average = kernel.with_ewma(df, "v", 0.1, ["s"]).collect()
    assert all(r.exp_moving_avg is None or r.exp_moving_avg == r.exp_moving_avg for r in average)
    assert [r.v for r in fill.interpolate(df, "v", ["s"]).orderBy("date").collect()] == [1.0, 2.0, 3.0]
    assert [r.v for r in fill.forward_fill(df, "v", ["s"]).orderBy("date").collect()] == [1.0, 1.0, 3.0]
    assert stats.daily(df, "v", "sum", ["s"], "date").agg(F.sum("v")).first()[0] == 4.0


def test_far_days_of_a_kernel_weigh_nothing(frame):
    rows = [("2020-01-01", 1e90), ("2024-01-01", 5.0)]
    got = {str(r.date): r.exp_moving_avg for r in kernel.with_ewma(frame("date date, v double", rows), "v", 0.9).collect()}
    assert got == pytest.approx({"2020-01-01": 1e90, "2024-01-01": 5.0})


def test_ranks_and_numbers(spark):
    counts = spark.createDataFrame([(k, s, n) for k in ("x", None) for s, n in (("a", 5), ("b", 5), ("c", 3), ("d", 3), ("e", 1))], "k string, s string, n long")
    got = {(r.k, r.s): r["rank"] for r in windows.ranked_with_ties(counts.fillna("none", ["k"]), "n", 3, ["k"]).collect()}
    assert got == {(k, s): r for k in ("x", "none") for s, r in (("a", 1), ("b", 1), ("c", 3), ("d", 3))}
    values = [None, NAN, -INF, -2.5, -2.0, 0.0, 0.1, 0.1, 7.0, 1e9, INF]
    rows = [(chr(97 + i % 5) * 3, v) for i, v in enumerate(values)]
    numbers = windows.numbered(spark.createDataFrame(rows, "s string, v double"), "v", "s", "n").collect()
    key = lambda r: (-INF if r.v is None or r.v != r.v else r.v, r.s)
    assert sorted(r.n for r in numbers) == list(range(1, len(rows) + 1))
    assert [key(r) for r in sorted(numbers, key=lambda r: r.n)] == sorted(map(key, numbers))


def test_heat_map_orders_no_series_in_one_task(spark):
    sets = spark.range(4000).select(F.format_string("s%d", F.col("id") % 1000).alias("exercise_name"),
                                    F.lit(dt.date(2024, 1, 1)).alias("date"), (F.col("id") % 7 + 1.0).alias("one_rep_max"))
    tiles = activity_heatmap(sets, None, "Volume", "exercise_name", 2)
    assert tiles.count() == 1000 and tiles.agg(F.max("sort_key")).first()[0] == 1000
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    keyless = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(exercise_name" in line]
    assert not keyless
