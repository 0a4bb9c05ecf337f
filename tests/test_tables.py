"""Rules, breaks and names as tables; sections hidden in XML; published and settled tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from daybook.operators import labels, settle, shape, windows
from daybook.plans import diary
from daybook.sources import csvs, xmls


def test_literal_grams(spark):
    """Only what every match must hold."""
    cases = {"happy": {"hap", "app", "ppy"}, "ab": set(), "abc|def": set(), "(?i)abc": set(), "abcd?": {"abc"}, "abcd*x": {"abc"},
             "ab.cde": {"cde"}, r"one\.two": {"one", "two"}, r"one\wtwo": {"one", "two"}, "(maybe)?sure": {"sur", "ure"},
             "x[abc]yes": {"yes"}, "abcd+ef": {"abc", "bcd"}, "abc{2,3}def": {"def"}, "((ab)c)+def": {"def"}, "^start$": {"sta", "tar", "art"}, "a[": set()}
    rows = spark.createDataFrame([(p,) for p in cases], "p string")
    assert {r.p: set(r.g) for r in rows.select("p", labels.literal_grams(F.col("p")).alias("g")).collect()} == cases


@pytest.mark.parametrize("regex", [True, False])
def test_rules_against_one_after_the_other(spark, regex):
    rng = random.Random(6)
    parts = ["sun", "rain", "walk", "home", "été", "\U0001f600", "no", "x1", "a.b", " "]
    texts = [None, "", "a", *["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(150)]]
    rules = [(i, "".join(rng.choices(parts, k=rng.randint(1, 3))), float(i % 7)) for i in range(80)]
    if regex:
        rules += [(100 + i, p, 9.0) for i, p in enumerate(["su?n walk", "(home|no)x1", "[rw]ain +", "q|x1a", "h.me", "été$", "^rain", "ho(me)?sun"])]
    rules += [(None, "sun", 1.0), (500, None, 1.0), (3, "sun", 99.0)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate([*texts, *texts[:20]])], "i int, t string, pattern string")
    table = spark.createDataFrame(rules, "ordinal int, pattern string, score double")
    got = {r.i: r.s for r in labels.rule_scores(df, "t", table, "s", F.lit(-1.0), regex).collect()}
    for i, text in enumerate([*texts, *texts[:20]]):
        hits = [(o, s) for o, p, s in rules if None not in (text, o, p) and (re.search(p, text) if regex else p in text)]
        assert got[i] == (max(hits)[1] if hits else -1.0), text
    assert {r.s for r in labels.rule_scores(df, "t", table.limit(0), "s").collect()} == {None}


def test_rules_make_no_pairs(spark):
    df = spark.createDataFrame([("some words here",)], "t string")
    rules = spark.createDataFrame([(1, "words", 2.0)], "ordinal int, pattern string, score double")
    plan = labels.rule_scores(df, "t", rules, "s")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_breaks_of_ones_own(spark, frame):
    inf, nan = float("inf"), float("nan")
    breaks = frame("k string, bound double", [("a", 0.0), ("a", 30.0), ("a", 100.0), ("a", 30.0), ("b", 5.0), ("b", inf), (None, 1.0), (None, 2.0), ("a", None)])
    rows = [("a", 0.0), ("a", -1.0), ("a", 30.0), ("a", 30.5), ("a", 101.0), ("b", 5.0), ("b", 1e9), ("b", 4.0), (None, 1.5), ("c", 1.0), ("a", None), ("a", nan)]
    df = frame("k string, v double", rows)
    got = [r.bucket for r in shape.bucket_by_key(df.coalesce(1).withColumn("i", F.monotonically_increasing_id()), "v", breaks, ["k"]).orderBy("i").collect()]
    assert got == ["0-30", None, "0-30", "30-100", None, "5+", "5+", None, "1-2", None, None, None]


def test_fifty_thousand_names(spark):
    """Names of many people make no columns, and nothing is collected for them."""
    ids = spark.range(50_000)
    symptoms = ids.select(F.col("id").alias("ID"), F.concat(F.lit("Symptom "), F.col("id").cast("string")).alias("NAME"))
    entries = ids.select((F.col("id") % 500).cast("string").alias("user"), F.col("id").alias("SYMPTOM"), (F.col("id") % 3).cast("int").alias("ENTRY"),
                         F.lit(4.0).alias("VALUE"), F.col("id").alias("row_order"))
    main = spark.range(500).select(F.col("id").cast("string").alias("user"), F.lit(1).alias("ID"), F.explode(F.array(
        *[F.lit(f"2024-01-0{d}") for d in (1, 2, 3)])).alias("DATE (YYYY-MM-DD)"), F.lit(None).cast("string").alias("NOTE"), F.lit(1.0).alias("elevated"))
    out = diary.diary_sparse(main, symptoms, entries, "2024-01-03", ["user"])
    assert len(out.columns) == 5
    sizes = out.groupBy("date").agg(F.sum(F.size("symptoms")).alias("n")).orderBy("date").collect()
    assert [r.n for r in sizes] == [16667, 33334, 50000]
    one = {str(r.date): r.symptoms for r in out.where("user = '7'").collect()}
    assert one["2024-01-03"]["symptom_7"] == 1.0 and one["2024-01-02"]["symptom_7"] == 4.0 and "symptom_7" not in one["2024-01-01"]


HIDDEN = """<Data>
<Record a="1"/><!-- <Record a="no1"/>
<Record a="no2"/> <![CDATA[ <Record a="no3"/> --><Record a="2"/>
<Text><![CDATA[ <Record a="no4"/> <!-- ]]></Text><Record a="3"/><!-- plain --><Record a="4" note="a > b"/>
{filler}<!-- <Record a="no5"/>{long}<Record a="no6"/> ]]> --><Record a="5"/>
<Record a="6"/></Data>"""


def test_sections_over_several_blocks(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("a", StringType())])
    text = HIDDEN.format(filler='<Other b="x"/>' * 300, long='<Record a="no"/>' * 2000)
    (tmp_path / "one.xml").write_text(text)
    (tmp_path / "two.xml").write_text('<Data><Record a="7"/><!-- <Record a="no"/></Data>')
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = xmls.read_elements(spark, str(tmp_path / "one.xml"), "Record", schema, comments="skip")
        assert found.rdd.getNumPartitions() > 1
        assert sorted(r.a for r in found.collect()) == ["1", "2", "3", "4", "5", "6"]
        whole = xmls.read_elements(spark, str(tmp_path / "one.xml"), "Record", schema, split=False)
        assert sorted(r.a for r in whole.collect()) == ["1", "2", "3", "4", "5", "6"]
        both = xmls.read_elements(spark, str(tmp_path), "Record", schema, comments="skip")
        assert sorted(r.a for r in both.collect()) == ["1", "2", "3", "4", "5", "6", "7"]
        with pytest.raises(Exception, match="comment or CDATA"):
            xmls.read_elements(spark, str(tmp_path), "Record", schema).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_readers_keep_the_old_tables_if_a_job_dies(spark, tmp_path):
    folder = str(tmp_path / "out")
    six = {f"t{i}": spark.range(i + 1) for i in range(6)}
    first = csvs.publish_all(six, folder)
    broken = dict(six, t2=spark.range(5).select(F.raise_error(F.lit("dies")).cast("long").alias("id")))
    with pytest.raises(Exception, match="dies"):
        csvs.publish_all(broken, folder)
    assert {n: df.count() for n, df in csvs.read_published(spark, folder).items()} == {f"t{i}": i + 1 for i in range(6)}
    second = csvs.publish_all({"t0": spark.range(9)}, folder, "csv")
    assert {n: df.count() for n, df in csvs.read_published(spark, folder).items()} == {"t0": 9}
    third = csvs.publish_all({"t0": spark.range(10)}, folder)
    assert csvs.drop_versions(spark, folder, 1) == [second, first] and third > second > first
    assert not (tmp_path / "out" / first).exists() and csvs.read_published(spark, folder)["t0"].count() == 10


def test_settled_tables_are_cleaned_up(spark, tmp_path):
    with settle.settled(spark) as paths:
        df = settle.settle(spark.range(3), "x", str(tmp_path))
        assert df.count() == 3 and len(paths) == 1
    assert not list(tmp_path.iterdir())


def test_rows_in_buckets_stay_where_they_are(spark):
    sets = spark.range(5000).select((F.col("id") % 7).cast("string").alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"),
                                    F.col("id").cast("double").alias("v"))
    stored = settle.settle_bucketed(sets, "sets", ["s", "date"], 4)
    try:
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        daily = stored.groupBy("s", "date").agg(F.max("v"))
        assert "Exchange" not in daily._jdf.queryExecution().executedPlan().toString()
        query = lambda df: windows.with_series_maxima(df, "v", ["s"], {"top": None})
        plan = query(stored)._jdf.queryExecution().executedPlan().toString()
        # The daily table goes to its series' window and back; the sets don't move.
        assert plan.count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, query(stored).collect())) == sorted(map(tuple, query(sets).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for table in spark.catalog.listTables():
            if table.name.startswith("sets_"):
                spark.sql(f"DROP TABLE {table.name}")
