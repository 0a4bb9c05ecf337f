"""Places in a total order: against Spark's own window, whatever the bound of a part."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window as W, functions as F

from daybook.operators import fill, order, stats, windows

NUMBERS = [None, float("nan"), float("-inf"), float("inf"), 0.0, -0.0, 1.5, 1e-300, -1e308, 1e308, 5e-324]
NAMES = [None, "", "a", "ab", "abc", "abd", "é", "\U0001f600", "ab\x00", "common start 1", "common start 2"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    values = [*NUMBERS, *[rng.gauss(0, 5) for _ in range(10)]]
    rows = [(rng.choice([None, "x"]), rng.choice(values), rng.choice(NAMES), rng.randint(0, 3)) for _ in range(250)]
    # A third of all rows are identical.
    return spark.createDataFrame([*rows, *[("x", 2.0, "abc", 1)] * 120], "k string, v double, n string, r int").persist()


def cell(row):
    return tuple(repr(c + 0.0) if isinstance(c, float) else c for c in row)


@pytest.mark.parametrize("bound", [8, 10**6])
def test_numbers_are_those_of_one_sort(table, bound):
    ranked = table.withColumn("i", F.rank().over(W.partitionBy("k").orderBy("v", "n", "r"))).collect()
    want, have = {}, {}
    for r in ranked:
        want.setdefault(cell(r[:4]), []).append(r.i)
    for r in order.numbered(table, ["v", "n", "r"], "i", ["k"], bound).collect():
        have.setdefault(cell(r[:4]), []).append(r.i)
    assert {k: sorted(v) for k, v in have.items()} == {k: list(range(v[0], v[0] + len(v))) for k, v in want.items()}


def test_no_part_is_heavier_than_the_bound(table):
    parts = order.ordered_parts(table, ["k"], ["v", "n"], 8)
    sizes = parts.groupBy("_group", "_path").agg(F.count("*").alias("n"), F.count_distinct(F.hash("v", "n", "r")).alias("kinds")).collect()
    assert all(r.n <= 8 or r._path.endswith("=") for r in sizes) and any(r._path.endswith("=") and r.n >= 120 for r in sizes)
    assert order.ordered_parts(table, ["k"], ["v"], 1000) is None
    assert order.ordered_parts(table.limit(0), ["k"], ["v"], 0) is None


@pytest.mark.parametrize("bound", [8, 10**6])
def test_exact_medians(table, bound):
    finite = table.where(F.col("v").isNull() | F.isnan("v") | (F.abs("v") < 1e300))
    found = {(r.k, r.r): r.median for r in order.exact_medians(finite, "v", ["k", "r"], bound=bound).collect()}
    want = finite.groupBy("k", "r").agg(F.median(F.when(~F.isnan("v"), F.col("v"))).alias("m")).collect()
    assert set(found) == {(r.k, r.r) for r in want}
    assert all(found[r.k, r.r] == pytest.approx(r.m, rel=1e-12) for r in want)


def test_medians_of_heavy_groups_cut_their_middle_only(spark, monkeypatch):
    """Even, skewed, tied, gapped and infinite groups; what is settled does not grow with the values outside the middle."""
    rng, inf = random.Random(7), float("inf")
    values = {
        "even": [float(i) for i in range(2000)], "odd": [rng.gauss(0, 1) for _ in range(1501)],
        "steep": [10.0 ** rng.uniform(-30, 30) for _ in range(1000)], "tied": [1.0] * 500 + [2.0] * 500,
        "gap": [-5.0 - i for i in range(300)] + [7.0 + i for i in range(300)], "ends": [-inf] * 40 + [3.0, 4.0, 4.5] + [inf] * 40,
        "few": [2.0, 9.0], "none": [None, float("nan")], None: [float(i % 50) for i in range(900)], "zero": [0.0, -0.0] * 30}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    rng.shuffle(rows)
    kept = []
    real = order.settle

    def settle(df, name, folder):
        kept.append(real(df, name, folder))
        return kept[-1]

    monkeypatch.setattr(order, "settle", settle)
    got = {r.k: r.median for r in order.exact_medians(spark.createDataFrame(rows, "k string, v double"), "v", ["k"], bound=8).collect()}
    want = {k: statistics.median(known) if (known := [v for v in vs if v is not None and v == v]) else None for k, vs in values.items()}
    assert got == {k: pytest.approx(v, rel=1e-12) if v is not None else None for k, v in want.items()}
    assert sum(df.count() for df in kept if "_v" not in df.columns) < 100


def test_dates_times_and_flags_are_cut(spark):
    rows = spark.range(600).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"),
        F.timestamp_micros(F.col("id") * 7919 % 1_000_003).alias("t"), (F.col("id") % 2 == 0).alias("b"),
        (F.col("id") * (1 << 53)).cast("decimal(38,0)").alias("big"), F.col("id"))
    for by in (["d", "t"], ["b", "id"], ["big"], ["t"]):
        want = {r.id: r.i for r in rows.withColumn("i", F.row_number().over(W.orderBy(*by, F.col("id")))).collect()}
        have = {r.id: r.i for r in order.numbered(rows, [*by, "id"], "i", bound=16).collect()}
        assert have == want


def test_many_names_of_one_median_and_one_beginning(spark):
    rows = spark.range(3000).select(F.concat(F.lit("the same beginning "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"), F.lit(1.0).alias("v"))
    got = stats.order_by_median(rows, "c", "v", bound=200).collect()
    assert [r.sort_key for r in sorted(got, key=lambda r: r.c)] == list(range(1, 3001))


@pytest.mark.parametrize("bound", [1, 10**6])
def test_minus_infinity_does_not_come_before_null(spark, bound):
    """Default order: the value itself; NULL and NaN first, then minus infinity."""
    inf = float("inf")
    rows = [("2024-01-01", x) for x in (None, -inf, 2.0, inf, float("nan"))] + [("2024-01-02", None), ("2024-01-02", -inf)]
    df = spark.createDataFrame(rows, "date string, v double").withColumn("date", F.to_date("date"))
    got = fill.forward_fill(df, "v", bound=bound).collect()
    first = sorted((r.v for r in got if r.date.day == 1), key=lambda v: (v is not None, v or 0.0))
    assert first == [None, None, -inf, 2.0, inf]
    assert sorted(r.v for r in got if r.date.day == 2) == [-inf, inf]


def test_a_third_of_all_rows_in_one_tie(spark):
    """One day, one time: known and unknown readings, many of them identical, are placed by many tasks."""
    rows = spark.range(900).select(
        F.lit("2024-01-01").cast("date").alias("date"), F.lit(5).alias("at"), F.when(F.col("id") < 400, 3).otherwise(F.col("id")).alias("id"),
        F.when((F.col("id") >= 400) & (F.col("id") % 3 == 0), F.col("id").cast("double")).alias("v"))
    got = fill.interpolate(rows, "v", order=["at", "id"], bound=20).orderBy("id").collect()
    # 400 unknown copies of id 3 come first and stay unknown; the others lie on a line.
    assert [r.v for r in got[:400]] == [None] * 400
    known = [r for r in got[400:] if r.v is not None]
    assert len(got) == 900 and all(math.isclose(r.v, min(r.id, 897)) for r in known) and len(known) >= 498


def test_identical_unknown_rows_share_the_way(spark):
    rows = [("2024-01-01", 1, 0.0)] + [("2024-01-01", 2, None)] * 9 + [("2024-01-01", 3, 10.0)]
    df = spark.createDataFrame(rows, "date string, o int, v double").withColumn("date", F.to_date("date"))
    for bound in (2, 100):
        got = sorted(r.v for r in fill.interpolate(df, "v", order=["o"], bound=bound).collect())
        assert got == pytest.approx([float(i) for i in range(11)])


def test_numbers_are_written_by_many_tasks(spark):
    """A row that stands for many is written in chunks, each by its own task, though chunks are small rows."""
    df = spark.createDataFrame([("a", 1_000_000)], "s string, n long")
    out = windows.repeat_rows(df, "n", out="i")
    tasks = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in tasks) == 1_000_000 and len(tasks) > 1
