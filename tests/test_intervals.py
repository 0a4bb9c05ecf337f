"""Interval enrichment against pairs in plain Python, and the rows that it makes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import joins

WANTED = {"mean": ("hr", "avg"), "total": ("hr", "sum"), "steps": ("walk", "sum")}


def moment(second: float) -> dt.datetime:
    return dt.datetime(1969, 12, 31, 22) + dt.timedelta(seconds=second)


def brute(spans, points):
    out = {}
    for i, k, s, e in spans:
        found = {"hr": [], "walk": []}
        for kind, key, ms, me, v in points:
            if key == k and s <= ms <= me <= e:
                found[kind].append(v)
        known = [v for v in found["hr"] if v is not None]
        steps = [v for v in found["walk"] if v is not None]
        out[i] = (sum(known) / len(known) if known else None, sum(known) if known else 0.0 if found["hr"] else None,
                  sum(steps) if steps else 0.0 if found["walk"] else None)
    return out


@pytest.mark.parametrize("shape", ["short", "long", "mixed", "instants"])
def test_against_pairs(spark, shape):
    """Times before and after 1970, on and off whole seconds, spans from nothing to a day, ends that touch."""
    rng = random.Random(shape)
    whole = [0.0, 7200.0, 67.108864, 134.217728, 7200 - 67.108864, 7200 + 67.108864 * 4]
    time = lambda: rng.choice(whole) if rng.random() < 0.2 else round(rng.uniform(0, 15000), rng.choice([0, 6]))
    length = {"short": lambda: rng.choice([0, 1e-6, 1, 50]), "long": lambda: rng.uniform(0, 9000), "instants": lambda: 0.0,
              "mixed": lambda: rng.choice([0, 0.5, 60, 68, 300, 4000])}[shape]
    points = []
    for _ in range(400):
        t = time()
        points.append((rng.choice(["hr", "walk"]), rng.choice("ab"), t, t + length(), rng.choice([None, 1.0, 2.0, 4.0])))
    spans = []
    for i in range(150):
        t = time()
        spans.append((i, rng.choice("ab"), t, t + rng.choice([0, 1e-6, 30, 70, 200, 3600, rng.uniform(0, 10000)])))
    spans.append((999, "a", 500.0, 100.0))
    stamp = lambda rows, at: [tuple(moment(x) if j in at else x for j, x in enumerate(r)) for r in rows]
    exact = lambda rows, at: [tuple(round(x * 1e6) if j in at else x for j, x in enumerate(r)) for r in rows]
    ms = spark.createDataFrame(stamp(points, (2, 3)), "type string, k string, start timestamp_ntz, end timestamp_ntz, value double")
    iv = spark.createDataFrame(stamp(spans, (2, 3)), "i int, k string, start timestamp_ntz, end timestamp_ntz")
    want = brute(exact(spans, (2, 3)), exact(points, (2, 3)))
    ends = [None, "end"] if shape == "instants" else ["end"]
    for end in ends:
        got = joins.enrich_intervals(iv, ms, WANTED, ["k"], m_end=end).collect()
        assert {r.i: (r.mean, r.total, r.steps) for r in got} == {i: tuple(pytest.approx(v) if v is not None else None for v in t) for i, t in want.items()}


@pytest.mark.parametrize("few", [0, 2, 10**6])
def test_few_and_many_measurements_of_a_slot(spark, monkeypatch, few):
    """The same sums whether intervals meet measurements or totals, or some these and some those; null keys meet none."""
    monkeypatch.setattr(joins, "_FEW", few)
    rng = random.Random(few)
    points = []
    for _ in range(300):
        t = rng.uniform(0, 3 * 86400) if rng.random() < 0.5 else rng.uniform(5000, 6000)
        points.append((rng.choice(["hr", "walk"]), rng.choice(["a", "b", None]), t, t + rng.choice([0, 1, 60, -1]), rng.choice([None, 1.0, 2.0])))
    spans = [(i, rng.choice(["a", "b", None]), t, t + rng.choice([0, 5, 300, 3600, 90000]))
             for i, t in enumerate(rng.uniform(-100, 3 * 86400) if rng.random() < 0.6 else rng.uniform(5000, 6000) for _ in range(120))]
    spans += [(1000, "a", 10.0, 5.0), (1001, "a", 5000.0, 6000.0), (1002, "a", 5000.0, 6000.0)]
    stamp = lambda rows: [(*r[:2], moment(r[2]), moment(r[3]), *r[4:]) for r in rows]
    exact = lambda rows: [(*r[:2], round(r[2] * 1e6), round(r[3] * 1e6), *r[4:]) for r in rows]
    ms = spark.createDataFrame(stamp(points), "type string, k string, start timestamp_ntz, end timestamp_ntz, value double")
    iv = spark.createDataFrame(stamp(spans), "i int, k string, start timestamp_ntz, end timestamp_ntz")
    want = brute(exact([s for s in spans if s[1] is not None]), exact(points))
    got = joins.enrich_intervals(iv, ms, WANTED, ["k"]).collect()
    assert sorted(r.i for r in got) == sorted(s[0] for s in spans)
    for r in got:
        assert (r.mean, r.total, r.steps) == tuple(pytest.approx(v) if v is not None else None for v in want.get(r.i, (None,) * 3))


def test_sparse_intervals_need_no_running_totals(spark):
    """Hours that hold a measurement or two are joined with these, without sorting totals of some fifteen rows an hour."""
    at = lambda every: F.timestamp_micros(F.col("id") * every * 1_000_000 + 1_600_000_000_000_000)
    ms = spark.range(2000).select(F.lit("hr").alias("type"), at(1800).alias("start"), F.lit(1.0).alias("value"))
    iv = spark.range(1000).select("id", at(3600).alias("start"), (at(3600) + F.expr("interval 1 hour")).alias("end"))
    rows = joins.enrich_intervals(iv, ms, {"n": ("hr", "sum")}, m_end=None)
    assert {r.id: r.n for r in rows.collect()} == {i: 3.0 if i < 999 else 2.0 for i in range(1000)}
    assert "Window" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_rows_per_interval(spark):
    """An hour becomes some fifteen rows, a short measurement two."""
    hours = spark.range(2000).select((F.col("id") * 977_000_000 + 1_600_000_000_000_000).alias("_s")).withColumn("_e", F.col("_s") + 3_600_000_000)
    placed = joins._placed(hours)
    assert joins._pieces(placed.select(F.expr("_c0 + 1 as _s"), F.expr("_c1 - 1 as _e")), joins._WIDE).count() / 2000 < 11
    assert placed.agg(F.avg(2 * F.col("_l") + F.greatest(F.lit(0), F.col("_hi") - F.col("_lo") - 1) * 2)).first()[0] < 9
    short = joins._placed(hours.select("_s", (F.col("_s") + 1_000_000).alias("_e")))
    assert short.where("_l = 0").count() / 2000 > 0.97
