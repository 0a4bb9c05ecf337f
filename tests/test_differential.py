"""Random tables: operators against small pandas models, and rules any input must obey."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybook import config
from daybook.functions.dates import date_lit
from daybook.operators import fill, kernel, stats, windows
from daybook.plans.goals import goal_progress_max
from daybook.plans.strength import strength_metrics
from daybook.plans.views import activity_heatmap

BASE = dt.date(2023, 1, 1)


def table(seed: int, n: int = 200, days: int = 250, nulls: float = 0.2) -> pd.DataFrame:
    rng = random.Random(seed)
    return pd.DataFrame([
        {"s": rng.choice("abc"), "date": BASE + dt.timedelta(days=rng.randrange(days)), "i": i,
         "v": None if rng.random() < nulls else float(rng.randrange(1, 40))}
        for i in range(n)
    ])


def to_spark(spark, pdf: pd.DataFrame):
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "s string, date date, i int, v double")


def by_row(df, *cols):
    return {r.i: tuple(r[c] for c in cols) for r in df.collect()}


def same(a, b):
    return (a is None or a != a) == (b is None or b != b) and (a is None or a != a or a == pytest.approx(b))


@pytest.mark.parametrize("seed", [1, 2])
def test_maxima(spark, seed):
    pdf = table(seed)
    got = by_row(windows.with_series_maxima(to_spark(spark, pdf), "v", ["s"], {"c": None, "r": 90}), "c", "r")
    known = [(r.s, r.date, r.v) for r in pdf.itertuples() if not pd.isna(r.v)]
    for row in pdf.itertuples():
        if not any(s == row.s and d == row.date for s, d, _ in known):
            assert got[row.i] == (None, None)  # a day without any value has no maximum
            continue
        for k, span in ((0, 10**6), (1, 90)):
            assert got[row.i][k] == max(v for s, d, v in known if s == row.s and 0 <= (row.date - d).days < span)


@pytest.mark.parametrize("seed, nulls", [(3, 0.2), (4, 0.9), (5, 1.0)])
def test_positional_interpolation(spark, seed, nulls):
    pdf = table(seed, nulls=nulls).sort_values(["s", "date", "i"])
    got = by_row(fill.interpolate(to_spark(spark, pdf), "v", ["s"], order=["i"]), "v")
    filled = by_row(fill.forward_fill(to_spark(spark, pdf), "v", ["s"], order=["i"]), "v")
    pdf["v"] = pdf["v"].astype(float)
    pdf["linear"] = pdf.groupby("s")["v"].transform(lambda x: x.interpolate())
    pdf["last"] = pdf.groupby("s")["v"].ffill()
    for row in pdf.itertuples():
        assert same(got[row.i][0], row.linear) and same(filled[row.i][0], row.last)


@pytest.mark.parametrize("seed", [6, 7])
def test_unique_mode(spark, seed):
    rng = random.Random(seed)
    pdf = pd.DataFrame([{"k": rng.randrange(30), "v": rng.choice(["a", "b", "c", None])} for _ in range(120)])
    rows = [(int(r.k), r.v) for r in pdf.itertuples()]
    got = dict(map(tuple, stats.mode_or_unclear(spark.createDataFrame(rows, "k int, v string"), ["k"], ["v"], "Unclear").collect()))
    for k, values in pdf.groupby("k")["v"]:
        modes = values.mode()
        assert got[k] == (modes.iloc[0] if len(modes) == 1 else "Unclear")


def test_goal_progress_with_ties_and_january_sets(spark):
    rng = random.Random(8)
    rows = []
    for day in ["2023-11-05", "2023-12-31", "2024-01-01", "2024-01-01", "2024-02-01", "2024-02-01", "2024-12-31", "2025-01-01"]:
        rows += [(n, dt.date.fromisoformat(day), float(rng.randrange(1, 4))) for n in ("p", "q") for _ in range(4)]
    rows.append(("new", dt.date(2024, 5, 5), 2.0))
    goals = {"p": 10.0, "q": 3.0, "new": 5.0}
    df = spark.createDataFrame(rows, "exercise_name string, date date, one_rep_max double")
    wanted = []
    for name, goal in goals.items():
        mine = [(d, v) for n, d, v in rows if n == name]
        before = [v for d, v in mine if dt.date(2023, 10, 1) <= d < dt.date(2024, 1, 1)]
        base = max(before, default=None)
        year = [(d, v) for d, v in mine if d.year == 2024] + ([(dt.date(2024, 1, 1), base)] if before else [])
        for d, v in year:
            if v >= max(x for e, x in year if e == d):
                top = max(x for e, x in year if e <= d)
                share = None if base is None or goal == base else (top - base) / (goal - base)
                wanted.append((name, d, v, base, top, goal, share))
    got = [tuple(r) for r in goal_progress_max(df, goals).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


# --- rules -------------------------------------------------------------------------------------

def _all(spark, pdf, keys):
    """Several operators at once, as comparable lists."""
    df = to_spark(spark, pdf).withColumn("u", F.lit("one"))
    number = F.coalesce("v", F.lit(0.0))
    sets = df.select(*keys, "date", F.col("s").alias("exercise_name"), "i", number.alias("weight"),
                     F.lit(3.0).alias("reps"), F.lit(70.0).alias("body_mass"))
    strength = strength_metrics(sets, keys=keys)
    results = {
        "linear": fill.interpolate(df, "v", [*keys, "s"], order=["i"]).select("i", F.round("v", 9)),
        "spine": fill.date_spine_fill(df.drop("u") if not keys else df, "2023-09-30", keys).select("date", "i"),
        "kernel": kernel.with_ewma(df.where("v is not null"), "v", 0.05, keys).select("i", F.round("exp_moving_avg", 9)),
        "strength": strength.drop("u"),
        "heat": activity_heatmap(strength, None, "Volume", "exercise_name", 2, keys).drop("u").withColumn("Volume", F.round("Volume", 6)),
        "recent": stats.recency_ranked(df, "s", date_lit("2024-01-01"), keys).drop("u"),
    }
    return {name: sorted(map(str, r.collect())) for name, r in results.items()}


def test_a_constant_key_changes_nothing(spark):
    pdf = table(9)
    assert _all(spark, pdf, []) == _all(spark, pdf, ["u"])


def test_row_order_and_partitions_change_nothing(spark):
    pdf = table(10)
    first = _all(spark, pdf, ["u"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert first == _all(spark, pdf.sample(frac=1, random_state=1), ["u"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_key_by_shuffled_joins(spark):
    """A third of the rows in one series, and no side small enough to broadcast."""
    pdf = table(11, n=600)
    pdf.loc[pdf.index % 3 == 0, "s"] = "hot"
    want = by_row(windows.with_series_maxima(to_spark(spark, pdf), "v", ["s"], {"c": None, "r": 30}), "c", "r")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        df = windows.with_series_maxima(to_spark(spark, pdf), "v", ["s"], {"c": None, "r": 30})
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert by_row(df, "c", "r") == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_kernel_limits(spark):
    """No decay gives the mean; strong decay gives the day's own mean."""
    pdf = table(12, nulls=0.0)
    df = to_spark(spark, pdf)
    flat = by_row(kernel.with_ewma(df, "v", 0.0), "exp_moving_avg")
    sharp = by_row(kernel.with_ewma(df, "v", 60.0), "exp_moving_avg")
    own = pdf.groupby("date")["v"].mean()
    for row in pdf.itertuples():
        assert flat[row.i][0] == pytest.approx(pdf.v.mean()) and sharp[row.i][0] == pytest.approx(own[row.date])


def test_unclear_labels_are_the_configured_ones():
    assert config.UNCLEAR in config.UNCLEAR_LABELS
