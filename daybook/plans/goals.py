"""Progress towards a year's goals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook import config
from daybook.functions.dates import date_lit, in_year, sunday_week
from daybook.functions.numeric import goal_fraction
from daybook.operators.windows import number_by_day, repeat_rows, running_sum
from daybook.sources.literal import literal_table


def _start(year: int) -> Column:
    return F.lit(dt.date(year, 1, 1))


def baseline_rows(df: DataFrame, names: Sequence[str], name: str, year: int, keys: Sequence[str] = (),
                  **zeros: Column) -> DataFrame:
    """A zero row on January 1st per goal (and key)."""
    if keys:
        people = df.select(*keys).distinct()
    else:
        people = literal_table(df.sparkSession, ["_one"], [(1,)])
    goals = F.explode(F.array(*[F.lit(n) for n in names])).alias(name)
    return people.select(*keys, _start(year).alias("date"), goals).select(
        "*", *[c.alias(n) for n, c in zeros.items()]
    )


def baseline_max(df: DataFrame, since: str, until: Column, series: str = "exercise_name",
                 value: str = "one_rep_max", keys: Sequence[str] = (), out: str = "baseline") -> DataFrame:
    """Each series' maximum over ``[since, until)``."""
    span = (F.col("date") >= date_lit(since)) & (F.col("date") < until)
    return df.where(span).groupBy(*keys, series).agg(F.max(value).alias(out))


def goal_progress_max(df: DataFrame, goals: Mapping[str, float] = config.MAX_GOALS,
                      year: int = config.GOAL_YEAR, since: str = config.BASELINE_FROM,
                      series: str = "exercise_name", value: str = "one_rep_max",
                      keys: Sequence[str] = ()) -> DataFrame:
    """How far from its baseline to its goal each series has come, on each day's best rows.

    The baseline, the best since ``since``, stands as a row of January 1st.  Without one
    there is no progress to speak of: NULL.  One scan: rows are counted per series, day and
    value, and only each day's best value with its count goes on.
    """
    until = dt.date(year + 1, 1, 1)
    first = _start(year)
    span = (F.col("date") >= date_lit(since)) & (F.col("date") < date_lit(until))
    mine = df.where(F.col(series).isin(list(goals)) & span)
    group = [*keys, series]
    is_base = F.col("date") < first
    counts = mine.groupBy(
        *group, is_base.alias("_base"), F.greatest(F.col("date"), first).alias("date"), F.col(value)
    ).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*group, "_base", "date").agg(F.max(F.struct(value, "_n")).alias("_best"))
    days = best.select(
        *group, "date", "_base", F.col(f"_best.{value}").alias(value),
        F.when(F.col("_base"), F.lit(1)).otherwise(F.col("_best._n")).cast("bigint").alias("_n"),
    )
    per_series = W.partitionBy(*group)
    upto = per_series.orderBy("date").rangeBetween(W.unboundedPreceding, W.currentRow)
    same_day = per_series.orderBy("date").rangeBetween(W.currentRow, W.currentRow)
    shown = (
        days.withColumn("baseline", F.max(F.when(F.col("_base"), F.col(value))).over(per_series))
        .withColumn("cummax", F.max(value).over(upto))
        .withColumn("_top", F.max(value).over(same_day))
        .where(F.col(value) >= F.col("_top"))
    )
    targets = literal_table(df.sparkSession, [series, "goal"], [(n, float(g)) for n, g in goals.items()])
    rated = shown.join(F.broadcast(targets), series, "left").select(
        *group, "date", value, "baseline", "cummax", "goal",
        goal_fraction(F.col("cummax"), F.col("goal"), F.col("baseline")).alias("progress"), "_n",
    )
    return repeat_rows(rated, "_n")


def utc_date(ts: Column) -> Column:
    """UTC date of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def _day_and_year(df: DataFrame, ts: str, basis: str, year: int) -> tuple[Column, Column]:
    """The day a time falls on, and a test for the year that the scan can use."""
    if df.schema[ts].dataType.typeName() != "timestamp":
        return F.to_date(ts), in_year(F.to_date(ts), year)
    if basis == "wall":
        return F.to_date("clock"), in_year(F.to_date("clock"), year)
    first, after = (dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc) for y in (year, year + 1))
    return utc_date(F.col(ts)), (F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(after))


def goal_progress_count(df: DataFrame, mapping: Mapping[str, str] = config.TYPE_CATEGORIES,
                        goals: Mapping[str, tuple[int, float]] = config.COUNT_GOALS,
                        year: int = config.GOAL_YEAR, date_basis: str = "utc",
                        keys: Sequence[str] = (), kind: str = "type", ts: str = "date",
                        amount: str = "duration") -> DataFrame:
    """Running count of sessions long enough for their category, against the yearly goal.

    ``date_basis`` is the day an instant falls on: ``utc``, or ``wall`` (needs ``clock``).
    """
    spark = df.sparkSession
    wanted = [
        (t, c, int(goals[c][0]), float(goals[c][1])) for t, c in mapping.items() if c in goals
    ]
    lookup = literal_table(spark, [kind, "activity", "_times", "_least"], wanted)
    day, this_year = _day_and_year(df, ts, date_basis, year)
    sessions = (
        df.where(F.col(kind).isin([w[0] for w in wanted]) & this_year)
        .select(*keys, kind, day.alias("date"), amount)
        .join(F.broadcast(lookup), kind)
        .where(F.col(amount) >= F.col("_least"))
        .select(*keys, "activity", F.col("_times").cast("double").alias("goal"), "date")
    )
    counted = number_by_day(sessions, [*keys, "activity", "goal"])
    progress = counted.select(
        *keys, "date", "activity", "cumulative_count", "goal",
        goal_fraction(F.col("cumulative_count"), F.col("goal")).alias("progress_percentage"),
    )
    zero = baseline_rows(
        df, list(goals), "activity", year, keys, cumulative_count=F.lit(0).cast("bigint"),
        goal=F.lit(0.0), progress_percentage=F.lit(0.0),
    )
    return zero.unionByName(progress)


def goal_progress_sum(df: DataFrame, goals: Mapping[str, tuple[str, float]] = config.SUM_GOALS,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Running sum of each positive counter over all time, against its goal."""
    cells = F.array(*[
        F.struct(F.lit(name).alias("Goal"), F.lit(float(goal)).alias("_goal"), F.col(c).cast("double").alias("_n"))
        for c, (name, goal) in goals.items()
    ])
    long = df.select(*keys, "date", F.inline(cells)).where(F.col("_n") > 0)
    series = [*keys, "Goal", "_goal"]
    days = long.groupBy(*series, "date").agg(F.sum("_n").alias("Count"))
    summed = running_sum(days, "Count", series, "Cumulative")
    return summed.select(
        *keys, "date", "Goal", "Count", "Cumulative",
        goal_fraction(F.col("Cumulative"), F.col("_goal")).alias("progress_percentage"),
    )


def goal_progress_weekly(df: DataFrame, goal: tuple[str, str, float, int] = config.WEEKLY_GOAL,
                         keys: Sequence[str] = ()) -> DataFrame:
    """Running number of weeks (from Sunday) with enough days on which the counter was positive."""
    col, name, target, least = goal
    weeks = (
        df.where(F.col(col) > 0)
        .groupBy(*keys, sunday_week(F.col("date")).alias("date"))
        .agg(F.count("*").cast("double").alias("Count"))
        .where(F.col("Count") >= least)
        .withColumn("_one", F.lit(1.0))
    )
    counted = running_sum(weeks, "_one", keys, "Cumulative")
    return counted.select(
        *keys, "date", F.lit(name).alias("Goal"), "Count", "Cumulative",
        goal_fraction(F.col("Cumulative"), F.lit(float(target))).alias("progress_percentage"),
    )


def goal_progress_habits(df: DataFrame, sums: Mapping = config.SUM_GOALS,
                         weekly: tuple = config.WEEKLY_GOAL, year: int = config.GOAL_YEAR,
                         keys: Sequence[str] = ()) -> DataFrame:
    """Sum-type and weekly goals with their zero rows, in one table."""
    names = [name for name, _ in sums.values()] + [weekly[1]]
    zero = baseline_rows(
        df, names, "Goal", year, keys, Count=F.lit(0.0), Cumulative=F.lit(0.0),
        progress_percentage=F.lit(0.0),
    )
    return zero.unionByName(goal_progress_sum(df, sums, keys)).unionByName(
        goal_progress_weekly(df, weekly, keys)
    )
