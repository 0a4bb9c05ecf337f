"""Running and trailing maxima, running sums, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook.functions.dates import day_number
from daybook.functions.numeric import null_if_nan
from daybook.operators import order
from daybook.operators.order import BOUND
from daybook.operators.settle import settle


def series_maxima(df: DataFrame, value: str, series: Sequence[str], spans: Mapping[str, int | None],
                  date: str = "date") -> DataFrame:
    """Daily maximum per series plus, per entry of ``spans``, the maximum over that many days.

    A span of ``None`` reaches back to the start; ``n`` covers ``(d - n, d]``.  A day whose
    values are all NULL gets NULL; NaN counts as NULL.
    """
    days = df.groupBy(*series, date).agg(F.max(null_if_nan(F.col(value))).alias("daily_max"))
    by_day = W.partitionBy(*series).orderBy(day_number(F.col(date)))
    cols = []
    for name, span in spans.items():
        start = W.unboundedPreceding if span is None else -(span - 1)
        top = F.max("daily_max").over(by_day.rangeBetween(start, 0))
        cols.append(F.when(F.col("daily_max").isNotNull(), top).alias(name))
    return days.select(*series, date, "daily_max", *cols)


def with_series_maxima(df: DataFrame, value: str, series: Sequence[str],
                       spans: Mapping[str, int | None], date: str = "date",
                       settle_in: str | None = None) -> DataFrame:
    """Rows with the maxima of their series as of their day (same-day rows included).

    With ``settle_in``, a shared folder, the daily maxima are written there first (a job of
    its own), so that many rows of few series join by broadcast and are not shuffled at all.
    """
    days = series_maxima(df, value, series, spans, date).drop("daily_max")
    if settle_in:
        days = settle(days, "series-maxima", settle_in)
    return df.join(days, [*series, date], "left")


def best_in_span(df: DataFrame, value: str, series: Sequence[str], days: int = 30,
                 date: str = "date", out: str = "is_best_lift") -> DataFrame:
    """Flag rows equal to their series' maximum over the last ``days`` days."""
    rows = with_series_maxima(df, value, series, {"_span_max": days}, date)
    return rows.withColumn(out, F.col(value) == F.col("_span_max")).drop("_span_max")


def group_max_rows(df: DataFrame, value: str, group: Sequence[str]) -> DataFrame:
    """Rows equal to their group's maximum, ties kept."""
    tops = df.groupBy(*group).agg(F.max(null_if_nan(F.col(value))).alias("_top"))
    return df.join(tops, list(group)).where(null_if_nan(F.col(value)) >= F.col("_top")).drop("_top")


def running_sum(days: DataFrame, value: str, series: Sequence[str], out: str,
                date: str = "date") -> DataFrame:
    """Running sum over a table with one row per series and day."""
    w = W.partitionBy(*series).orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    return days.withColumn(out, F.sum(null_if_nan(F.col(value))).over(w))


def top_k_with_ties(df: DataFrame, series: str, k: int, keys: Sequence[str] = ()) -> DataFrame:
    """Series on the most rows of ``df``: rank <= k, ties kept."""
    return ranked_with_ties(df.groupBy(*keys, series).agg(F.count("*").alias("n")), "n", k, keys)


def ranked_with_ties(counts: DataFrame, n: str, k: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``rank`` by descending ``n`` is at most ``k``.

    Only distinct values of ``n`` are ranked, k of them at most (the limit is applied before
    the shuffle too), so any number of tied rows stay where they are.
    """
    sizes = counts.groupBy(*keys, n).agg(F.count("*").alias("_tied"))
    falling = W.partitionBy(*keys).orderBy(F.desc(n))
    first = sizes.withColumn("_nth", F.row_number().over(falling)).where(F.col("_nth") <= k)
    above = F.coalesce(F.sum("_tied").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranks = first.withColumn("rank", (above + 1).cast("int")).where(F.col("rank") <= k).drop("_tied", "_nth")
    return counts.join(ranks, [*keys, n]).select(*[F.col(f"`{c}`") for c in counts.columns], "rank")


def numbered(df: DataFrame, value: str, name: str, out: str, keys: Sequence[str] = (),
             bound: int = BOUND, folder: str | None = None) -> DataFrame:
    """Rows numbered from 1 by ascending (``value``, ``name``) per key; NULL and NaN values come first.

    A key of more than ``bound`` rows is cut into parts along that order (``ordered_parts``),
    however many rows share a value or the beginning of a name.
    """
    ranked = df.withColumn("_v", null_if_nan(F.col(value).cast("double")))
    return order.numbered(ranked, ["_v", name], out, keys, bound, folder).drop("_v").withColumn(out, F.col(out).cast("int"))


def restrict_to_top(df: DataFrame, series: str, k: int, keys: Sequence[str] = ()) -> DataFrame:
    top = top_k_with_ties(df, series, k, keys).select(*keys, series)
    return df.join(top, [*keys, series], "left_semi")


# Numbers written per generated row group; bounds the array a task holds at a time.
_CHUNK = 100_000


def repeat_rows(df: DataFrame, times: str, start: Column | None = None, out: str | None = None) -> DataFrame:
    """Each row ``times`` times, optionally numbered upwards from ``start`` in ``out``.

    Rows are first split into chunks and spread, so a row to be repeated very often is
    written by many tasks, a chunk at a time.
    """
    name = out or "_number"
    rest = [F.col(f"`{c}`") for c in df.columns if c != times]
    chunks = df.select(
        *rest, times, (F.lit(1) if start is None else start).alias("_start"),
        F.explode(F.sequence(F.lit(0), F.expr(f"({times} - 1) div {_CHUNK}"))).alias("_chunk"),
    )
    first = F.col("_start") + F.col("_chunk") * _CHUNK
    last = F.col("_start") + F.least(F.col(times), (F.col("_chunk") + 1) * _CHUNK) - 1
    # With a number, adaptive execution leaves the tasks apart: a chunk is a small row that stands for many.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(tasks, *rest, "_chunk")
    numbered = spread.select(*rest, F.explode(F.sequence(first, last)).alias(name))
    return numbered if out else numbered.drop(name)


def number_by_day(df: DataFrame, series: Sequence[str], out: str = "cumulative_count",
                  date: str = "date") -> DataFrame:
    """One row per input row, numbered within its series in date order.

    Rows of one day differ in nothing but their number, so the numbers come from daily
    counts: only counts are shuffled and sorted.
    """
    counts = df.groupBy(*series, date).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*series).orderBy(date).rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = counts.withColumn("_before", offset)
    return repeat_rows(offsets, "_n", F.col("_before") + 1, out).select(*series, date, out)


def choose(line: str, **choices: str) -> Column:
    """The column a named choice stands for."""
    return F.col(choices[line])
