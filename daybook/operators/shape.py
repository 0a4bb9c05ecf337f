"""Column names, column sets, pivots, explodes, bins and buckets."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daybook.functions.dates import DateLike, date_lit, month_bin
from daybook.operators.stats import attach


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case names, every blank to an underscore."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def snake_names(df: DataFrame) -> DataFrame:
    """Lower-case names, every run of white space to one underscore."""
    return df.toDF(*[snake(c) for c in df.columns])


def snake(name: str) -> str:
    return re.sub(r"\s+", "_", name).lower()


def first_column(df: DataFrame, name: str) -> DataFrame:
    return df.select(name, *[F.col(f"`{c}`") for c in df.columns if c != name])


def counters_from_scores(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Scores 1..n as counts 0..n-1."""
    return df.select(*keys, *[(F.col(c) - 1.0).alias(c) for c in cols])


def pivot_first(df: DataFrame, rows: Sequence[str], name: str, value: str, order: str,
                names: Sequence[str]) -> DataFrame:
    """Long to wide; a cell takes its first non-NULL value by ``order``.

    ``names`` is given, so finding the columns needs no job of its own.
    """
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    return df.groupBy(*rows).pivot(name, list(names)).agg(first)


def pivot_map(df: DataFrame, rows: Sequence[str], name: str, value: str, order: str, out: str = "cells") -> DataFrame:
    """Long to one map column per row, name -> first non-NULL value by ``order``; names without a value are left out.

    The sparse form of ``pivot_first``: no column per name, so nothing has to know all names.
    """
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    cells = df.where(F.col(name).isNotNull()).groupBy(*rows, name).agg(first.alias("_value"))
    entry = F.when(F.col("_value").isNotNull(), F.struct(F.col(name), F.col("_value")))
    return cells.groupBy(*rows).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(out))


def unpivot_pairs(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                  suffix: str = "_partial") -> DataFrame:
    """One row per metric with its ``value`` and ``value_partial``, in one pass."""
    cells = F.array(*[
        F.struct(
            F.lit(m).alias("metric"), F.col(m).alias("value"), F.col(m + suffix).alias("value_partial")
        )
        for m in metrics
    ])
    return df.select(*ids, F.inline(cells))


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "metric",
                    value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), name, value)


def explode_labels(df: DataFrame, col: str, out: str, sep: str = ", ") -> DataFrame:
    """One row per label of a delimited text; a NULL text keeps its row."""
    return df.withColumn(out, F.explode_outer(F.split(F.col(col), re.escape(sep))))


def backdate(df: DataFrame, ordinal: str, as_of: DateLike, keys: Sequence[str] = (),
             out: str = "date") -> DataFrame:
    """Day ordinals to dates: the greatest ordinal is ``as_of``."""
    dated = attach(df, keys, _max_ordinal=F.max(ordinal))
    age = (F.col("_max_ordinal") - F.col(ordinal)).cast("int")
    return dated.withColumn(out, F.date_sub(date_lit(as_of), age)).drop("_max_ordinal")


def month_bins(df: DataFrame, months: int, keys: Sequence[str] = (), date: str = "date",
               out: str = "time_bin") -> DataFrame:
    """Bins of ``months`` months, counted from the month of a key's first date."""
    anchored = attach(df, keys, _anchor=F.min(date))
    return anchored.withColumn(out, month_bin(F.col(date), F.col("_anchor"), months)).drop("_anchor")


def bucket_labels(breaks: Sequence[float]) -> list[str]:
    """``0-30``, ``30-100``, ..., and ``300+`` for an open last bucket."""
    return [
        f"{lo:.0f}+" if math.isinf(hi) else f"{lo:.0f}-{hi:.0f}" for lo, hi in zip(breaks, breaks[1:])
    ]


def bucket(value: Column, breaks: Sequence[float]) -> Column:
    """Label of the right-closed bucket ``(lo, hi]``; the first one includes its lower end."""
    expr = F.when(value < breaks[0], None)
    for hi, label in zip(breaks[1:], bucket_labels(breaks)):
        expr = expr.when(value.isNotNull() if math.isinf(hi) else value <= hi, label)
    return expr


def display_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows a limited axis would show; apply after windows and running sums."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def bucket_by_key(df: DataFrame, value: str, breaks: DataFrame, keys: Sequence[str], bound: str = "bound", out: str = "bucket") -> DataFrame:
    """Label of the right-closed bucket of each value among its key's own breaks, as ``bucket`` gives it.

    ``breaks`` has a row per key and break, the lowest included; infinity is the open end.  A key's breaks are one
    sorted list, which its rows meet in an equi join, so no row is paired with the breaks of others or sorted; NULL keys
    meet NULL keys.  NULL, NaN and values outside the breaks have no bucket.
    """
    listed = breaks.where(F.col(bound).isNotNull() & ~F.isnan(F.col(bound).cast("double"))).groupBy(
        F.struct(F.lit(0).alias("_all"), *keys).alias("_key")).agg(
        F.array_sort(F.array_distinct(F.collect_list(F.col(bound).cast("double")))).alias("_bounds"))
    keyed = df.withColumn("_key", F.struct(F.lit(0).alias("_all"), *keys))
    v = F.col(value).cast("double")
    # The number of breaks below the value; the first bucket includes its lower end.
    below = F.size(F.filter("_bounds", lambda b: b < v))
    place = F.when(v == F.element_at("_bounds", 1), 1).otherwise(below)
    lo, hi = F.get("_bounds", place - 1), F.get("_bounds", place)
    text = lambda b: F.format_string("%.0f", b)
    label = F.when(hi == float("inf"), F.concat(text(lo), F.lit("+"))).otherwise(F.concat(text(lo), F.lit("-"), text(hi)))
    inside = v.isNotNull() & ~F.isnan(v) & (place >= 1) & (place < F.size("_bounds"))
    return keyed.join(listed, "_key", "left").withColumn(out, F.when(inside, label)).drop("_key", "_bounds")
