"""Attaching per-group or whole-table statistics to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daybook.functions.numeric import null_if_nan
from daybook.operators.order import BOUND, exact_medians
from daybook.operators.windows import numbered


def attach(df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, **aggs: Column) -> DataFrame:
    """Add aggregates of ``source`` (default ``df``) to every row of ``df``.

    With keys: one aggregated row per key, joined on the keys.  Without: a one-row
    scalar subquery, so no join at all.
    """
    source = df if source is None else source
    if keys:
        stats = source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
        return df.join(stats, list(keys), "left")
    row = source.agg(F.struct(*[c.alias(n) for n, c in aggs.items()]).alias("_row"))
    return (
        df.withColumn("_row", row.scalar())
        .select("*", *[F.col(f"_row.{n}").alias(n) for n in aggs])
        .drop("_row")
    )


def distinct_keys(df: DataFrame, cols: Sequence[str], ordered: bool = False) -> DataFrame:
    out = df.select(*cols).distinct()
    return out.orderBy(*cols) if ordered else out


def daily(df: DataFrame, value: str, how: str, keys: Sequence[str] = (), date: str = "date",
          out: str | None = None) -> DataFrame:
    """Daily ``min``, ``max`` or ``sum`` of a column per key; NULL and NaN are skipped."""
    agg = {"min": F.min, "max": F.max, "sum": F.sum}[how]
    return df.groupBy(*keys, date).agg(agg(null_if_nan(F.col(value))).alias(out or value))


def mode_or_unclear(df: DataFrame, keys: Sequence[str], cols: Sequence[str], unclear: str) -> DataFrame:
    """Per key and column: the one most frequent non-NULL value, or ``unclear`` on a tie or none.

    Three hash-partial aggregations (value counts, ties per count, best count); no window
    and no list of a group's values.
    """
    long = df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("_attr"), F.col(c).alias("_value")) for c in cols])
        ).alias("_cell"),
    ).select(*keys, "_cell._attr", "_cell._value")
    counts = long.groupBy(*keys, "_attr", "_value").agg(F.count("_value").alias("_n"))
    ties = counts.groupBy(*keys, "_attr", "_n").agg(
        F.count("*").alias("_ties"), F.min("_value").alias("_value")
    )
    best = ties.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_attr") == c, F.struct("_n", "_ties", "_value"))).alias(c)
            for c in cols
        ]
    )
    return best.select(
        *keys,
        *[
            F.when((F.col(f"{c}._n") > 0) & (F.col(f"{c}._ties") == 1), F.col(f"{c}._value"))
            .otherwise(unclear)
            .alias(c)
            for c in cols
        ],
    )


def recency_ranked(df: DataFrame, series: str, as_of: Column, keys: Sequence[str] = (),
                   date: str = "date", min_rows: int = 50, max_age: int = 1000,
                   prior: int = 60) -> DataFrame:
    """Series with enough, recent enough rows, best ``n / (prior + days since)`` first."""
    out = (
        df.groupBy(*keys, series)
        .agg(F.count("*").alias("n"), F.max(date).alias("last_date"))
        .withColumn("days_since_last", F.datediff(as_of, "last_date"))
        .where((F.col("n") >= min_rows) & (F.col("days_since_last") <= max_age))
        .withColumn("sorting_metric", F.col("n") / (F.lit(prior) + F.col("days_since_last")))
    )
    return out.orderBy(*keys, F.desc("sorting_metric"), series)


def order_by_median(df: DataFrame, category: str, value: str, keys: Sequence[str] = (),
                    out: str = "sort_key", bound: int = BOUND, folder: str | None = None) -> DataFrame:
    """Categories numbered by ascending median of ``value``; ``df`` may hold raw rows.

    A category of more than ``bound`` values, or that many categories, are cut into parts.
    """
    medians = exact_medians(df, value, [*keys, category], "median", bound, folder)
    return numbered(medians, "median", category, out, keys, bound, folder)
