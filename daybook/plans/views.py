"""The tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from daybook import config
from daybook.functions.dates import DateLike, date_lit, month_bin
from daybook.functions.numeric import null_if_nan, signed_parts
from daybook.functions.text import lift_label, metric_label, title_case
from daybook.operators.joins import classify
from daybook.operators.kernel import with_ewma
from daybook.operators.shape import bucket, display_range
from daybook.operators.settle import settle
from daybook.operators.stats import attach, order_by_median, recency_ranked
from daybook.operators.windows import best_in_span, choose, ranked_with_ties
from daybook.session import shared_folder

_LINES = {"cummax": "cummax_one_rep_max", "rolling": "rolling_90d_max"}


def one_rep_max_view(df: DataFrame, names: Sequence[str] = (), line: str = "rolling",
                     highlight: bool = False, single_reps: bool = False,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Chosen exercises with the line to draw, the emphasis of each point, and its label."""
    mine = df.where(F.col("exercise_name").isin(list(names or config.DEFAULT_EXERCISES)))
    if highlight:
        mine = best_in_span(mine, "one_rep_max", [*keys, "exercise_name"], 30)
        emphasis = F.when(F.col("is_best_lift"), config.EMPHASIS_BEST).otherwise(config.EMPHASIS_OTHER)
    else:
        mine = mine.withColumn("is_best_lift", F.lit(False))
        emphasis = F.lit(config.EMPHASIS_PLAIN)
    return mine.select(
        *keys, "date", "exercise_name", "reps", "one_rep_max", choose(line, **_LINES).alias("line"),
        "is_best_lift", emphasis.alias("emphasis"),
        (F.lit(single_reps) & (F.col("reps") == 1)).alias("single_rep"),
        lift_label(F.col("date"), F.col("exercise_name"), F.col("one_rep_max")).alias("label"),
    )


def heatmap_cells(df: DataFrame, classes: DataFrame | None, metric: str, category: str,
                  bin_months: int, keys: Sequence[str] = (), series: str = "exercise_name",
                  value: str = "one_rep_max", dedupe: bool = False, folder: str | None = None) -> DataFrame:
    """Frequency or Volume per time bin and category.

    Sets are first counted per month and exercise, and these counts are settled: the first month,
    the bins and the classification, whose several rows per exercise multiply counts and not
    sets, all come from them, so the sets are read once.
    """
    month = F.trunc("date", "MM").alias("date")
    months = df.groupBy(*keys, month, series).agg(
        F.count("*").alias("Frequency"), F.coalesce(F.sum(null_if_nan(F.col(value))), F.lit(0.0)).alias("Volume")
    )
    months = settle(months, "months", folder or shared_folder(df.sparkSession))
    anchored = attach(months, keys, _anchor=F.min("date"))
    cells = anchored.withColumn("time_bin", month_bin(F.col("date"), F.col("_anchor"), bin_months))
    if classes is not None:
        cells = classify(cells, classes, series, config.CLASS_CATEGORIES if dedupe else ())
    return cells.groupBy(*keys, "time_bin", category).agg(F.sum(metric).alias(metric))


def activity_heatmap(df: DataFrame, classes: DataFrame | None = None, metric: str = "Frequency",
                     category: str = "Push_Pull_Legs", bin_months: int = 2,
                     keys: Sequence[str] = (), dedupe: bool = False, folder: str | None = None) -> DataFrame:
    """Heat-map tiles: cells of clear categories with their bucket and the category's place.

    Per exercise, only the ones present in the most bins are shown.  Categories are ranked and
    numbered in tables of a row per category; cells are settled and only meet the result.
    """
    by_series = category not in config.CLASS_CATEGORIES
    folder = folder or shared_folder(df.sparkSession)
    cells = settle(heatmap_cells(df, classes, metric, category, bin_months, keys, dedupe=dedupe, folder=folder), "cells", folder)
    clear = cells.where(~F.col(category).isin(*config.UNCLEAR_LABELS) & F.col(category).isNotNull())
    if by_series:
        bins = clear.groupBy(*keys, category).agg(F.count("*").alias("_bins"))
        top = ranked_with_ties(bins, "_bins", config.TOP_SERIES, keys).select(*keys, category)
        clear = clear.join(top, [*keys, category], "left_semi")
    titled = clear.withColumn(category, title_case(F.col(category)))
    order = order_by_median(titled, category, metric, keys, folder=folder).drop("median")
    breaks = config.BUCKET_BREAKS[metric, "series" if by_series else "class", bin_months]
    return titled.join(order, [*keys, category]).select(
        *keys, category, "sort_key", "time_bin", metric, bucket(F.col(metric), breaks).alias("bucket"))


def volume_trend(volume: DataFrame, epsilon: float = config.DEFAULT_VOLUME_EPSILON,
                 exclude_zeros: bool = True, keys: Sequence[str] = (),
                 value: str = "one_rep_max") -> DataFrame:
    rows = volume.where(F.col(value) > 0) if exclude_zeros else volume
    return with_ewma(rows, value, epsilon, keys)


def metric_trend(scores: DataFrame, metrics: Sequence[str] = (),
                 epsilon: float = config.DEFAULT_METRIC_EPSILON, keys: Sequence[str] = (),
                 within_axis: bool = False) -> DataFrame:
    """Chosen metrics with their sign, average, bands above and below zero, and label.

    ``within_axis`` leaves out rows the axis would not show, after averaging over all.
    """
    mine = scores.where(
        F.col("metric").isin(list(metrics or config.DEFAULT_METRICS)) & null_if_nan(F.col("value")).isNotNull()
    )
    rows = with_ewma(mine, "value", epsilon, [*keys, "metric"])
    if within_axis:
        rows = display_range(rows, "value", *config.METRIC_AXIS)
    above, below = signed_parts(F.col("exp_moving_avg"))
    return rows.select(
        *keys, "date", "note", "metric", "value", (F.col("value") > 0).alias("positive_value"),
        "exp_moving_avg", above.alias("band_above"), below.alias("band_below"),
        metric_label(F.col("date"), F.col("value"), F.col("note")).alias("label"),
    )


def series_choices(df: DataFrame, as_of: DateLike, keys: Sequence[str] = ()) -> DataFrame:
    """Exercises to offer, most frequent and recent first."""
    return recency_ranked(
        df, "exercise_name", date_lit(as_of), keys, min_rows=config.PICKER_MIN_ROWS,
        max_age=config.PICKER_MAX_AGE, prior=config.PICKER_PRIOR_DAYS,
    )
