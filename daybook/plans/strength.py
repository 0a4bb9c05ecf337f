"""Strength sets and daily volume."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from daybook import config
from daybook.functions.numeric import null_if_nan, one_rep_max
from daybook.operators.fill import dense_fill
from daybook.operators.joins import full_outer_daily
from daybook.operators.settle import settle
from daybook.operators.shape import lower_names
from daybook.operators.stats import daily
from daybook.operators.windows import with_series_maxima
from daybook.session import shared_folder

UNKNOWN_EXERCISE = "Unknown"
MAXIMA = {"cummax_one_rep_max": None, "rolling_90d_max": 90}


def clean_sets(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    df = lower_names(log)
    day = F.substring("date", 1, 10).try_cast("date") if dict(df.dtypes)["date"] == "string" else F.to_date("date")
    return df.select(*keys, day.alias("date"), "exercise_name", "set_order", "weight", "reps")


def with_one_rep_max(sets: DataFrame, weight: DataFrame | None = None, keys: Sequence[str] = (),
                     unweighted: Sequence[str] = config.UNWEIGHTED_EXERCISES) -> DataFrame:
    """Sets with their day's body mass (joined in, or already there) and estimated maximum."""
    if weight is not None:
        sets = sets.join(weight, [*keys, "date"], "left")
    named = sets.fillna(UNKNOWN_EXERCISE, subset=["exercise_name"])
    cols = [F.col(c) for c in ("exercise_name", "weight", "reps", "body_mass")]
    return named.withColumn("one_rep_max", null_if_nan(one_rep_max(*cols, unweighted=unweighted)))


def strength_metrics(sets: DataFrame, weight: DataFrame | None = None, keys: Sequence[str] = (),
                     unweighted: Sequence[str] = config.UNWEIGHTED_EXERCISES,
                     maxima: Mapping[str, int | None] = MAXIMA, settle_in: str | None = None) -> DataFrame:
    """Sets with a positive estimate and their exercise's running and 90-day maximum.

    Maxima are taken before sets without a positive estimate are left out.
    """
    rated = with_one_rep_max(sets, weight, keys, unweighted)
    scored = with_series_maxima(rated, "one_rep_max", [*keys, "exercise_name"], maxima, settle_in=settle_in)
    return scored.where(F.col("one_rep_max") > 0).select(
        *keys, "date", "exercise_name", "reps", "one_rep_max", *maxima
    )


def daily_volume(strength: DataFrame, keys: Sequence[str] = (), value: str = "one_rep_max") -> DataFrame:
    """Summed estimate per day, 0 on days without sets, from first to last day."""
    return dense_fill(daily(strength, value, "sum", keys), value, keys)


def daily_volume_with_energy(strength: DataFrame, energy: DataFrame, keys: Sequence[str] = (),
                             measures: Sequence[str] = ("one_rep_max",), folder: str | None = None) -> DataFrame:
    """Daily sums of ``measures`` beside the energy rows; no energy counts as 0.

    The sums, a row per day, are settled, so the sets are read once.
    """
    volume = strength.groupBy(*keys, "date").agg(*[F.sum(null_if_nan(F.col(m))).alias(m) for m in measures])
    days = settle(volume, "daily-volume", folder or shared_folder(strength.sparkSession))
    return full_outer_daily(days, energy, [*keys, "date"], {"total_energy_burned": 0.0})
