"""Health measurements and workouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daybook import config
from daybook.functions.dates import DateLike, date_parts, instant, wall_clock
from daybook.functions.numeric import kg_to_lb, pace, to_number
from daybook.functions.text import capture, strip_token
from daybook.operators.fill import date_spine_fill, forward_fill, interpolate
from daybook.operators.joins import Wanted, enrich_intervals
from daybook.operators.shape import lower_names
from daybook.operators.stats import daily


def clean_measurements(records: DataFrame, drop: Sequence[str] = config.RECORD_COLUMNS_DROPPED) -> DataFrame:
    """Typed measurements.  Date parts follow the clock the reading was taken by;
    ``enddate`` is the instant and ``endclock`` that clock's reading."""
    df = lower_names(records)
    clock = wall_clock(F.col("enddate"))
    typed = {
        "value": to_number(F.col("value")),
        "enddate": instant(F.col("enddate")),
        "type": strip_token(F.col("type"), config.RECORD_TYPE_PREFIX),
        "device": capture(F.col("device"), config.DEVICE_NAME_PATTERN),
    }
    kept = [typed[c].alias(c) if c in typed else F.col(c) for c in df.columns if c not in drop]
    return df.select(
        *kept, clock.alias("endclock"), *[part.alias(n) for n, part in date_parts(clock).items()]
    )


def measurement_spans(records: DataFrame, kinds: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, type, start, end, value) of some kinds of measurement, for interval enrichment."""
    df = lower_names(records)
    mine = df.where(F.col("type").isin([config.RECORD_TYPE_PREFIX + k for k in kinds]))
    return mine.select(
        *keys, strip_token(F.col("type"), config.RECORD_TYPE_PREFIX).alias("type"),
        instant(F.col("startdate")).alias("start"), instant(F.col("enddate")).alias("end"),
        to_number(F.col("value")).alias("value"),
    )


def clean_workouts(workouts: DataFrame) -> DataFrame:
    """Workouts with instants, number columns and bare type names."""
    df = lower_names(workouts)
    typed = {
        "startdate": instant(F.col("startdate")),
        "enddate": instant(F.col("enddate")),
        "duration": to_number(F.col("duration")),
    }
    for name in ("totaldistance", "totalenergyburned"):
        if name in df.columns:
            typed[name] = to_number(F.col(name))
    return df.select(
        strip_token(F.col("workoutactivitytype"), config.WORKOUT_TYPE_PREFIX).alias("type"),
        *[typed.get(c, F.col(c)).alias(c) for c in df.columns if c != "workoutactivitytype"],
        wall_clock(F.col("startdate")).alias("startclock"),
    )


def select_workouts(workouts: DataFrame, types: Sequence[str] = config.WORKOUT_TYPES,
                    keys: Sequence[str] = (), keep_clock: bool = False) -> DataFrame:
    """(keys, type, date, duration) of the wanted types.

    The raw type text is tested, so the test reaches the scan.
    """
    df = lower_names(workouts)
    raw = [config.WORKOUT_TYPE_PREFIX + t for t in types] + list(types)
    cleaned = clean_workouts(df.where(F.col("workoutactivitytype").isin(raw)))
    extra = [F.col("startclock").alias("clock")] if keep_clock else []
    return cleaned.select(*keys, "type", F.col("startdate").alias("date"), "duration", *extra)


def workout_energy(workouts: DataFrame, types: Sequence[str] = config.ENERGY_WORKOUT_TYPES,
                   keys: Sequence[str] = ()) -> DataFrame:
    """(keys, date, total_energy_burned), one row per workout; its day is that of its entry's clock.

    The raw type text is tested, so the test reaches the scan.
    """
    df = lower_names(workouts)
    raw = [config.WORKOUT_TYPE_PREFIX + t for t in types] + list(types)
    return df.where(F.col("workoutactivitytype").isin(raw)).select(
        *keys, F.to_date(wall_clock(F.col("creationdate"))).alias("date"),
        to_number(F.col("totalenergyburned")).alias("total_energy_burned"),
    )


def enrich_workouts(workouts: DataFrame, spans: DataFrame, wanted: Wanted = config.WORKOUT_MEASURES,
                    keys: Sequence[str] = (), start: str = "startdate", end: str = "enddate",
                    **options) -> DataFrame:
    """Workouts with heart rate, energy and distance of the time they took, and their pace.

    Pace uses the workout's own distance, not the measured one.
    """
    rows = enrich_intervals(workouts, spans, wanted, keys, start, end, **options)
    return rows.withColumn("pace", pace(F.col("duration"), F.col("totaldistance")))


def fill_metrics(df: DataFrame, as_of: DateLike, metric_set: str = "energy",
                 metrics: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Every day times every metric of a named set, or of the caller's own list."""
    names = config.METRIC_SETS[metric_set] if metrics is None else metrics
    return date_spine_fill(df, as_of, keys, metrics=names)


def daily_weight(measurements: DataFrame, as_of: DateLike, fill: str = "linear",
                 keys: Sequence[str] = (), order: Sequence[str | Column] = (),
                 kind: str = config.BODY_MASS_TYPE, by: str = "position") -> DataFrame:
    """Body mass in pounds, one row per day from the first reading to ``as_of``.

    ``order`` ranks readings of one day; give the reading's time where there is one.
    """
    mine = measurements.where(F.col("type") == kind)
    ranks = [F.col(c).alias(f"_order_{i}") if isinstance(c, str) else c.alias(f"_order_{i}")
             for i, c in enumerate(order)]
    readings = mine.select(*keys, "date", "value", *ranks)
    spine = date_spine_fill(readings, as_of, keys)
    by_order = [*[f"_order_{i}" for i in range(len(order))], "value"]
    if fill == "linear":
        filled = interpolate(spine, "value", keys, order=by_order, by=by, counted=readings)
    elif fill == "ffill":
        filled = forward_fill(spine, "value", keys, order=by_order, counted=readings)
    else:
        raise ValueError(f"unknown fill {fill!r}")
    return daily(filled.withColumn("body_mass", kg_to_lb(F.col("value"))), "body_mass", "min", keys)
