"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from daybook import config


def to_number(text: Column) -> Column:
    """Number in the text; NULL for anything unreadable and for NaN."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def null_if_nan(col: Column) -> Column:
    """The number, NULL for NaN: a missing value in every operator."""
    return F.when(~F.isnan(col), col)


def kg_to_lb(col: Column) -> Column:
    return col * F.lit(config.POUNDS_PER_KG)


def one_rep_max(
    name: Column,
    weight: Column,
    reps: Column,
    body_mass: Column,
    unweighted: Sequence[str] = config.UNWEIGHTED_EXERCISES,
) -> Column:
    """Epley estimate.  Unweighted exercises lift the body; barbells add the bar."""
    bar = F.when(name.contains(config.BARBELL_TAG), config.BARBELL_WEIGHT).otherwise(0.0)
    load = F.when(name.isin(*unweighted), body_mass).otherwise(weight + bar)
    return load * (1 + reps / 30)


def minutes_seconds(number: Column) -> Column:
    """7.5 (minutes) -> 7.3 (minutes.seconds); NULL in, NULL out."""
    whole = F.floor(number)
    return whole + (number - whole) * 0.6


def pace(duration: Column, distance: Column) -> Column:
    return F.when(distance == 0, F.lit(0.0)).otherwise(
        minutes_seconds(F.try_divide(duration, distance))
    )


def signed_parts(col: Column) -> tuple[Column, Column]:
    """(max(x, 0), min(x, 0)), NULL for NULL."""
    up = F.when(col > 0, col).when(col.isNotNull(), 0.0)
    down = F.when(col < 0, col).when(col.isNotNull(), 0.0)
    return up, down


def interaction(a: Column, b: Column, power: float = config.INTERACTION_POWER) -> Column:
    """0.5 * sqrt(a^p + b^p); a zero counts as missing."""
    pa, pb = (F.when(c != 0, F.pow(c, F.lit(power))) for c in (a, b))
    return 0.5 * F.sqrt(pa + pb)


def goal_fraction(done: Column, goal: Column, base: Column | None = None) -> Column:
    """done / goal, or (done - base) / (goal - base); NULL on a zero denominator."""
    if base is None:
        return F.try_divide(done, goal)
    return F.try_divide(done - base, goal - base)


def all_of(conditions: Sequence[Column]) -> Column:
    """True when every condition is; NULL counts as false, none at all as true."""
    return reduce(lambda a, b: a & b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(True))


def count_known(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, (c.isNotNull().cast("int") for c in cols), F.lit(0))
