"""Two-sided exponential average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook.functions.dates import day_number
from daybook.functions.numeric import null_if_nan

# Exponents inside a block stay below this, far from the limits of a double; a day's
# weight two blocks away is below e**-_REACH, which vanishes beside its own weight of 1.
_REACH = 300.0


def ewma_by_day(df: DataFrame, value: str, epsilon: float, keys: Sequence[str] = (),
                date: str = "date", out: str = "exp_moving_avg") -> DataFrame:
    """Per key and day d: sum x e^(-eps|t-d|) / sum e^(-eps|t-d|) over all rows, past and future.

    Rows are first reduced to (sum, count) per day.  Days are grouped in blocks; inside a
    block the two one-sided sums are scaled running sums, and a neighbouring block adds
    its total, so the cost is a sort of the days and not a pairing of them.  NaN counts as
    NULL.  Blocks further away are left out: their rows weigh less than e**-300 of a row of the
    day itself, which no double can show unless values differ by a factor beyond 1e100.
    """
    known = null_if_nan(F.col(value)).isNotNull()
    days = df.where(known).groupBy(*keys, date).agg(
        F.sum(value).alias("_x"), F.count("*").cast("double").alias("_n")
    )
    length = max(1, int(_REACH / epsilon)) if epsilon > 0 else None
    day = day_number(F.col(date))
    block = F.floor(day / F.lit(length)) if length else F.lit(0)
    start = block * length if length else day
    days = days.withColumn("_block", block.cast("bigint")).withColumn(
        "_u", (day - start).cast("double") * epsilon
    )
    span = (length or 0) * epsilon

    by_block = W.partitionBy(*keys).orderBy("_block")
    previous, following = by_block.rangeBetween(-1, -1), by_block.rangeBetween(1, 1)
    inside = W.partitionBy(*keys, "_block")
    upto = inside.orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    # Running from the far end keeps this a growing frame; a shrinking one costs n**2.
    after = inside.orderBy(F.desc(date)).rowsBetween(W.unboundedPreceding, -1)

    u = F.col("_u")
    grow, shrink = F.exp(u), F.exp(-u)

    def smoothed(c: str) -> Column:
        x = F.col(c)
        before = F.coalesce(F.sum(x * F.exp(u - span)).over(previous), F.lit(0.0))
        beyond = F.coalesce(F.sum(x * shrink).over(following), F.lit(0.0))
        left = F.sum(x * grow).over(upto) + before
        right = F.coalesce(F.sum(x * shrink).over(after), F.lit(0.0)) + beyond * F.exp(F.lit(-span))
        return left * shrink + right * grow

    top = smoothed("_x").alias("_top")
    bottom = smoothed("_n").alias("_bottom")
    return days.select(*keys, date, top, bottom).select(
        *keys, date, (F.col("_top") / F.col("_bottom")).alias(out)
    )


def with_ewma(df: DataFrame, value: str, epsilon: float, keys: Sequence[str] = (),
              date: str = "date", out: str = "exp_moving_avg") -> DataFrame:
    """Rows with the average at their date."""
    return df.join(ewma_by_day(df, value, epsilon, keys, date, out), [*keys, date], "left")
