"""Daily spines and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook.functions.dates import DateLike, date_lit, day_number
from daybook.functions.numeric import null_if_nan
from daybook.operators.order import BOUND, ordered_parts
from daybook.operators.windows import repeat_rows

_ONE_DAY = "interval 1 day"


def _spine(bounds: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Every day from ``_from`` to ``_to``, per key."""
    return bounds.where(F.col("_from") <= F.col("_to")).select(
        *keys, F.explode(F.expr(f"sequence(_from, _to, {_ONE_DAY})")).alias(date)
    )


def _with_missing(rows: DataFrame, spine: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` plus a row of NULLs for each spine entry that has none.

    The left join from the spine, written so that only the distinct entries of ``rows`` are
    shuffled and not the rows.
    """
    missing = spine.join(rows.select(*on).distinct(), list(on), "left_anti")
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in on]
    return rows.select(*on, *rest).unionByName(missing, allowMissingColumns=True)


def date_spine_fill(df: DataFrame, as_of: DateLike, keys: Sequence[str] = (), date: str = "date",
                    metrics: Sequence[str] = (), metric: str = "metric") -> DataFrame:
    """All days from a key's first date to ``as_of`` (times ``metrics``), with the rows of ``df``.

    Rows dated after ``as_of`` or carrying another metric are not kept.
    """
    rows = df.where(F.col(date) <= date_lit(as_of))
    days = rows.select(*keys, date).distinct()
    spine = _spine(days.groupBy(*keys).agg(F.min(date).alias("_from"), date_lit(as_of).alias("_to")), keys, date)
    on = [*keys, date]
    if metrics:
        spine = spine.withColumn(metric, F.explode(F.array(*[F.lit(m) for m in metrics])))
        rows = rows.where(F.col(metric).isin(list(metrics)))
        on.append(metric)
    return _with_missing(rows, spine, on)


def dense_fill(df: DataFrame, value: str, keys: Sequence[str] = (), date: str = "date",
               fill: float = 0.0, out: str | None = None) -> DataFrame:
    """Every day between a key's first and last date; days without a value get ``fill``."""
    dated = df.where(F.col(date).isNotNull())
    rows = dated.withColumnRenamed(value, out) if out else dated
    days = rows.select(*keys, date).distinct()
    bounds = days.groupBy(*keys).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    return _with_missing(rows, _spine(bounds, keys, date), [*keys, date]).fillna(fill, subset=[out or value])


def fill_after_first_seen(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                          date: str = "date", fill: float = 1.0) -> DataFrame:
    """NULL -> ``fill`` strictly after the first date a column has a value; earlier NULLs stay.

    For tables with one row per key and date: a key's rows form one window.
    """
    of_key = W.partitionBy(*keys)

    def filled(name: str) -> Column:
        c = F.col(f"`{name}`")
        first = F.min(F.when(c.isNotNull(), F.col(date))).over(of_key)
        return F.when(c.isNull() & (F.col(date) > first), F.lit(fill)).otherwise(c).alias(name)

    return df.select(*[filled(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def coalesce_mean(df: DataFrame, target: str, a: str, b: str) -> DataFrame:
    """Fill ``target`` with the mean of two columns; NULL if either is."""
    return df.withColumn(target, F.coalesce(F.col(target), (F.col(a) + F.col(b)) / 2))


def _with_known_neighbours(df: DataFrame, value: str, keys: Sequence[str], date: str,
                           order: Sequence[str | Column], bound: int, folder: str | None,
                           counted: DataFrame | None) -> DataFrame:
    """Rows plus ``_pos`` and the nearest known ``(pos, day, v)`` at or before and after each.

    Positions and neighbours inside a part, then what other parts of the day carry in, and what
    other days do, each computed on one summary row per part or day.  Parts are days; a day of
    more than ``bound`` rows is cut along its order (``ordered_parts``), ties included, and rows
    that are identical are one row until the end.  No task sees more than one part's rows, one
    day's parts, or one key's days, at a time.  Rows that tie in ``order`` are ordered by a hash
    of the row, so every evaluation agrees.
    """
    named = {f"_order {i}": o for i, o in enumerate(order) if not isinstance(o, str)}
    df = df.withColumn(value, null_if_nan(F.col(value))).withColumns(named)
    by = [o if isinstance(o, str) else f"_order {i}" for i, o in enumerate(order)]
    names = [*keys, date]
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names and c not in named]
    ranks = [*[F.col(f"`{c}`") for c in by], F.xxhash64(*others)]
    cut = ordered_parts(df, names, by, bound, folder, counted)
    if cut is None:
        rows = df.select(F.struct(*names).alias("_part"), *others, F.lit(1).cast("bigint").alias("_times"))
    else:
        cut = cut.select(F.struct(*names, "_path").alias("_part"), *others)
        same = F.col("_part._path").endswith("=")
        equal = cut.where(same).groupBy("_part", *others).agg(F.count("*").alias("_times"))
        rows = cut.where(~same).withColumn("_times", F.lit(1).cast("bigint")).unionByName(equal)
    in_part = W.partitionBy("_part")
    if cut is None:
        rows = rows.withColumn("_i", F.row_number().over(in_part.orderBy(*ranks)).cast("bigint"))
    else:
        # Identical rows are a part of their own.
        rows = rows.withColumn("_i", F.when(F.col("_times") > 1, 1).otherwise(F.row_number().over(in_part.orderBy(*ranks))).cast("bigint"))
    known = F.col(value).isNotNull()
    number = day_number(F.col(f"_part.{date}")).alias("day")

    def point(pos: Column) -> Column:
        return F.when(known, F.struct(pos.alias("pos"), number, F.col(value).alias("v")))

    def shifted(col: str, by: str) -> Column:
        """The point with its position counted from further back."""
        c = F.col(col)
        return F.when(c.isNotNull(), F.struct((F.col(by) + c["pos"]).alias("pos"), c["day"], c["v"]))

    def carried(table: DataFrame, group: Sequence[str], by: str, tag: str) -> DataFrame:
        """``table`` with the rows before each entry of its group and the nearest points outside it, from the group's start."""
        earlier = W.partitionBy(*group).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        later = W.partitionBy(*group).orderBy(F.desc(by)).rowsBetween(W.unboundedPreceding, -1)
        return (
            table.withColumn(f"_{tag}", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
            .withColumn("_first", shifted("_first", f"_{tag}")).withColumn("_last", shifted("_last", f"_{tag}"))
            .withColumn(f"_{tag}_prev", F.last("_last", ignorenulls=True).over(earlier))
            .withColumn(f"_{tag}_next", F.last("_first", ignorenulls=True).over(later))
        )

    parts = rows.groupBy("_part").agg(
        F.sum("_times").alias("_n"), F.min(point(F.col("_i"))).alias("_first"),
        F.max(point(F.col("_i") + F.col("_times") - 1)).alias("_last")
    )
    in_key = ["_in_key", "_in_key_prev", "_in_key_next"]
    if cut is None:
        days = carried(parts.select("*", *[F.col(f"_part.{n}").alias(n) for n in names]), keys, date, "in_key")
        around = days.select("_part", F.col("_in_key").alias("_offset"), F.col("_in_key_prev").alias("_carry_prev"),
                             F.col("_in_key_next").alias("_carry_next"))
    else:
        parts = parts.select("*", F.struct(*[F.col(f"_part.{n}") for n in names]).alias("_day"), F.col("_part._path").alias("_nth"))
        in_day = carried(parts, ["_day"], "_nth", "in_day")
        days = in_day.groupBy("_day").agg(
            F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
        ).select("*", *[F.col(f"_day.{n}").alias(n) for n in names])
        around = in_day.join(carried(days, keys, date, "in_key").select("_day", *in_key), "_day").select(
            "_part", (F.col("_in_key") + F.col("_in_day")).alias("_offset"),
            F.coalesce(shifted("_in_day_prev", "_in_key"), "_in_key_prev").alias("_carry_prev"),
            F.coalesce(shifted("_in_day_next", "_in_key"), "_in_key_next").alias("_carry_next"))
    joined = rows.join(around, "_part", "left").withColumn("_pos", F.col("_offset") + F.col("_i"))
    up = in_part.orderBy("_i").rowsBetween(W.unboundedPreceding, 0)
    down = in_part.orderBy(F.desc("_i")).rowsBetween(W.unboundedPreceding, 0)
    here = point(F.col("_pos"))
    found = (
        joined.withColumn("_prev", F.coalesce(F.last(here, ignorenulls=True).over(up), "_carry_prev"))
        .withColumn("_next", F.coalesce(F.last(here, ignorenulls=True).over(down), "_carry_next"))
    )
    own = [*[F.col(f"_part.{n}").alias(n) for n in names], *kept, "_prev", "_next"]
    if cut is None:
        return found.select(*own, "_pos")
    many = found.where("_times > 1").select(*own, "_times", F.col("_pos").alias("_place"))
    apart = repeat_rows(many, "_times", F.col("_place"), "_pos").drop("_place")
    return found.where("_times = 1").select(*own, "_pos").unionByName(apart)


def forward_fill(df: DataFrame, value: str, keys: Sequence[str] = (), date: str = "date",
                 order: Sequence[str | Column] = (), out: str | None = None, bound: int = BOUND,
                 folder: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Last known value at or before each row.  ``order`` ranks the rows of one day, ascending,
    NULL first; days of more than ``bound`` rows are dealt over tasks.  ``counted`` may be a
    smaller table that has the same busy days."""
    rows = _with_known_neighbours(df, value, keys, date, order or [value], bound, folder, counted)
    return rows.withColumn(out or value, F.col("_prev.v")).drop("_prev", "_next", "_pos")


def interpolate(df: DataFrame, value: str, keys: Sequence[str] = (), date: str = "date",
                order: Sequence[str | Column] = (), by: str = "position",
                out: str | None = None, bound: int = BOUND, folder: str | None = None,
                counted: DataFrame | None = None) -> DataFrame:
    """Linear interpolation of NULLs between known values, by row position or by date.

    NULLs before the first known value stay; those after the last take its value.  ``order``,
    ``bound`` and ``counted`` are those of ``forward_fill``.
    """
    rows = _with_known_neighbours(df, value, keys, date, order or [value], bound, folder, counted)
    axis, here = {"position": ("pos", F.col("_pos")), "date": ("day", day_number(F.col(date)))}[by]
    prev, nxt = F.col("_prev"), F.col("_next")
    share = F.try_divide(here - prev[axis], nxt[axis] - prev[axis])
    between = prev["v"] + (nxt["v"] - prev["v"]) * F.coalesce(share, F.lit(0.0))
    filled = F.coalesce(F.col(value), between, prev["v"])
    return rows.withColumn(out or value, filled).drop("_prev", "_next", "_pos")
