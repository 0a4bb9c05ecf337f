"""Places in a total order, in parts that one task can sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook.operators.settle import settle
from daybook.session import shared_folder

#: Rows that one task may sort.
BOUND = 1_000_000
_BINS = 255
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def micros(ts: Column, kind: str) -> Column:
    """Microseconds, increasing with ``ts`` in every session time zone."""
    if kind == "timestamp":
        return F.unix_micros(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    second = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000_000 + second


@dataclass(frozen=True)
class _Axis:
    """How one order column is cut: by letters, or by equal shares of its range as a number."""

    name: str
    number: Column | None

    @staticmethod
    def of(df: DataFrame, name: str) -> _Axis | None:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType.typeName().split("(")[0]
        if kind in _NUMBERS or kind == "boolean":
            return _Axis(name, c.cast("int").cast("double") if kind == "boolean" else c.cast("double"))
        if kind == "date":
            return _Axis(name, F.unix_date(c).cast("double"))
        if kind.startswith("timestamp"):
            return _Axis(name, micros(c, kind).cast("double"))
        return _Axis(name, None) if kind == "string" else None

    def stats(self) -> list[Column]:
        """What a part has to know of the column."""
        c, tag = F.col(f"`{self.name}`"), self.name
        out = [F.min(c).alias(f"_lo {tag}"), F.max(c).alias(f"_hi {tag}"), F.count_if(c.isNull()).alias(f"_nulls {tag}")]
        if self.number is not None:
            finite = F.when(F.abs(self.number) < float("inf"), self.number)
            out += [F.min(finite).alias(f"_from {tag}"), F.max(finite).alias(f"_to {tag}")]
        return out

    def varies(self) -> Column:
        same = F.col(f"`_lo {self.name}`").eqNullSafe(F.col(f"`_hi {self.name}`"))
        return ~same | ((F.col(f"`_nulls {self.name}`") > 0) & (F.col(f"`_nulls {self.name}`") < F.col("_n")))

    def code(self) -> Column:
        """A whole number that never falls as the column rises inside a part, and takes two values where it varies."""
        c, lo = F.col(f"`{self.name}`"), F.col(f"`_lo {self.name}`")
        if self.number is None:
            pairs = F.zip_with(F.split(lo, ""), F.split(F.col(f"`_hi {self.name}`"), ""), lambda a, b: a.eqNullSafe(b))
            shared = F.coalesce(F.array_position(pairs, False).cast("int"), F.lit(0)) - 1
            letter = F.substr(c, shared + 1, F.lit(1))
            return F.when(c.isNull(), 0).when(letter == "", 1).otherwise(F.ascii(letter) + 2)
        x, a, b = self.number, F.col(f"`_from {self.name}`"), F.col(f"`_to {self.name}`")
        # Halves, as the whole range of a double is no double.
        share = F.floor((x / 2 - a / 2) / (b / 2 - a / 2) * _BINS)
        near = F.when(b / 2 - a / 2 > 0, share).otherwise((c > lo).cast("long"))
        return (F.when(c.isNull(), 0).when(F.isnan(x), _BINS + 5).when(x == float("-inf"), 1)
                .when(x == float("inf"), _BINS + 4).otherwise(near + 2))


def ordered_parts(df: DataFrame, group: Sequence[str], order: Sequence[str], bound: int = BOUND,
                  folder: str | None = None, counted: DataFrame | None = None) -> DataFrame | None:
    """``df`` with ``_path``: by (``group``, ``_path``) rows are in the ascending order of ``order`` (NULL first, NaN
    last), rows that tie in all of it by a hash of the row. None if no group has more than ``bound`` rows.

    A part, the rows of one group and path, has ``bound`` rows at most; one whose rows are all identical may
    have more, and its path ends in ``=``.  Only parts that are too heavy are cut again: by the first order column that
    varies in them, each time into some 250 shares of their own range, or by the first letter in which they differ.
    Each round reads the rows once and settles one row per heavy part, of which there are rows / ``bound`` at most.
    Columns of other types than numbers, times and text end the cutting.  ``counted`` is a
    smaller table that tells as well whether a group is too heavy.
    """
    folder = folder or shared_folder(df.sparkSession)
    group_of = F.struct(F.lit(0).alias("_all"), *group).alias("_group")
    # Most tables have no heavy group at all, which a plain count tells.
    sizes = (df if counted is None else counted).groupBy(group_of).agg(F.count("*").alias("_n")).where(F.col("_n") > bound)
    if sizes.isEmpty():
        return None
    axes, order = [], list(dict.fromkeys(order))
    for name in order:
        axis = _Axis.of(df, name)
        if axis is None:
            break
        axes.append(axis)
    rows = df.select("*", group_of, F.lit("").alias("_path"))
    if len(axes) == len(order):
        rows = rows.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        axes.append(_Axis("_hash", F.col("_hash").cast("double")))
    stats = [F.count("*").alias("_n"), *[s for a in axes for s in a.stats()]]
    while True:
        open_ = rows.where(~F.col("_path").endswith("="))
        heavy = settle(open_.groupBy("_group", "_path").agg(*stats).where(F.col("_n") > bound), "heavy-parts", folder)
        if heavy.isEmpty():
            return rows.drop("_hash")
        code: Column | None = None
        for axis in axes:
            own = F.concat(F.lpad(axis.code().cast("string"), 7, "0"), F.lit("."))
            code = F.when(axis.varies(), own) if code is None else code.when(axis.varies(), own)
        code = F.lit("=") if code is None else code.otherwise("=")
        rest = [F.col(f"`{c}`") for c in rows.columns if c != "_path"]
        rows = rows.join(heavy, ["_group", "_path"], "left").select(
            *rest, F.when(F.col("_n").isNotNull(), F.concat("_path", code)).otherwise(F.col("_path")).alias("_path"))


def with_offsets(parts: DataFrame, size: str = "_n") -> DataFrame:
    """``parts``, a row per part, with ``_before``: the rows of the group's earlier parts."""
    earlier = W.partitionBy("_group").orderBy("_path").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumn("_before", F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def numbered(df: DataFrame, order: Sequence[str], out: str, keys: Sequence[str] = (), bound: int = BOUND,
             folder: str | None = None) -> DataFrame:
    """Rows numbered from 1 (long) by ascending ``order`` per key, NULL first, NaN last; ties by a hash of the row.

    No task sorts more than ``bound`` rows, identical ones excepted, which need no sorting.
    """
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    by = [*[F.col(f"`{c}`") for c in order], h]
    parts = ordered_parts(df, keys, order, bound, folder)
    if parts is None:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*by)).cast("bigint"))
    offsets = with_offsets(parts.groupBy("_group", "_path").agg(F.count("*").alias("_n"))).drop("_n")
    alone = parts.where(F.col("_path").endswith("="))
    sorted_ = parts.where(~F.col("_path").endswith("=")).withColumn(
        "_i", F.row_number().over(W.partitionBy("_group", "_path").orderBy(*by)).cast("bigint")).withColumn("_times", F.lit(1).cast("bigint"))
    equal = alone.groupBy(*[F.col(f"`{c}`") for c in parts.columns]).agg(F.count("*").alias("_times")).withColumn("_i", F.lit(1).cast("bigint"))
    placed = sorted_.unionByName(equal).join(offsets, ["_group", "_path"]).withColumn("_first", F.col("_before") + F.col("_i"))
    own = [F.col(f"`{c}`") for c in df.columns]
    single = placed.where("_times = 1").select(*own, F.col("_first").alias(out))
    from daybook.operators.windows import repeat_rows  # windows builds on this module

    many = placed.where("_times > 1").select(*own, "_times", "_first")
    return single.unionByName(repeat_rows(many, "_times", F.col("_first"), out).select(*own, out))


def exact_medians(df: DataFrame, value: str, group: Sequence[str], out: str = "median", bound: int = BOUND,
                  folder: str | None = None) -> DataFrame:
    """(group, median): the exact median of the values that are neither NULL nor NaN, NULL where there is none.

    In a group of more than ``bound`` values only the range that holds its middle is cut, each time into some 250 shares
    that are counted, until it holds ``bound`` values at most, which are sorted, or one value however often. A round reads
    the rows once and settles a row per such group; rows outside the ranges are left behind once they are three in four.
    """
    folder = folder or shared_folder(df.sparkSession)
    x = F.col(f"`{value}`").cast("double")
    # Minus and plus zero are one value.
    known = df.select(*group, F.when(~F.isnan(x), x + 0.0).alias("_v"))
    if known.groupBy(*group).agg(F.count("_v").alias("_n")).where(F.col("_n") > bound).isEmpty():
        return known.groupBy(*group).agg(F.median("_v").alias(out))
    known = known.select(F.struct(F.lit(0).alias("_all"), *group).alias("_group"), "_v")
    axis, low, high = _Axis("_v", F.col("_v")), F.col("`_lo _v`"), F.col("`_hi _v`")
    stats = [F.count("_v").alias("_n"), *axis.stats()]
    groups = settle(known.groupBy("_group").agg(*stats), "median-groups", folder)
    light = groups.where(F.col("_n").between(1, bound)).select("_group")
    medians = known.join(light, "_group", "left_semi").groupBy("_group").agg(F.median("_v").alias(out))
    rows = known.where(F.col("_v").isNotNull())
    # Ranks of the two middle values inside the range; ranges are whole groups at first.
    a, b = F.col("_a"), F.col("_b")
    open_ = groups.where(F.col("_n") > bound).withColumns({"_a": F.expr("(_n + 1) div 2"), "_b": F.expr("_n div 2 + 1")})
    held = None
    while True:
        # Of two middle values in different shares one is the last and the other the first.
        open_ = open_.withColumns({
            end: F.when(rank.isNotNull() & (low == high) | (rank == 1), low).when(rank == F.col("_n"), high)
            for end, rank in (("_x", a), ("_y", b))})
        is_open = F.col("_x").isNull() & a.isNotNull() | F.col("_y").isNull() & b.isNotNull()
        found = open_.where(~is_open).groupBy("_group").agg(((F.max("_x") + F.max("_y")) / 2).alias(out))
        left = open_.where(is_open)
        medians = medians.unionByName(found)
        few = left.where(F.col("_n") <= bound)
        ranked = _inside(rows, few).withColumn("_i", F.row_number().over(W.partitionBy("_group").orderBy("_v")))
        sorted_ = ranked.where((F.col("_i") == a) | (F.col("_i") == b)).groupBy("_group").agg(((F.min("_v") + F.max("_v")) / 2).alias(out))
        many = left.where(F.col("_n") > bound)
        numbers = left.agg(F.count("*"), F.sum("_n"), F.count_if(F.col("_n") > bound)).first()
        if numbers[0] > numbers[2]:
            medians = medians.unionByName(settle(sorted_, "medians", folder))
        if not numbers[2]:
            break
        if held is not None and numbers[1] * 4 < held:
            rows, held = settle(_inside(rows, many).select("_group", "_v"), "median-rows", folder), numbers[1]
        held = numbers[1] if held is None else held
        bins = _inside(rows, many).groupBy("_group", "_a", "_b", axis.code().alias("_bin")).agg(*stats)
        earlier = W.partitionBy("_group").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
        before = F.col("_before")
        placed = bins.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumns({
            r: F.when((before < F.col(r)) & (F.col(r) <= before + F.col("_n")), F.col(r) - before) for r in ("_a", "_b")})
        open_ = settle(placed.where(a.isNotNull() | b.isNotNull()).drop("_bin", "_before"), "median-ranges", folder)
    own = [F.col("_group").getField(c).alias(c) for c in group]
    return groups.select("_group").join(medians, "_group", "left").select(*own, out)


def _inside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows that lie in the range of their group, with what is known of it."""
    return rows.join(ranges, "_group").where(F.col("_v").between(F.col("`_lo _v`"), F.col("`_hi _v`")))
