"""Joins with a shape of their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook.functions.numeric import null_if_nan
from daybook.operators.order import micros
from daybook.operators.settle import settle
from daybook.session import shared_folder

# output column -> (kind of measurement, "avg" | "sum")
Wanted = Mapping[str, tuple[str, str]]


def classify(df: DataFrame, classes: DataFrame, series: str = "exercise_name",
             dedupe: Sequence[str] = ()) -> DataFrame:
    """Rows with their classification.

    ``classes`` may hold several rows per series, and a row then appears once per class
    row.  With ``dedupe`` only the distinct combinations of those columns count.
    """
    if dedupe:
        classes = classes.select(series, *dedupe).distinct()
    return df.join(classes, series, "left")


def classified_totals(df: DataFrame, classes: DataFrame, by: Sequence[str], sums: Sequence[str],
                      series: str = "exercise_name", dedupe: Sequence[str] = ()) -> DataFrame:
    """Per series and ``by`` the number ``n`` of classified rows and their ``sums``, a row counting once per class row.

    A series' rows all meet the same class rows, so they are added up before the join, which then
    holds a row per series and class row whatever the number of rows.
    """
    totals = df.groupBy(series).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])
    return classify(totals, classes, series, dedupe).groupBy(series, *by).agg(
        *[F.sum(c).alias(c) for c in ("n", *sums)])


def full_outer_daily(days: DataFrame, rows: DataFrame, on: Sequence[str], fill: Mapping[str, float]) -> DataFrame:
    """Full outer join of ``days`` (one row per ``on``) with ``rows``; NULLs of ``fill`` filled.

    Written as a left join from the many rows plus the days without any: a small ``days``
    can then be broadcast and the rows stay where they are, and a hot day can be split,
    neither of which Spark can do for a full outer join.
    """
    on = list(on)
    matched = rows.join(days, on, "left")
    alone = days.join(rows.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True).fillna(dict(fill))


# A cell of time is 2 ** _CELL microseconds, about a minute; a block of cells holds 2 ** _WIDE
# blocks of the next finer kind.  Inside a cell blocks hold 2 ** _FINE, down to microseconds.
_CELL, _WIDE, _FINE = 26, 2, 3
# Cells are counted from a time before all times.
_ZERO = 1 << 37
# An interval whose slots of time hold this many measurements each, or fewer, meets them one by one.
_FEW = 32
_GROUP = "struct<side: int, level: int, a: bigint, b: bigint, fine: int, block: bigint>"


def enrich_intervals(intervals: DataFrame, measurements: DataFrame, wanted: Wanted,
                     keys: Sequence[str] = (), start: str = "start", end: str = "end",
                     m_start: str = "start", m_end: str | None = "end", kind: str = "type",
                     value: str = "value", folder: str | None = None) -> DataFrame:
    """Average or sum of the measurements lying inside each interval; NULL where none do.

    A measurement lies inside when it starts at or after the interval's start and ends at or
    before its end; one that ends before it starts lies in none.  NaN counts as NULL.
    ``m_end=None`` declares instantaneous measurements.

    Time is cut into slots hardly longer than the interval, which then lies in two of them at most.
    Where both hold few measurements, the interval meets each of these; other intervals look up
    totals in a tree (``_by_tree``), so that nothing is paired where measurements are dense.
    Intervals of equal keys, start and end are looked up once, as are measurements of equal keys
    and times; both are settled below ``folder``, and whole rows meet the totals in a single join.
    """
    # Per kind: summed value (x), non-NULL values (n), rows (r).
    v = null_if_nan(F.col(value).cast("double"))
    kinds = list(dict.fromkeys(k for k, _ in wanted.values()))
    totals: dict[str, Column] = {}
    for i, k in enumerate(kinds):
        mine = F.col(kind) == k
        totals[f"_x_{i}"] = F.when(mine & v.isNotNull(), v).otherwise(0.0)
        totals[f"_n_{i}"] = (mine & v.isNotNull()).cast("bigint")
        totals[f"_r_{i}"] = mine.cast("bigint")
    sums = [F.sum(t).alias(t) for t in totals]
    stamps = [(m_start, m_end or m_start, measurements), (start, end, intervals)]
    times = [[micros(F.col(c), df.schema[c].dataType.typeName()) for c in (i, j)] for i, j, df in stamps]
    folder = folder or shared_folder(intervals.sparkSession)
    wide = settle(
        measurements.where(F.col(kind).isin(kinds))
        .groupBy(*keys, times[0][0].alias("_s"), times[0][1].alias("_e"))
        .agg(*[F.sum(c).alias(t) for t, c in totals.items()]).where("_s <= _e"), "interval-measurements", folder)
    of_interval = [*keys, start, end]
    spans = settle(intervals.select(*of_interval).distinct().select(
        "*", times[1][0].alias("_s"), times[1][1].alias("_e")).where("_s <= _e"), "intervals", folder)

    # Slots of 2 ** _b microseconds, more than the interval has.
    sized = spans.withColumn("_b", F.expr(f"cast({_CELL} + {_WIDE} * ((greatest(0, length(bin(_e - _s)) - {_CELL}) + {_WIDE - 1}) div {_WIDE}) as int)"))
    bits = [F.lit(r[0]) for r in sized.select("_b").distinct().collect()]
    slot = [*keys, "_b", "_slot"]
    pieces = sized.withColumn("_slot", F.explode(F.expr("sequence(shiftright(_s, _b), shiftright(_e, _b))")))
    near = wide.withColumn("_b", F.explode(F.array(*bits) if bits else F.array().cast("array<int>"))).withColumn("_slot", F.expr("shiftright(_s, _b)"))
    dense = settle(near.groupBy(*slot).agg(F.count("*").alias("_n")).where(F.col("_n") > _FEW).select(*slot), "dense-slots", folder)
    crowded = None
    if not dense.isEmpty():
        crowded = settle(pieces.join(dense, slot, "left_semi").select(*spans.columns).distinct(), "crowded-intervals", folder)
        pieces = pieces.join(crowded.select(*of_interval), of_interval, "left_anti")
        near = near.join(dense, slot, "left_anti")
    met = pieces.join(near.withColumnsRenamed({"_s": "_from", "_e": "_to"}), slot).where("_s <= _from and _to <= _e")
    found = met.groupBy(*of_interval).agg(*sums)
    if crowded is not None:
        found = found.unionByName(_by_tree(crowded, wide, keys, of_interval, list(totals)))
    out = []
    for name, (k, how) in wanted.items():
        x, n, r = (F.col(f"_{c}_{kinds.index(k)}") for c in "xnr")
        if how == "avg":
            out.append(F.when(n > 0, x / n).alias(name))
        else:
            out.append(F.when((r > 0) & (n == 0), F.lit(0.0)).when(n > 0, x).alias(name))
    return intervals.join(found, of_interval, "left").select(*[F.col(f"`{c}`") for c in intervals.columns], *out)


def _by_tree(spans: DataFrame, wide: DataFrame, keys: Sequence[str], of_interval: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Per interval of ``spans``, from ``_s`` to ``_e``, the sums of the ``totals`` of the rows of ``wide`` inside it.

    Time is cut into cells of about a minute, and these into a tree of aligned blocks.  A
    measurement belongs to the smallest block that holds it, nearly always a cell.  An interval
    adds up three things: the totals of the few blocks that make up the cells between its first
    and its last; of the blocks that hold only its start or only its end, the measurements that
    start no earlier or end no later, by running totals; and in the one block that holds both,
    the measurements between the same parts of it, which the times of their ends cut once more.
    Totals are only ever added, so a value outside an interval cannot touch it, and nothing is
    paired: a measurement in a cell becomes two rows, an hour some fifteen.  Only groups that
    some interval reads are sorted.
    """
    sums = [F.sum(t).alias(t) for t in totals]
    spans, wide = _placed(spans), _placed(wide)
    # Whole blocks between the first and the last cell.
    between = _pieces(spans.select(*of_interval, F.expr("_c0 + 1").alias("_s"), F.expr("_c1 - 1").alias("_e")).where("_s <= _e"), _WIDE)
    top = between.agg(F.coalesce(F.max("_level"), F.lit(-1))).scalar()
    own = wide.groupBy(*keys, "_l", "_node").agg(*sums).where(F.col("_l") <= top)
    risen = own.select("*", F.explode(F.sequence(F.col("_l"), top)).alias("_level")).withColumn(
        "_block", F.expr(f"shiftright(_node, cast({_WIDE} * (_level - _l) as int))"))
    blocks = risen.groupBy(*keys, "_level", "_block").agg(*sums)
    inside = between.join(blocks, [*keys, "_level", "_block"]).select(*of_interval, *totals)

    # Blocks that the interval's start or end lies in, up to the one that holds both.
    part = lambda side, level, a, b="0L", fine="0", block="0L": (
        f"cast(struct({side}, {level}, {a}, {b}, {fine}, {block}) as {_GROUP})")
    at = lambda group, place: f"struct({group} as g, {place} as at)"
    up = "if(_l > 0, sequence(0, _l - 1), cast(array() as array<int>))"
    middle = "if(_lo + 1 < _hi, sequence(_lo + 1, _hi - 1), cast(array() as array<bigint>))"
    edges = spans.select(*of_interval, F.explode(F.expr(f"""concat(
        transform({up}, l -> {at(part(1, "l", f"shiftright(_c0, {_WIDE} * l)"), "_s")}),
        transform({up}, l -> {at(part(2, "l", f"shiftright(_c1, {_WIDE} * l)"), "-_e")}),
        transform({middle}, i -> {at(part(3, "_l", "i"), "_s")}),
        transform({middle}, i -> {at(part(4, "_l", "i", "_hi"), "-_e")}))""")).alias("_r"))
    # Where both ends lie in the same parts of that block as the measurement's, the ends decide.
    same = ["_l", "_lo", "_hi"]
    last = f"if(_l = 0, _s, greatest(_s, shiftleft(_hi - shiftright({_ZERO}L, cast({_WIDE} * (_l - 1) as int)), cast({_CELL} + {_WIDE} * (_l - 1) as int))))"
    corners = _pieces(spans.select(*of_interval, *same, F.col("_s").alias("_at"), F.expr(last).alias("_s"), "_e").where("_s <= _e"), _FINE)
    corner = corners.select(*of_interval, F.expr(at(part(5, "_l", "_lo", "_hi", "_level", "_block"), "_at")).alias("_r"))
    reads = edges.unionByName(corner).select(*of_interval, "_r.g", "_r.at", F.lit(1).alias("_read"))
    points = wide.select(*keys, *totals, F.explode(F.expr(f"""concat(
        array({at(part(1, "_l", "_node"), "_s")}, {at(part(2, "_l", "_node"), "-_e")}),
        if(_l > 0, array({at(part(3, "_l", "_hi"), "_s")}, {at(part(4, "_l", "_lo", "_hi"), "-_e")}),
            cast(array() as array<struct<g: {_GROUP}, at: bigint>>)))""")).alias("_r"))
    fine = F.coalesce(corners.agg(F.max("_level")).scalar(), F.lit(0))
    met = wide.join(spans.select(*keys, *same).distinct(), [*keys, *same], "left_semi")
    ends = met.select("*", F.explode(F.sequence(F.lit(0), fine)).alias("_level")).withColumn(
        "_block", F.expr(f"shiftright(_e, {_FINE} * _level)"))
    ends = ends.select(*keys, *totals, F.expr(at(part(5, "_l", "_lo", "_hi", "_level", "_block"), "_s")).alias("_r"))
    used = points.unionByName(ends).select(*keys, *totals, "_r.g", "_r.at").join(
        reads.select(*keys, "g").distinct(), [*keys, "g"], "left_semi")
    zeros = [F.lit(0).cast("double" if t.startswith("_x") else "bigint").alias(t) for t in totals]
    line = used.withColumn("_read", F.lit(0)).unionByName(reads.select("*", *zeros), allowMissingColumns=True)
    later = W.partitionBy(*keys, "g").orderBy(F.desc("at"), "_read").rowsBetween(W.unboundedPreceding, 0)
    partly = line.select(*of_interval, "_read", *[F.sum(t).over(later).alias(t) for t in totals]).where("_read = 1")
    read = inside.unionByName(partly.drop("_read"))
    return read.groupBy(*of_interval).agg(*sums)


def _placed(times: DataFrame) -> DataFrame:
    """``times`` with the cells of ``_s`` and ``_e``, and the level, number and parts ``_lo``, ``_hi`` of the smallest
    block that holds both; of a cell the parts are the cell itself."""
    cells = times.withColumns({"_c0": F.expr(f"shiftright(_s, {_CELL}) + {_ZERO}L"), "_c1": F.expr(f"shiftright(_e, {_CELL}) + {_ZERO}L")})
    level = f"cast(if(_c0 = _c1, 0, (length(bin(_c0 ^ _c1)) + {_WIDE - 1}) div {_WIDE}) as int)"
    held = cells.withColumn("_l", F.expr(level)).withColumn("_node", F.expr(f"shiftright(_c0, {_WIDE} * _l)"))
    below = f"greatest(0, {_WIDE} * (_l - 1))"
    return held.withColumns({"_lo": F.expr(f"shiftright(_c0, {below})"), "_hi": F.expr(f"shiftright(_c1, {below})")})


def _pieces(ranges: DataFrame, bits: int) -> DataFrame:
    """(_level, _block) of the fewest aligned blocks that make up ``_s`` .. ``_e``, as rows."""
    levels = F.expr(f"sequence(0, cast((length(bin(_e - _s + 1)) - 1) div {bits} as int))")
    # Blocks of a level that lie inside: _first up to _stop; those of the next level: _first1 up to _stop1.
    inside = ranges.select("*", F.explode(levels).alias("_level")).selectExpr(
        "*",
        f"shiftright(_s + shiftleft(1L, {bits} * _level) - 1, {bits} * _level) as _first",
        f"shiftright(_e + 1, {bits} * _level) as _stop",
        f"shiftright(_s + shiftleft(1L, {bits} * (_level + 1)) - 1, {bits} * (_level + 1)) as _first1",
        f"shiftright(_e + 1, {bits} * (_level + 1)) as _stop1",
    ).where("_first < _stop")
    size = 1 << bits
    own = F.expr(f"""if(_first1 >= _stop1, sequence(_first, _stop - 1), concat(
        if(_first < _first1 * {size}, sequence(_first, _first1 * {size} - 1), cast(array() as array<bigint>)),
        if(_stop1 * {size} < _stop, sequence(_stop1 * {size}, _stop - 1), cast(array() as array<bigint>))))""")
    return inside.select("*", F.explode(own).alias("_block")).drop("_first", "_stop", "_first1", "_stop1")
