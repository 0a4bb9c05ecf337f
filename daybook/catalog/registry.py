"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The tables of one scale-factor folder."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def exercises(self) -> DataFrame:
        """part with an exercise name."""
        kind = F.when(F.col("p_type") == "LARGE", " (Barbell)").when(F.col("p_type") == "SMALL", " (Dumbbell)")
        return self.part.withColumn("exercise_name", F.concat("p_name", kind.otherwise("")))

    @property
    def sets(self) -> DataFrame:
        """Strength sets: line items of exercises."""
        parts = self.exercises.select("p_partkey", "exercise_name", "p_size")
        return self.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
            "exercise_name",
            F.to_date("l_shipdate").alias("date"),
            ((F.col("l_extendedprice") - 3000) / 100).alias("weight"),
            F.col("l_quantity").alias("reps"),
            (F.col("p_size") * 10.0).alias("body_mass"),
            F.col("l_linenumber").alias("set_order"),
        )

    @property
    def rated_sets(self) -> DataFrame:
        from daybook.plans.strength import with_one_rep_max

        return with_one_rep_max(self.sets, unweighted=UNWEIGHTED)

    @property
    def classes(self) -> DataFrame:
        """Several classes per exercise, unclear and missing ones among them."""
        size = F.col("p_size") % 5
        legs = F.when(size == 0, "push").when(size == 1, "pull").when(size == 2, "legs").when(
            size == 3, "Unclear")
        side = F.when(F.col("p_brand") < "Brand#2", "anterior").otherwise("posterior")
        return self.exercises.select(
            "exercise_name", F.col("p_brand").alias("Muscle_Group"),
            side.alias("Anterior_Posterior"), legs.alias("Push_Pull_Legs"),
        ).distinct()

    @property
    def readings(self) -> DataFrame:
        """Events as readings: errors have no value."""
        return self.events.select(
            "user_id", "event_id", F.to_date("ts").alias("date"), "event_type",
            F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        )

    @property
    def levels(self) -> DataFrame:
        """Events with a whole level 0..4 instead of their value."""
        return self.events.select(
            "user_id", "event_id", F.to_date("ts").alias("date"), "event_type",
            (F.floor("value") % 5).cast("double").alias("level"),
        )

    @property
    def user_days(self) -> DataFrame:
        """One row per user and day with a level per event type."""
        from daybook.operators.shape import pivot_first

        return pivot_first(self.levels, ["user_id", "date"], "event_type", "level", "event_id", EVENT_TYPES)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
UNWEIGHTED = ("small ring", "red widget", "blue bolt (Dumbbell)", "cold anvil")
# SQL spellings of the same stand-ins.
_NAME_SQL = (
    "p_name || CASE p_type WHEN 'LARGE' THEN ' (Barbell)' WHEN 'SMALL' THEN ' (Dumbbell)' ELSE '' END"
)
_UNWEIGHTED_SQL = ", ".join(f"'{n}'" for n in UNWEIGHTED)
CTES = {
    "exercises": f"SELECT *, {_NAME_SQL} AS exercise_name FROM part",
    "sets": """SELECT exercise_name, CAST(l_shipdate AS DATE) AS date, (l_extendedprice - 3000) / 100 AS weight,
        l_quantity AS reps, p_size * 10.0::DOUBLE AS body_mass, l_linenumber AS set_order
        FROM lineitem JOIN exercises ON l_partkey = p_partkey""",
    "rated": f"""SELECT *, (CASE WHEN exercise_name IN ({_UNWEIGHTED_SQL}) THEN body_mass
        ELSE weight + CASE WHEN contains(exercise_name, '(Barbell)') THEN 44 ELSE 0 END END) * (1 + reps / 30)
        AS one_rep_max FROM sets""",
    "classes": """SELECT DISTINCT exercise_name, p_brand AS Muscle_Group,
        CASE WHEN p_brand < 'Brand#2' THEN 'anterior' ELSE 'posterior' END AS Anterior_Posterior,
        CASE p_size % 5 WHEN 0 THEN 'push' WHEN 1 THEN 'pull' WHEN 2 THEN 'legs' WHEN 3 THEN 'Unclear' END
        AS Push_Pull_Legs FROM exercises""",
    "readings": """SELECT user_id, event_id, CAST(ts AS DATE) AS date, event_type,
        CASE WHEN event_type <> 'error' THEN value END AS value FROM events""",
    "levels": """SELECT user_id, event_id, CAST(ts AS DATE) AS date, event_type,
        CAST(CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) AS level FROM events""",
    "user_days": "SELECT user_id, date, " + ", ".join(
        f"arg_min(level, event_id) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES
    ) + " FROM levels GROUP BY user_id, date",
}
_NEEDS = {"sets": ["exercises"], "rated": ["exercises", "sets"], "classes": ["exercises"], "user_days": ["levels"]}


def with_ctes(sql: str) -> str:
    """Put the stand-ins an SQL text mentions in front of it."""
    import re

    used: list[str] = []
    for name in CTES:
        if re.search(rf"\b(FROM|JOIN) {name}\b", sql):
            used += [n for n in [*_NEEDS.get(name, []), name] if n not in used]
    used.sort(key=list(CTES).index)
    if not used:
        return sql
    head = ", ".join(f"{n} AS ({CTES[n]})" for n in used)
    own = re.match(r"\s*WITH\b", sql)
    return f"WITH {head}, {sql[own.end():]}" if own else f"WITH {head} {sql}"


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables``; ``sql`` states the same result for a SQL engine."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        _QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _ORACLES[key] = with_ctes(sql)
        return fn

    return register


def rounded(col: str | Column, digits: int = 6, name: str | None = None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits).alias(name or col)


def approx(col: str | Column, name: str | None = None) -> Column:
    """Float precision: for ratios, whose decimals may fall on a rounding edge."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("float").cast("double").alias(name or col)


def approx_sql(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
