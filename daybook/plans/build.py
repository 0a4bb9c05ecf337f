"""Everything from the exports to the result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.dates import DateLike
from daybook.operators.settle import settle
from daybook.plans.diary import diary_counters, diary_scores, diary_wide
from daybook.plans.measurements import clean_measurements, daily_weight, select_workouts
from daybook.plans.strength import clean_sets, daily_volume, strength_metrics
from daybook.session import shared_folder
from daybook.sources.bundles import load_diary_export, load_health_export
from daybook.sources.csvs import read_strength_log


@dataclass(frozen=True)
class Exports:
    """Where the three exports are.

    ``staging`` is a folder all executors can reach, by default the one the session names.
    ``person`` is a pattern whose first group finds the person in the path of an archive and of
    a strength log; the three paths may then match many people's files.
    """

    health: str
    strength_log: str
    diary: str
    staging: str | None = None
    note_rules: Sequence[tuple[str, float]] = ()
    person: str | None = None


def build_all(spark: SparkSession, exports: Exports, as_of: DateLike) -> dict[str, DataFrame]:
    """The six result tables, with the key ``person`` if there are many people.

    What several tables read (records, workouts, weight, sets, the diary) is written once, so
    an export is scanned once per kind of element.
    """
    stage = exports.staging or shared_folder(spark)
    many = exports.person is not None
    keys = ["person"] if many else []

    def of_person(df: DataFrame, path: str = "archive") -> DataFrame:
        if not many:
            return df
        found = F.regexp_extract(path, exports.person, 1)
        known = F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no person in "), F.col(path))).cast("string"))
        return df.withColumn("person", known).drop(path)

    raw = dict(zip(("Record", "Workout"), load_health_export(spark, exports.health, f"{stage}/health", by_archive=many)))
    health = {}
    for name, df in raw.items():
        health[name] = settle(of_person(df), name.lower(), stage)
        if health[name].isEmpty():
            raise ValueError(f"{exports.health} has no {name} element")
    diary = [of_person(d) for d in load_diary_export(spark, exports.diary, f"{stage}/diary", by_archive=many)]
    log = of_person(read_strength_log(spark, exports.strength_log, "_path" if many else None), "_path")

    measurements = clean_measurements(health["Record"])
    weight = settle(daily_weight(measurements, as_of, keys=keys, order=["enddate"]), "weight", stage)
    strength = settle(strength_metrics(clean_sets(log, keys), weight, keys, settle_in=stage), "strength", stage)
    wide = settle(diary_wide(*diary, as_of=as_of, keys=keys), "diary", stage)
    return {
        "non_weightlifting_exercise": select_workouts(health["Workout"], keys=keys),
        "weight": weight,
        "weightlifting": strength,
        "mental_health": diary_scores(wide, exports.note_rules, keys),
        "non_exercise_goal": diary_counters(wide, keys),
        "volume": daily_volume(strength, keys),
    }
