"""Schemas of the inputs, and column orders of the results."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Attributes of the health export; every one arrives as text.
HEALTH_RECORD = _strings(
    "type", "sourceName", "sourceVersion", "device", "unit", "creationDate", "startDate",
    "endDate", "value",
)
HEALTH_WORKOUT = _strings(
    "workoutActivityType", "duration", "durationUnit", "totalDistance", "totalDistanceUnit",
    "totalEnergyBurned", "totalEnergyBurnedUnit", "sourceName", "sourceVersion", "device",
    "creationDate", "startDate", "endDate",
)

STRENGTH_LOG = StructType([
    StructField("Date", StringType()),
    StructField("Exercise Name", StringType()),
    StructField("Set Order", IntegerType()),
    StructField("Weight", DoubleType()),
    StructField("Reps", DoubleType()),
])

DIARY_MAIN = StructType([
    StructField("ID", IntegerType()),
    StructField("DATE (YYYY-MM-DD)", StringType()),
    StructField("NOTE", StringType()),
    StructField("elevated", DoubleType()),
    StructField("depressed", DoubleType()),
    StructField("anxiety", DoubleType()),
])
DIARY_SYMPTOM = StructType([StructField("ID", IntegerType()), StructField("NAME", StringType())])
DIARY_ENTRY = StructType([
    StructField("SYMPTOM", IntegerType()),
    StructField("ENTRY", IntegerType()),
    StructField("VALUE", DoubleType()),
])

WORKOUTS = StructType([
    StructField("type", StringType()),
    StructField("date", TimestampType()),
    StructField("duration", DoubleType()),
])
WEIGHT = StructType([StructField("date", DateType()), StructField("body_mass", DoubleType())])
STRENGTH = StructType([
    StructField("date", DateType()),
    StructField("exercise_name", StringType()),
    StructField("reps", DoubleType()),
    StructField("one_rep_max", DoubleType()),
    StructField("cummax_one_rep_max", DoubleType()),
    StructField("rolling_90d_max", DoubleType()),
])
SCORES = StructType([
    StructField("date", DateType()),
    StructField("note", StringType()),
    StructField("metric", StringType()),
    StructField("value", DoubleType()),
    StructField("value_partial", DoubleType()),
])
VOLUME = StructType([StructField("date", DateType()), StructField("one_rep_max", DoubleType())])
CLASSIFICATIONS = StructType([
    StructField("exercise_name", StringType()),
    StructField("muscle_groups", StringType()),
    StructField("match_score", IntegerType()),
    StructField("Muscle_Group", StringType()),
    StructField("Anterior_Posterior", StringType()),
    StructField("Push_Pull_Legs", StringType()),
])
