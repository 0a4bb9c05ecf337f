"""Labelling exercises: requests out, answers in, classes rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook import config
from daybook.operators.labels import batch_names, muscle_group_table, parse_answers, rollup_labels


def classification_requests(strength: DataFrame, template: str, size: int = config.NAMES_PER_REQUEST,
                            **values: Column) -> DataFrame:
    """Request texts for the distinct exercises; ``{names}`` and ``{groups}`` are filled in."""
    groups = {"groups": F.lit(", ".join(config.MUSCLE_GROUPS))}
    return batch_names(strength, "exercise_name", size, template, {**groups, **values})


def classify_exercises(answers: DataFrame, text: str = "content") -> DataFrame:
    """Answer texts to one row per exercise and muscle group, with the exercise's classes."""
    parsed = parse_answers(answers, text)
    return rollup_labels(parsed, muscle_group_table(answers.sparkSession))
