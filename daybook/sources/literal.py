"""Small tables held in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A local relation: its size is known to the optimizer, which broadcasts it by itself."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table({n: list(c) for n, c in zip(names, columns)}))
