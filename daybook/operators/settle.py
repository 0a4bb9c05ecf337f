"""Small intermediate tables with a measured size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OPEN: dict[int, list[str]] = {}


def settle(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Write ``df`` once below a folder all executors can reach, and read it back.

    Its lineage ends there, which survives lost executors, and its size is that of its files:
    a join planned afterwards broadcasts it exactly if it is small, and then leaves the other
    side where it is instead of shuffling it.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for opened in _OPEN.values():
        opened.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_bucketed(df: DataFrame, name: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` once as a table bucketed and sorted by ``columns``, and read it back.

    Aggregations and joins by these columns, and by more, then leave its rows where they are, in every later job.
    Choose columns that no value of rules, a series and its day for instance, not the series alone.  The table is named
    ``name`` with a suffix of its own and lies in the session's warehouse, which all executors reach.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    # One file per bucket.
    df.repartition(buckets, *columns).write.bucketBy(buckets, *columns).sortBy(*columns).format("parquet").saveAsTable(table)
    return spark.table(table)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settled(spark: SparkSession) -> Iterator[list[str]]:
    """Removes what is settled inside the block at its end; results must be written or collected in it."""
    paths: list[str] = []
    _OPEN[id(paths)] = paths
    try:
        yield paths
    finally:
        del _OPEN[id(paths)]
        for path in paths:
            remove(spark, path)
