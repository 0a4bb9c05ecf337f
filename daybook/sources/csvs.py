"""CSV and Parquet tables in and out."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from daybook import schemas
from daybook.functions.numeric import null_if_nan
from daybook.operators.settle import remove


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType,
             multi_line: bool = False, ordinal: str | None = None,
             keep: Sequence[str] = (), file: str | None = None) -> DataFrame:
    """CSV with a header, matched to ``schema`` by name; other columns are not read.

    All files of a path have the same columns in the same order; one that differs is an error
    when it is read.  ``NaN`` is NULL.
    ``ordinal`` names an extra column that sorts the rows in file order; ``keep`` names
    columns to take from the folder names, ``file`` one for the file's path.
    """
    header = spark.read.option("header", True).option("multiLine", multi_line).option("enforceSchema", False)
    found = header.csv(path).columns
    wanted = {f.name: f for f in schema.fields}
    missing = [n for n in wanted if n not in found]
    if missing:
        raise ValueError(f"columns {missing} are not in {path}")
    full = StructType()
    for name in found:
        full = full.add(wanted[name] if name in wanted else name, None if name in wanted else "string")
    rows = header.schema(full).csv(path)
    numbers = {f.name for f in schema.fields if f.dataType.typeName() in ("double", "float")}
    out = [null_if_nan(F.col(f"`{n}`")).alias(n) if n in numbers else F.col(f"`{n}`") for n in (*wanted, *keep)]
    if file:
        out.append(F.col("_metadata.file_path").alias(file))
    if ordinal:
        # Ids grow along a file split, and splits are placed by where they start.
        out.append(F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ordinal))
    return rows.select(*out)


def read_strength_log(spark: SparkSession, path: str | Sequence[str], file: str | None = None) -> DataFrame:
    return read_csv(spark, path, schemas.STRENGTH_LOG, file=file)


def save_csv(df: DataFrame, name: str, folder: str = "./") -> str:
    """Write ``folder`` + ``name`` + ``.csv`` (a Spark output folder) with a header; returns it."""
    path = f"{folder}{name}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_all(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table; Parquet between jobs, CSV for other readers."""
    paths = {}
    for name, df in tables.items():
        if fmt == "csv":
            paths[name] = save_csv(df, name, folder.rstrip("/") + "/")
        else:
            paths[name] = f"{folder.rstrip('/')}/{name}"
            df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths


def publish_all(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """Write all tables to a new version below ``folder`` and switch readers to it at the end; returns the version.

    A version becomes visible by one small file, written when every table is complete; if a job dies before,
    readers go on with the version before it.  Old versions stay until ``drop_versions`` removes them.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    save_all(tables, f"{folder.rstrip('/')}/{version}", fmt)
    row = spark.createDataFrame([(version, fmt, sorted(tables))], _VERSION)
    row.coalesce(1).write.mode("append").json(f"{folder.rstrip('/')}/_versions")
    return version


_VERSION = "version string, format string, tables array<string>"


def _versions(spark: SparkSession, folder: str) -> list:
    """(version, format, tables) of all versions, the newest first; a row per run of ``publish_all``."""
    return sorted(spark.read.schema(_VERSION).json(f"{folder.rstrip('/')}/_versions").collect(), reverse=True)


def read_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version."""
    version, fmt, names = _versions(spark, folder)[0]
    base = f"{folder.rstrip('/')}/{version}"
    if fmt == "csv":
        return {n: spark.read.option("header", True).csv(f"{base}/{n}.csv") for n in names}
    return {n: spark.read.format(fmt).load(f"{base}/{n}") for n in names}


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove the tables of all but the newest ``keep`` versions, which no reader should still use; returns their names."""
    gone = [v[0] for v in _versions(spark, folder)[keep:]]
    for version in gone:
        remove(spark, f"{folder.rstrip('/')}/{version}")
    return gone
