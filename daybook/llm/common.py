"""Words, row text and written intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.operators.settle import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of digits, a-z and everything beyond ASCII, once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Runs without white space.
TOKEN = r"[^\x20\x09-\x0D]+"


def folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only in local mode, where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daybook-"))
    return spark.conf.get("spark.checkpoint.dir")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent.parent
    path = Path(tempfile.mkdtemp(prefix="daybook-")) / "daybook_code.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once, and its lineage ends."""
    return settle(df, name, folder(df.sparkSession))


def spread(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``df`` dealt by ``columns`` over as many tasks as shuffles have. Given a number, adaptive execution doesn't merge
    them, however few bytes the rows are that stand for much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def repeated(df: DataFrame, times: str, at_once: int = 100_000) -> DataFrame:
    """Each row as often as ``times`` says, without that column; a row is written in runs, so no long list is held."""
    runs = df.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({times} - 1) div {at_once}"))))
    left = F.least(F.lit(at_once).cast("long"), F.col(times) - F.col("_run") * at_once)
    return runs.withColumn("_one", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop(times, "_run", "_one")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else, as ``lower`` does for a text that is all ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text: Column, pattern: str = WORD) -> Column:
    """All words of the lower-cased text, in order."""
    return F.regexp_extract_all(lower_ascii(whole(text)), F.lit(pattern), F.lit(0))


def grams(column: str, width: int) -> Column:
    """Each run of ``width`` neighbouring words of the array column, joined by spaces; none where it is shorter."""
    rest = [F.lit(i) for i in range(1, width)]
    joined = lambda w, i: F.concat_ws(" ", w, *[F.get(F.col(column), i + k) for k in rest])
    return F.transform(F.slice(F.col(column), F.lit(1), F.greatest(F.size(column) - (width - 1), F.lit(0))), joined)
