"""Exact duplicates by keyed state of a stream.

A streaming aggregation keeps one state row per digest of the normalised text and never expires it: the number of
rows seen, and the smallest (negative length, id, locator) among them, so it names the row that stays and where its
text can be read again. The state lives in RocksDB on the executors' disks and in the checkpoint, not in memory, and a
later run on the same checkpoint goes on from it. Texts whose digest was seen before, and no others, are compared byte
for byte: partial aggregation holds one text per digest and task, so a text that a third of all rows share costs no more
than any other, and texts that differ under one digest are grouped by themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from daybook.llm.common import folder, whole, written

STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Changes are written, not whole files, at each commit; all stores of an executor share one bounded cache.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # A store takes the disk that its rows need and leaves the executor when its task has committed.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # A state row is small; what a store holds before it goes to disk is, too.
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
}


def normalised(text: str | Column) -> Column:
    """The text without white space; empty where it is null."""
    return F.regexp_replace(whole(text), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def entries(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] = sha256,
            locator: Column | None = None) -> DataFrame:
    """What the state needs of each row, also of a stream's: digest, id, length in code points, locator. A row that ties
    with others in all of these is told from them by its place (``placed``)."""
    place = F.lit(None).cast("string") if locator is None else locator
    return docs.select(digest(normalised(text_col)).alias("digest"), F.col(id_col).alias("id"),
                       F.char_length(whole(text_col)).alias("length"), place.alias("locator"))


def placed(rows: DataFrame) -> DataFrame:
    """``rows``, read from files, a stream's too, with the place of each: file and row."""
    return rows.select("*", F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("place"))


def row_locator() -> Column:
    """Where a row of a Parquet table lies: file and row."""
    return F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")


def located(table: DataFrame, places: DataFrame, place_col: str = "keep_locator") -> DataFrame:
    """The rows of a Parquet ``table`` that lie at ``places`` (as ``row_locator`` names them), with the place."""
    return table.select(row_locator().alias(place_col), "*").join(places.select(place_col).distinct(), place_col)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_stream(stream: DataFrame, checkpoint: str) -> None:
    """Take all rows of ``stream`` (as ``entries`` makes them) that are there now into the state at ``checkpoint``."""
    place = F.col("place") if "place" in stream.columns else F.lit(None).cast("string")
    best = F.struct((-F.col("length")).alias("shorter"), F.col("id"), F.col("locator"), place.alias("place"))
    state = stream.groupBy("digest").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("seen"))
    with _settings(stream.sparkSession, STORE):
        query = (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, keep_id, keep_locator, keep_place, group_size): a row per state row at ``checkpoint``, written beside it."""
    with _settings(spark, STORE):
        state = spark.read.format("statestore").load(checkpoint)
        best, seen = [f.name for f in state.schema["value"].dataType.fields]
        value = F.col("value")
        return written(state.select(
            F.col("key.digest").alias("digest"), value[best]["id"].alias("keep_id"),
            value[best]["locator"].alias("keep_locator"), value[best]["place"].alias("keep_place"), value[seen].alias("group_size")), "exact-groups")


def clashing(docs: DataFrame, text_col: str, groups: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The digests of ``groups`` under which ``docs`` has texts of different bytes. Only hits, digests that were seen more
    than once, are compared; a digest of one row can't clash."""
    hits = groups.filter("group_size > 1").select("digest")
    text = docs.select(normalised(text_col).alias("_text")).select(digest(F.col("_text")).alias("digest"), "_text")
    both = text.join(hits, "digest", "left_semi").groupBy("digest").agg(F.min("_text").alias("least"), F.max("_text").alias("most"))
    return both.filter("least <> most").select("digest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256, locator: Column | None = None,
                     max_bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, keep_locator) for each row, dropped ones too.

    Texts are equal if they are without white space; null counts as empty. The row of the longest original text, then
    the smallest id, stays: one row of each group, also where rows repeat ids and texts. A null id is the smallest. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = f"{folder(spark)}/exact-{uuid.uuid4().hex}"
    rows = entries(docs, id_col, text_col, digest, locator)
    rows.write.parquet(f"{base}/entries")
    run_stream(placed(spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger))
                      .parquet(f"{base}/entries")), f"{base}/checkpoint")
    groups = read_state(spark, f"{base}/checkpoint")
    seen = placed(spark.read.schema(rows.schema).parquet(f"{base}/entries")).select("digest", "id", "place")
    clashing(docs, text_col, groups, digest).write.parquet(f"{base}/clashing")
    clash = spark.read.schema("digest string").parquet(f"{base}/clashing")
    clashes = not clash.isEmpty()
    found = (seen.join(clash, "digest", "left_anti") if clashes else seen).join(groups, "digest").select(
        "digest", "id", "keep_id", "keep_locator", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"))
    if clashes:
        found = found.unionByName(_by_text(docs, id_col, text_col, digest, locator, clash))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "digest", "keep_locator")


def _by_text(docs, id_col, text_col, digest, locator, clash) -> DataFrame:
    """The groups of rows whose digest does not tell texts apart."""
    own = docs.select(normalised(text_col).alias("_text"), F.col(id_col).alias("id"),
                      F.char_length(whole(text_col)).alias("length"),
                      (F.lit(None).cast("string") if locator is None else locator).alias("locator"))
    own = own.select("*", digest(F.col("_text")).alias("digest")).join(clash, "digest", "left_semi")
    # Rows that also tie in id and length are numbered among themselves.
    first = F.row_number().over(W.partitionBy("digest", "_text").orderBy(F.desc("length"), "id", "locator")) == 1
    best = F.struct((-F.col("length")).alias("shorter"), F.col("id"), F.col("locator"))
    groups = own.groupBy("digest", "_text").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return own.select("digest", "_text", "id", first.alias("kept")).join(groups, ["digest", "_text"]).select(
        "digest", "id", F.col("best.id").alias("keep_id"), F.col("best.locator").alias("keep_locator"), "group_size", "kept")
