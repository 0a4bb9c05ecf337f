"""From raw documents to packed token sequences: five stages, each on what the one before kept.

A stage takes (spark, docs, folder of the tables) and returns a table, which is written and read back as the next one's
``docs``. All but the last keep the columns of the documents, whatever they are called, and every document that they
have nothing against. Ids are unique but for rows that exact dedup drops; documents without an id are kept unless they
are toxic or a copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from daybook.llm import decontaminate, exact, packing, simhash, toxicity
from daybook.llm.common import written
from daybook.llm.queries import table, vocabulary

TOXIC_FROM = 0.7


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose id is in ``dropped``, a table of ids."""
    gone = dropped.toDF("_gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``."""
    scored = toxicity.with_toxicity(docs, table(spark, sf_dir, "labels"), score_col="_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest, then the smallest id: one row, also where rows repeat ids and texts. Rows are dropped
    by id and digest, so another text of the same id stays."""
    found = exact.exact_duplicates(docs)
    names = [F.col("doc_id").alias("_gone"), F.col("digest").alias("_same")]
    kept, gone = found.filter("kept").select(*names), found.filter("not kept").select(*names).distinct()
    keyed = docs.withColumn("_digest", exact.sha256(exact.normalised("text")))
    on = F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("_digest") == F.col("_same"))
    both = gone.alias("a").join(kept.alias("b"), F.expr("a._gone <=> b._gone AND a._same = b._same"), "left_semi")
    left = keyed.join(gone, on, "left_anti")
    if not both.isEmpty():
        # Ids that repeat a kept text: the longest of their rows.
        nth = F.row_number().over(W.partitionBy("doc_id", "_digest").orderBy(F.desc(F.char_length("text")), "text"))
        left = left.unionByName(keyed.join(both, on, "left_semi").withColumn("_nth", nth).filter("_nth = 1").drop("_nth"))
    return left.drop("_digest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents that of the smallest id."""
    found = simhash.near_duplicates(docs)
    return _without(docs, found.filter(F.col("doc_id") != F.col("component")).select("doc_id"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated").select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence."""
    return packing.pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]
#: Scores, fingerprints and tokens are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
