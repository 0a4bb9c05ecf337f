"""Token totals for every context limit from an exact histogram of encoded lengths."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from daybook.llm.common import ship, written

#: Lengths that share a block; running sums go block by block, so no task holds all lengths.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens) of each row's whole text; null counts as empty."""

    ship(docs.sparkSession)

    def lengths(batches):
        from daybook.llm.tokens import encoder, in_slices

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(x) // 4 for _, part in in_slices(texts) for x in encoder(vocabulary).encode(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["id", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lengths, f"id {kind}, tokens long").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """A row per length that occurs.

    ``tokens``, ``n_docs``; ``docs_at_least``, ``tokens_at_least``: documents of that length or more and their tokens;
    ``docs_at_most``; ``truncated_total``: the tokens left if every document is cut at that length. Null lengths do not
    count. An empty table gives an empty histogram.
    """
    counts = written(lengths.filter(F.col(tokens_col).isNotNull()).groupBy(F.col(tokens_col).alias("tokens")).agg(
        F.count(F.lit(1)).alias("n_docs")), "length-counts").withColumn("block", F.floor(F.col("tokens") / BLOCK))
    sums = counts.groupBy("block").agg(F.sum("n_docs").alias("_d"), F.sum(F.col("tokens") * F.col("n_docs")).alias("_t"))
    # One row per block of lengths that occurs: the longest text's length / BLOCK rows at most.
    later, earlier = W.orderBy("block").rowsBetween(1, W.unboundedFollowing), W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = sums.select("block", zero(F.sum("_d").over(later)).alias("_d"), zero(F.sum("_t").over(later)).alias("_t"),
                       zero(F.sum("_d").over(earlier)).alias("_de"), zero(F.sum("_t").over(earlier)).alias("_te"))
    onward = W.partitionBy("block").orderBy("tokens").rowsBetween(0, W.unboundedFollowing)
    so_far = W.partitionBy("block").orderBy("tokens").rowsBetween(W.unboundedPreceding, 0)
    amount = F.col("tokens") * F.col("n_docs")
    return (
        counts.join(sums, "block")
        .select("tokens", "n_docs",
                (F.sum("n_docs").over(onward) + F.col("_d")).alias("docs_at_least"),
                (F.sum(amount).over(onward) + F.col("_t")).alias("tokens_at_least"),
                (F.sum("n_docs").over(so_far) + F.col("_de")).alias("docs_at_most"),
                (F.sum(amount).over(so_far) + F.col("_te")).alias("_tokens_at_most"))
        .withColumn("truncated_total", F.col("_tokens_at_most") - amount + F.col("tokens") * F.col("docs_at_least"))
        .drop("_tokens_at_most")
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, tokens): the smallest length that at least that share of the documents do not exceed."""
    total = histogram.agg(F.sum("n_docs").alias("_n"))
    at = [F.min(F.when(F.col("docs_at_most") >= F.lit(s) * F.col("_n"), F.col("tokens"))).alias(f"_{i}") for i, s in enumerate(shares)]
    one = histogram.withColumn("_n", total.scalar()).agg(*at)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(float(s)).alias("share"), F.col(f"_{i}").alias("tokens")) for i, s in enumerate(shares)
    ])).alias("_r")).select("_r.*")


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context, documents_cut, total): tokens left if every document is cut at each limit, from suffix sums alone."""
    def of(limit: int) -> DataFrame:
        above = F.col("tokens") >= limit
        first = lambda c: F.coalesce(F.min_by(c, F.when(above, F.col("tokens"))), F.lit(0))
        return histogram.agg(
            F.lit(limit).cast("long").alias("context"),
            F.coalesce(F.max(F.when(F.col("tokens") > limit, F.col("docs_at_least"))), F.lit(0)).alias("documents_cut"),
            (F.coalesce(F.max("tokens_at_least"), F.lit(0)) - first("tokens_at_least") + limit * first("docs_at_least")).alias("total"))

    return reduce(DataFrame.unionByName, map(of, limits))
