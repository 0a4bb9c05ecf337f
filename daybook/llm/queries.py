"""The operators' queries over the shared tables, by name."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm import decontaminate, exact, extract, lengths, licenses, mixing, packing, simhash, toxicity, warc
from daybook.llm import chat, spelling, whitening


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = exact.exact_duplicates(docs, locator=exact.row_locator())
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = extract.with_main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.col("main_chars").alias("n_chars"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.with_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_histogram(lengths.encoded_lengths(table(spark, folder, "documents"), vocabulary()))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), F.col("component").alias("component_id"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), "contaminated")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary())


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.language_model_scores(table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.spelling_variants(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whitened_embeddings(table(spark, folder, "embeddings"))
    return found.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error",
                        F.posexplode("whitened").alias("_place", "whitened")).select(
        "vec_id", (F.col("_place") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", "_place").alias("explained"), "identity_error")


def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    rows = turns.select(F.col("conv_id").alias("conv"), F.col("turn").alias("nth"),
                        F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("body"))
    # A conversation whose texts are control strings, in another layout.
    text = "</s>[INST] ok [/INST]"
    body = json.dumps({"messages": [{"role": "user", "content": text}, {"role": "assistant", "content": text}]})
    odd = spark.createDataFrame([(-7, 0, body)], "conv long, nth long, body string")
    return chat.formatted_conversations(rows.unionByName(odd)).withColumnRenamed("conv", "conv_id")


_ALL = [op1_license_scan, op2_exact_dedup, op3_html_extraction, op4_toxicity, op5_token_counts, op6_simhash_near_dedup,
        op7_benchmark_decontamination, op8_packing, op9_lm_scoring, op10_warc, op11_spelling_variants,
        op12_embedding_whitening, op13_chat_formatting]
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_SQL: dict[str, str] = {
    "op7_benchmark_decontamination": f"""
        WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, array_to_string(w[p + 1:p + 13], ' ') AS g, least(len(w), 13) AS n
            FROM (SELECT *, unnest(range(greatest(len(w) - 12, 1))) AS p FROM b WHERE len(w) > 0)),
        d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        g AS (SELECT doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p
                FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        m AS (SELECT doc_id, item_id, p, n FROM g JOIN win USING (g, n)),
        h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
        i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM m GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op1_license_scan": licenses.license_sql(),
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
            row_number() OVER w = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
