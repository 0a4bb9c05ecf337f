"""The stages on small tables, and the queries against their SQL."""

import types

import pytest

import compare
import corpus_pipeline
from daybook.llm import queries
from test_words import contamination, fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, docs, texts, tmp_path_factory):
    """A folder with the awkward documents, labels, and a benchmark of which one document is full."""
    folder = str(tmp_path_factory.mktemp("tables"))
    labels = [(13, 1), *[(i, 0) for i in texts if i > 20]]
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    item = (1, " ".join((texts[22] or "").split()[:60]))
    spark.createDataFrame([item], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tables, texts):
    names, functions = zip(*corpus_pipeline.STAGES)
    assert names == ("toxicity", "exact dedup", "near dedup", "decontamination", "packing")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    after = {}
    for name, function in zip(names, functions):
        before, docs = docs, corpus_pipeline.written(function(spark, docs, tables), "stage")
        after[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    kept = {name: {r.doc_id for r in df.collect()} for name, df in after.items()}
    assert set(texts) - kept["toxicity"] <= {13} and None in kept["toxicity"]
    assert {6, 7}.isdisjoint(kept["exact dedup"]) and 8 in kept["exact dedup"] and after["exact dedup"].count() == len(kept["exact dedup"])
    assert {1, 2, 3} & kept["exact dedup"] == {3}
    prints = {i: fingerprint(texts[i]) for i in kept["exact dedup"] if i is not None}
    for i in prints.keys() - kept["near dedup"]:
        assert any((prints[i] ^ p).bit_count() <= 3 for j, p in prints.items() if j < i)
    item = spark.read.parquet(f"{tables}/benchmark.parquet").first()
    for i in kept["near dedup"] - {None}:
        n, hit, _ = contamination(texts[i], [tuple(item)])
        assert (i in kept["decontamination"]) == (hit == 0 or 20 * hit < n)
    assert kept["packing"] == kept["decontamination"]


def test_run(spark, tables):
    assert corpus_pipeline.run(spark, tables).select("doc_id").distinct().count() > 20


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_same_result_as_sql(spark, key, monkeypatch):
    monkeypatch.setattr(compare, "catalog", types.SimpleNamespace(queries=queries.queries, oracle_sql=queries.oracle_sql))
    assert compare.difference(spark, compare.connect(FOLDER), FOLDER, key) is None


def test_native_queries_run_no_python(spark):
    for key in ("op1_license_scan", "op2_exact_dedup"):
        plan = queries.queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
