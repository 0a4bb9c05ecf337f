"""License scan, exact and near duplicates, benchmark search: against plain Python."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from daybook.llm import decontaminate, exact, licenses, simhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(FOLD))


def test_license_scan(spark, docs, texts, no_docs):
    rows = licenses.license_scan(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(texts) + 1 and sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    # Rows whose text begins with a notice, repeated.
    odd = spark.createDataFrame([(1, "mit license"), (1, "under the mit license"), (1, "under the mit license"), (2, None), (2, None), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_words, r.n_base) for r in licenses.license_scan(odd).collect()) == [(1, 2, 0), (1, 4, 1), (1, 4, 1), (2, 0, 0), (2, 0, 0), (2, 0, 0)]
    for i, text in texts.items():
        w = words(text)
        places = [(p, label) for phrase, label in licenses.PHRASES for p in range(len(w)) if w[p:p + len(phrase.split())] == phrase.split()]
        row = got[i]
        assert (row.n_words, row.n_base) == (len(w), len(places))
        assert row.first_word == min((p for p, _ in places), default=None) and row.last_word == max((p for p, _ in places), default=None)
        assert row.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= row.score <= 1
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert got[14].labels == "mit" and got[15].n_base == 3 and got[16].labels == "gpl-3" and got[1].labels == ""
    spans = [(r.doc_id, r.label, r.start, r.stop) for r in licenses.license_notices(docs).collect()]
    assert (16, "gpl-3", 0, 13) in spans
    assert licenses.license_scan(no_docs).collect() == []


def test_exact_duplicates(spark, docs, texts, no_docs):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for digest in (exact.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1)):
        got = exact.exact_duplicates(docs, digest=digest).collect()
        assert len(got) == len(rows)
        by_id = {r.doc_id: r for r in got}
        for i, text in rows:
            same = [(-len(t or ""), j is not None, j or 0, j) for j, t in rows if bare(t) == bare(text)]
            assert (by_id[i].keep_id, by_id[i].group_size) == (min(same)[3], len(same)), i
        # One row of each group is kept, whatever repeats.
        kept = [r for r in got if r.kept]
        assert len(kept) == len({bare(t) for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)
        odd = exact.exact_duplicates(spark.createDataFrame([(1, "ab"), (1, "a b"), (2, "c"), (2, "c"), (None, "d"), (None, "d")], "doc_id long, text string"), digest=digest)
        assert sorted((str(r.doc_id), r.group_size, r.kept) for r in odd.collect()) == sorted(
            [("1", 2, True), ("1", 2, False), ("2", 2, True), ("2", 2, False), ("None", 2, True), ("None", 2, False)])
    assert by_id[4].digest == hashlib.sha256(b"word").hexdigest()[:1]
    assert exact.exact_duplicates(no_docs).collect() == []


def test_locators_lead_to_the_kept_texts(spark, docs, tmp_path):
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    found = exact.exact_duplicates(table, locator=exact.row_locator()).filter("kept and doc_id is not null")
    kept = {r.doc_id: r.keep_locator for r in found.collect()}
    rows = exact.located(table, found).collect()
    assert {r.doc_id: r.keep_locator for r in rows} == kept and len(rows) == len(kept)


def test_state_outlives_a_run(spark, docs, tmp_path):
    """The second run goes on from the first one's state, a file at a time."""
    rows = exact.entries(docs, "doc_id", "text")
    rows.filter("id <= 8").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    exact.run_stream(stream(), str(tmp_path / "state"))
    assert exact.read_state(spark, str(tmp_path / "state")).agg(F.sum("group_size")).first()[0] == 9
    rows.filter("id > 8").write.mode("append").parquet(str(tmp_path / "in"))
    exact.run_stream(stream(), str(tmp_path / "state"))
    state = exact.read_state(spark, str(tmp_path / "state"))
    whole = exact.exact_duplicates(docs.filter("doc_id is not null")).select("digest", "keep_id", "group_size").distinct()
    assert sorted(map(tuple, state.select("digest", "keep_id", "group_size").collect())) == sorted(map(tuple, whole.collect()))


def fingerprint(text):
    w = words(text, TOKEN)
    grams = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            low = min(label[b] for b in nodes if linked(a, b))
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_near_duplicates(spark, docs, unique_docs, texts, no_docs):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    label = reachable(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = simhash.near_duplicates(unique_docs).select("doc_id", simhash.as_hex("fingerprint").alias("f"), "component").collect()
    assert {r.doc_id: r.f for r in got} == {i: "%016x" % p for i, p in prints.items()}
    assert {r.doc_id: r.component for r in got} == label and label[2] == label[1] == label[3] == 1
    every = simhash.near_duplicates(docs).collect()
    assert [r.component for r in every if r.doc_id is None] == [21] and len(every) == len(texts) + 2
    assert simhash.near_duplicates(no_docs).collect() == []


def test_crowded_buckets(spark):
    """Hundreds of neighbouring fingerprints, whose buckets are dealt out again."""
    values = [(1 << a | 1 << b) - (1 << 64 if b == 63 else 0) for a in range(64) for b in range(a + 1, 64)]
    prints = spark.createDataFrame([(v,) for v in values] + [(-1,)], "fingerprint long")
    found = simhash.components(simhash.links(prints, 3)).collect()
    assert len({r.root for r in found}) == 1 and len({r.node for r in found} | {r.root for r in found}) == len(values)


def test_covering_masks():
    import itertools

    for bits in (list(range(64)), list(range(3, 40)), list(range(9))):
        masks = simhash.covering_masks(bits, 3)
        for three in itertools.combinations(bits, 3):
            assert any(not m & sum(1 << b for b in three) for m in masks)


def contamination(text, items, width=13):
    w, hit, met = words(text), set(), set()
    for item, t in items:
        own = words(t)
        for at in range(max(1, len(own) - width + 1)) if own else ():
            window = own[at:at + width]
            for p in range(len(w) - len(window) + 1):
                if w[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    met.add(item)
    return len(w), len(hit), sorted(met)


def test_contamination(spark, docs, unique_docs, texts, no_docs):
    long = texts[6].split()
    items = [(1, " ".join(long[40:70])), (2, "idiot idiot"), (3, None), (4, ""), (5, " ".join(long[60:73]).upper()), (6, "a b"), (7, "not there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(unique_docs, segment_words=2000)
    for block in (1 << 20, 20):
        found = decontaminate.search(index, bench, block_words=block).collect()
        assert len(found) == len(texts)
        for r in found:
            want = contamination(texts[r.id], items)
            assert (r.n_words, sum(s.stop - s.start for s in r.spans), sorted(r["items"])) == want, r.id
    near = decontaminate.search(index, spark.createDataFrame([(1, " ".join(long[10:14] + ["zzz"] + long[14:16]))], "item_id long, text string"), width=6)
    assert near.filter("size(items) > 0").count() == 0
    gap = [*long[100:103], *long[104:107]]
    bench = spark.createDataFrame([(1, " ".join(gap))], "item_id long, text string")
    assert {r.id for r in decontaminate.search(index, bench, width=6, slack=1).filter("size(items) > 0").collect()} >= {6, 7, 8}
    assert decontaminate.contamination(no_docs, bench).collect() == []
    assert decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0


def test_repeated_items_are_listed_once(spark, docs, texts):
    long = texts[6].split()
    items = [(1, " ".join(long[40:70])), (1, " ".join(long[40:70])), (1, " ".join(long[100:120])), (2, " ".join(long[60:73])), (None, " ".join(long[200:220]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs.filter("doc_id = 6").limit(1))
    for block in (1 << 20, 20):
        r = decontaminate.search(index, bench, block_words=block).first()
        assert sorted(r["items"]) == [1, 2] and [tuple(s) for s in r.spans][-1] == (200, 220)
