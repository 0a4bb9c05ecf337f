"""Extraction, toxicity, token counts, packing, language model, archives: against plain Python or held-out rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daybook.llm import extract, lengths, mixing, packing, tokens, toxicity, warc
from daybook.llm.labelled_pages import pages
from daybook.llm.queries import vocabulary


@pytest.fixture(scope="module")
def field():
    return extract.trained()


def test_field_on_held_out_pages():
    some = extract.labelled(pages())
    own = extract.fit(some[::2])
    right = [a == b for rows, labels in some[1::2] for a, b in zip(own.decode(rows), labels)]
    assert np.mean(right) > 0.93


def test_viterbi_finds_the_best_labels():
    import itertools

    rng = np.random.default_rng(1)
    own = extract.Field(rng.normal(size=extract.N_FEATURES), rng.normal(size=(2, 2)))
    rows = [list(rng.choice(extract.N_FEATURES, 4, replace=False)) for _ in range(7)]
    value = lambda ys: sum(own.weights[r].sum() for r, y in zip(rows, ys) if y) + sum(own.steps[a, b] for a, b in zip(ys, ys[1:]))
    assert [int(y) for y in own.decode(rows)] == list(max(itertools.product((0, 1), repeat=7), key=value))


def test_blocks():
    page = ("<p>a&amp;b\n <b>c</b><br>d&nbsp;e<p>f<script>var x = '</p>';</script><ul><li>1<li>2</ul><!-- no --><a href='x'>l</a>"
            "<style>p{}</style><div hidden>h</div><textarea>t</textarea><p>5 < 6<span class='x")
    assert [b.text for b in extract.leaf_blocks(page)] == ["a&b c d e", "f", "1", "2", "l", "5 < 6<span class='x"]
    for odd in ("", " ", "<", "<p", "</p></div>", "<script>x", "<!--", "<a <b>c", "&#x;&bogus;&#1114112;", "<p>" * 3000 + "x"):
        extract.leaf_blocks(odd)


def test_raw_elements_end_at_their_own_end_tag():
    for raw in ("<script>for(var i=0;i<n;i++){f(i)}</script>", "<title>a<b c</title>", "<script>var s='<!--';</script >", "<style>a<b{}</STYLE\n>",
                "<textarea>x<y</textarea>", "<script>'</scripts>';a<b</script>", "<script>if(a<b)x=\"</script>"):
        assert [b.text for b in extract.leaf_blocks(f"{raw}<p>Article</p>")] == ["Article"], raw
    assert extract.leaf_blocks("<script>a<b") == []


def test_hidden_is_an_attribute_not_a_value():
    for shown in ('title="The hidden cost"', "aria-label='what is hidden here'", 'class="post hidden box"', "class=hidden", 'title = "a hidden = b"',
                  "data-hidden", 'alt="x>hidden "'):
        assert [b.text for b in extract.leaf_blocks(f"<div {shown}>shown</div>")] == ["shown"], shown
    for hidden in ("hidden", "HIDDEN", 'hidden=""', 'class="a b" hidden', 'title="x"hidden', "id=x hidden = hidden"):
        assert extract.leaf_blocks(f"<div {hidden}>h</div>") == [], hidden


def test_end_tags_find_openers_at_any_depth():
    after = [extract.leaf_blocks(f"<nav hidden>{'<font>' * n}x</nav><p>y</p>") for n in (0, 199, 200, 5000)]
    assert [[(b.text, b.above) for b in blocks] for blocks in after] == [[("y", extract._TAG_BIT["p"])]] * 4


def test_extraction(spark, field):
    article = "<article><h1>T</h1><p>One, two and three.</p><p>Late.</p></article>"
    rows = [(1, "u", f"<nav><a href='/'>Home</a></nav><div class='ad'>Buy it now.</div>{article}<footer>&copy; x</footer>"),
            (2, None, None), (3, "", ""), (None, "u", "<footer>&copy; x</footer>")]
    got = extract.with_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), field=field)
    found = {r.page_id: (r.main_text, r.main_chars) for r in got.collect()}
    assert found[1][0] == "T\n\nOne, two and three.\n\nLate." and found[2] == found[3] == found[None] == ("", 0)
    assert extract.with_main_text(spark.createDataFrame([], "html string"), field=field).collect() == []


@pytest.fixture(scope="module")
def sayings():
    rng = random.Random(3)
    syllables = "ka lo mi ter son vel ra nu chi pol est an ur ig".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    insults = ("blockhead", "nitwit", "dunce")
    out = []
    for _ in range(600):
        text, toxic = [word() for _ in range(rng.randint(20, 60))], rng.random() < 0.4
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(insults)
        out.append((" ".join(text), int(toxic)))
    return out


def test_toxicity_on_held_out_texts(sayings):
    model = toxicity.train(sayings[:400])
    score = model.score([t for t, _ in sayings[400:]])
    assert np.mean((score >= 0.7) == np.array([y for _, y in sayings[400:]])) > 0.95
    plain, gapped, spaced, clean = model.score(["you nitwit dunce", "you n.i.t.w.i.t dun-ce", "you n i t w i t d u n c e", "kalo miter sonvel"])
    assert min(plain, gapped, spaced) > 0.5 > clean


def test_kernel_is_that_of_the_triples():
    """The table of weights scores words as the sum over landmarks does."""
    marks, beta = ["dunce", "kalo", "nitwit"], np.array([1.0, -0.5, 0.25])
    table = np.zeros(toxicity.LETTERS ** 3)
    codes, edges, _ = toxicity.letters(marks, join_singles=False)
    place, norm = np.repeat(np.arange(3), np.diff(edges)), toxicity._norms(np.diff(edges) + 1)
    for fits, number, w in toxicity.triples(codes, edges):
        at = np.flatnonzero(fits)
        np.add.at(table, number[fits], w * beta[place[at]] / norm[place[at]])
    words = ["duncé", "abc", "nit", "q"]
    margin, _ = toxicity.Model(table.astype(np.float32), 0.0, np.zeros(3)).margins([" ".join(words[:2]), " ".join(words[2:])])
    assert np.allclose(margin, toxicity._kernel(words, marks) @ beta, atol=1e-5)


def test_toxicity_columns(spark, docs, no_docs, texts):
    labels = spark.createDataFrame([(13, 1), (6, 0), (20, 0), (21, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, labels, score_col="s").collect()
    assert len(scored) == len(texts) + 2 and all(0 <= r.s <= 1 for r in scored)
    assert len({r.s for r in scored if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.with_toxicity(no_docs, labels, score_col="s").collect() == []
    one = toxicity.train([("only clean texts", 0)]).score(["anything", ""])
    assert one[0] == one[1] < 0.5


@pytest.fixture(scope="module")
def ids(texts):
    tokenizer = Tokenizer.from_file(vocabulary())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}


def test_encoder_is_the_tokenizer():
    own, rng = tokens.Encoder(vocabulary()), random.Random(2)
    signs = "ab'stTdLléÉñß .,;:!?#-_\"()123\n\t\r\x00\x1c\x85\xa0́KΣİ½²ªµ×÷<|>—“你好"
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    odd += ["a<|endoftext|>b", "I'LL don't", "word word", "x" * 100]
    want = [np.asarray(own._tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    assert own.encode(odd) == want and own.encode(odd) == want


def test_length_histogram(spark, docs, unique_docs, no_docs, ids):
    sizes = sorted(map(len, ids.values()))
    histogram = lengths.length_histogram(lengths.encoded_lengths(unique_docs, vocabulary()))
    rows = histogram.collect()
    assert {r.tokens: r.n_docs for r in rows} == Counter(sizes)
    for r in rows:
        assert r.docs_at_least == sum(n >= r.tokens for n in sizes) and r.docs_at_most == sum(n <= r.tokens for n in sizes)
        assert r.tokens_at_least == sum(n for n in sizes if n >= r.tokens) and r.truncated_total == sum(min(n, r.tokens) for n in sizes)
    limits = [1, 7, 512, 10**6]
    for r in lengths.truncated_totals(histogram, limits).collect():
        assert (r.documents_cut, r.total) == (sum(n > r.context for n in sizes), sum(min(n, r.context) for n in sizes))
    assert [r.tokens for r in lengths.quantiles(histogram, [0.5, 1.0]).collect()] == [sizes[math.ceil(len(sizes) / 2) - 1], sizes[-1]]
    assert lengths.length_histogram(lengths.encoded_lengths(docs, vocabulary())).agg({"n_docs": "sum"}).first()[0] == docs.count()
    assert lengths.length_histogram(lengths.encoded_lengths(no_docs, vocabulary())).collect() == []


def test_packing(spark, unique_docs, docs, no_docs, ids):
    window, packed = 128, packing.pack_documents(unique_docs, vocabulary(), 128, with_ids=True)
    rows = packed.collect()
    own, places = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        full, at = np.array([*x, 2], "<u4"), 0
        for r in sorted(own[i], key=lambda r: r.start):
            part = full[at:at + r.length].tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(full), zlib.crc32(part), part)
            at += r.length
        assert at == len(full)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert len(places) == len(best_fit(sorted((r.length for r in rows), reverse=True), window))
    for r in packing.sequences(packed, window).collect():
        n = r.n_tokens
        assert len(r.ids) == 4 * (n if n & (n - 1) == 0 else window)
    assert packing.pack_documents(docs, vocabulary()).count() >= docs.count()
    assert packing.pack_documents(no_docs, vocabulary()).collect() == []


def best_fit(sizes, window):
    left = []
    for n in sizes:
        fits = [i for i, c in enumerate(left) if c >= n]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= n
        else:
            left.append(window - n)
    return left


def test_language_model(spark, docs, unique_docs, texts, no_docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    words = {i: (t or "").translate({c: c + 32 for c in range(65, 91)}) for i, t in texts.items()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for i, t in words.items()}
    count = Counter(w for i, own in words.items() if not held(i) for w in own)
    total = sum(count.values())
    base = lambda w: math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1)))
    got = {r.doc_id: r for r in mixing.language_model_scores(unique_docs).collect()}
    assert len(got) == len(texts)
    for i, own in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(own), sum(count[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(map(base, own))) and r.score < 0
    assert mixing.language_model_scores(no_docs).collect() == []
    assert mixing.language_model_scores(docs).count() == len(texts) + 2


def test_scores_depend_on_word_order(spark):
    """A held-out text in the usual order scores above its shuffled words, and above the unigram model."""
    rng = random.Random(3)
    usual = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te") for b in ("ran", "vel", "dok", "pim")]
    rows = [(i, " ".join(w for _ in range(4) for w in usual[k:] + usual[:k])) for i in range(300) for k in [rng.randrange(20)]]
    mixed = [(i + 1000, " ".join(rng.sample(t.split(), 80))) for i, t in rows]
    held = [r for r in mixed if zlib.crc32(str(r[0]).encode()) % 10 == 0]
    got = mixing.language_model_scores(spark.createDataFrame(rows + held, "doc_id long, text string")).filter("held_out").collect()
    ordered, shuffled = [r for r in got if r.doc_id < 1000], [r for r in got if r.doc_id >= 1000]
    assert len(ordered) > 10 and len(shuffled) > 10
    assert min(r.score for r in ordered) > max(r.score for r in shuffled)
    assert all(r.score > r.base_score for r in ordered)


def _mixed_in_plain_python(code, learnt, contexts, runs, block):
    """What a mixer gives for runs of (symbols, contexts, own), learning from its own: exact contexts and single bits."""
    path = lambda s: [divmod(x, 2) for x in code.spread(np.array([s]))[1].tolist()]
    counts = [defaultdict(lambda: [0, 0]) for _ in range(3)]
    for i, s in enumerate(learnt):
        for node, bit in path(s):
            for k, c in enumerate([0, *contexts[i]]):
                counts[k][c, node][bit] += 1
    weights, curve = mixing.first_weights().astype(float), np.zeros((mixing._GATES * mixing._KNOTS, 2))
    out = []
    for symbols, given, own in runs:
        for begin in range(0, len(symbols), block):
            steps, met = [], []
            for i in range(begin, min(begin + block, len(symbols))):
                total = 0.0
                for node, bit in path(symbols[i]):
                    odds, seen = [], []
                    for k, c in enumerate([0, *given[i]]):
                        n = list(counts[k].get((c, node), (0, 0)))
                        n[bit] -= own
                        odds.append(math.log((n[1] + 0.4) / (n[0] + 0.4)))
                        seen.append(sum(n))
                    odds.append(0.3)
                    level = [sum(seen[k] >= x for x in (1, 2, 5)) for k in (1, 2)]
                    gate = level[0] * 3 + min(level[1], 2)
                    mixed = min(max(float(weights[:, gate] @ odds), -8.0), 8.0)
                    p, knot = 1 / (1 + math.exp(-mixed)), gate * mixing._KNOTS + round((mixed + 8) * 2)
                    q = (p + (curve[knot, 1] + 4 * mixing._MIDDLE[knot]) / (curve[knot].sum() + 4)) / 2
                    total += math.log10(q if bit else 1 - q)
                    steps.append((gate, (bit - p) * np.array(odds)))
                    met.append((knot, bit))
                out.append(total)
            if own:
                number = Counter(g for g, _ in steps)
                for gate, step in steps:
                    weights[:, gate] += 0.02 / math.sqrt(number[gate]) * step
                for knot, bit in met:
                    curve[knot, bit] += 1
    return out


def test_mixer_against_plain_python(monkeypatch):
    monkeypatch.setattr(mixing, "_BLOCK", 16)
    monkeypatch.setattr(mixing, "_LEAST_BITS", 22)  # no two contexts share a slot
    rng = random.Random(2)
    words = np.array([rng.choice([0, 0, 1, 2, 3, 4, -1]) if rng.random() < 0.5 else 5 for _ in range(150)])
    symbols = words + 1
    code = mixing.Code(np.bincount(symbols, minlength=8) + 1)
    give = lambda w: list(zip(*[c.tolist() for c in mixing.word_contexts(w)(0, len(w))]))
    new = np.array([5, 0, -1, 4, 6, 3])
    mixer = mixing.Mixer(code, symbols, mixing.word_contexts(words))
    found = [*mixer.run(symbols, mixing.word_contexts(words), True, True), *mixer.run(new + 1, mixing.word_contexts(new), False, False)]
    want = _mixed_in_plain_python(code, symbols.tolist(), give(words), [(symbols.tolist(), give(words), 1), ((new + 1).tolist(), give(new), 0)], 16)
    assert found == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_contexts_end_with_texts_and_words():
    first, second = mixing.word_contexts(np.array([4, 7, -1])), mixing.word_contexts(np.array([1, 2, 3, -1, 4, 7, -1]))
    assert [c.tolist() for c in first(0, 3)] == [c.tolist() for c in second(4, 7)]
    letters = lambda t: [c.tolist() for c in mixing.letter_contexts(np.frombuffer(t, np.uint8))(len(t) - 3, len(t))]
    assert letters(b"ab ") == letters(b"xyz ab ") != letters(b"xab ")


def test_code_and_mixer_are_proper():
    """Codes are as short as the best; a mixer's symbols add up to one in any context."""
    counts = np.array([50, 1, 7, 7, 2, 30, 1])
    code = mixing.Code(counts)
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        cost += heap[0] + heap[1]
        heap = sorted([heap[0] + heap[1], *heap[2:]])
    assert sum(0.5 ** n for n in code.size.tolist()) == 1 and int(code.size @ counts) == cost
    one = mixing.Code(np.array([3]))
    assert one.size.tolist() == [0] and len(one.spread(np.zeros(2, int))[1]) == 0
    rng = np.random.default_rng(1)
    words = rng.integers(-1, 6, 5000)
    mixer = mixing.Mixer(code, words + 1, mixing.word_contexts(words))
    mixer.run(words + 1, mixing.word_contexts(words), True, True)
    for a, b in ((0, 1), (5, -1), (3, 3)):
        given = [np.repeat(c[-1:], 7) for c in mixing.word_contexts(np.array([a, b, 0]))(0, 3)]
        assert (10 ** mixer.block(np.arange(7), given, False, False)).sum() == pytest.approx(1, abs=1e-4)


def test_crowded_slots_keep_their_ratio():
    keys = np.array([6] * 1000 + [7] * 10 + [2] * 3 + [9], np.uint32)
    table = mixing._table(keys, 10)
    assert [divmod(int(table[i]), 256) for i in (3, 1, 4)] == [(2, 255), (0, 3), (1, 0)]
    assert np.count_nonzero(table) == 3 and not mixing._table(np.empty(0, np.uint32), 10).any()


def test_counted_steps_are_hashed_once(monkeypatch):
    """The run over counted symbols takes their steps and slots from the counting; parts of a block change nothing."""
    monkeypatch.setattr(mixing, "_BLOCK", 64)
    words = np.random.default_rng(4).integers(-1, 6, 300)
    symbols, give, asked = words + 1, mixing.word_contexts(words), []
    mixer = mixing.Mixer(mixing.Code(np.bincount(symbols)), symbols, lambda a, b: asked.append((a, b)) or give(a, b))
    once = len(asked)
    want = np.concatenate([mixer.block(symbols[i:i + 64], give(i, min(i + 64, 300)), True, False) for i in range(0, 300, 64)])
    monkeypatch.setattr(mixing, "_STEPS", 48)
    found = mixer.run(symbols, lambda a, b: asked.append((a, b)) or give(a, b), True, False)
    assert found.tolist() == want.tolist() and len(asked) == once == 5


def test_words_come_in_runs_and_are_numbered_as_they_come(monkeypatch):
    monkeypatch.setattr(mixing, "_PIECE", 8)
    monkeypatch.setattr(mixing, "_KEEP", 12)
    texts = [None, "", " \t", "  A b\u00c0\x0b", "x" * 30, "a b c d e f g h i J k ", "\x1c y\x85z\n\na", "B"]
    want = [(t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split() for t in texts]
    flat = [w for own in want for w in own]
    for at in (0, 3):  # also of a slice
        shard = mixing.Shard()
        shard.add([*range(at, len(texts))], np.zeros(len(texts) - at, bool), pa.array(["q", *texts], pa.string()).slice(1 + at))
        shard.number()
        assert shard.words.to_pylist() == list(dict.fromkeys(flat)) and shard.sizes.tolist() == [len(w) for w in want[at:]]
        assert [shard.words[i].as_py() for i in shard.found.tolist()] == flat
        assert shard.bytes.tolist() == [len((t or "").encode()) for t in texts[at:]]


def test_shards_do_not_depend_on_tasks(spark, unique_docs):
    """Several shards; the same scores however the rows lie in partitions."""
    first = mixing.language_model_scores(unique_docs.repartition(1), shard_bytes=40_000).collect()
    second = mixing.language_model_scores(unique_docs.repartition(7), shard_bytes=40_000).collect()
    assert {r.doc_id: r.score for r in first} == pytest.approx({r.doc_id: r.score for r in second}, rel=1e-9)


def test_pages_without_ends_are_read_at_once():
    import time

    begin = time.perf_counter()
    for page in ("<a " * 700_000, '<p x="y ' * 200_000, "<!-- " * 300_000, "<p>text</p>" + "<a " * 300_000, "<p it's>" * 50_000):
        extract.leaf_blocks(page)
    assert time.perf_counter() - begin < 10
    assert [b.text for b in extract.leaf_blocks("<p>a</p>x <!-- y <p>z")] == ["a", "x"]
    assert [b.text for b in extract.leaf_blocks("<p>a</p>x <!-- y")] == ["a", "x"]
    assert [b.text for b in extract.leaf_blocks("<p>a</p><!--b--><p>c<p>d > e")] == ["a", "c", "d > e"]


def test_archives_with_ids_of_text(spark):
    ids = ["a\r\nWARC-Type: x", "<>", "", "%", "é 1", "12", None, "a+b%20"]
    page = spark.createDataFrame([(i, "u", "body", 1) for i in ids], "page_id string, url string, html string, payload_bytes int")
    got = warc.archived(page).collect()
    assert sorted(map(str, (r.page_id for r in got))) == sorted(map(str, ids))
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {""}


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    page = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 50) for i in range(300)], "page_id long, url string, html string")
    warc.write_archives(page, str(tmp_path / "w"))
    read = warc.read_archives(spark, str(tmp_path / "w"), 500).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in read) == 300 and len(read) > 1


def test_archives(spark, tmp_path):
    body = "<p>é</p>" * 40
    rows = [(5, "http://a/x y\r\n", body), (2, None, body), (9, "u", body), (7, "u", None), (3, "u", ""), (None, "u", "z"), (4, "u", "big" * 400_000), (2, None, body)]
    page = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = set()
    for i, _, h in rows:
        data = (h or "").encode()
        first = min((j for j, _, x in rows if (x or "").encode() == data and j is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.add((i, len(data), digest, *(("response", None) if i in (first, None) else ("revisit", first))))
    got = warc.archived(page).collect()
    assert len(got) == len(rows) and set(map(tuple, got)) == want
    assert all(r.record_type == "response" for r in warc.archived(page, least_bytes=10**9).collect())
    assert warc.archived(page.limit(0)).collect() == []
    warc.write_archives(page, str(tmp_path / "w"))
    for size in (37, 1000, 1 << 25):
        read = warc.read_archives(spark, str(tmp_path / "w"), size, with_payload=True).collect()
        assert len(read) == len(rows)
        assert sorted(bytes(r.payload) for r in read if r.payload is not None) == sorted(
            x.encode() for x in (body, body, "", "z", "big" * 400_000))


def test_only_whole_records_count():
    import io

    good = warc.gzip_member(warc.record(1, "u", hashlib.sha1(b"hello").digest(), 5, None, b"hello", "urn:", "d"), 6)
    other = warc.gzip_member(b"no record", 6)
    noise = b"\x1f\x8b\x08" + b"\x00" * 20 + b"\x1f\x8b"
    data = noise + good + other + noise + good + good[:40]
    assert [at for at, _ in warc.read_records(io.BytesIO(data), 0, len(data))] == [
        len(noise), len(noise) * 2 + len(good) + len(other)]
    assert [at for at, _ in warc.read_records(io.BytesIO(data), len(noise) + 1, len(data))] == [2 * len(noise) + len(good) + len(other)]
    assert warc.parse(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort") is None
    long = warc.gzip_member(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n" + random.Random(1).randbytes(17 << 20), 1)
    assert long[-1] == 0 and len([*warc.read_records(io.BytesIO(long), 0, len(long))]) == 1
