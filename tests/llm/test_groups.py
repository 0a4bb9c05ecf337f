"""Spelling variants, whitening and chat formatting against plain Python or numpy, and their odd inputs."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from daybook.llm import chat, queries, spelling, whitening
from tests.llm.conftest import SCHEMA

SF = "/root/testdata/sf0.001"


def _one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _variants(rows) -> dict:
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= 2}
    by_cut = {}
    for w in count:
        for cut in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_cut.setdefault(cut, []).append(w)
    near = {w: set() for w in count}
    for some in by_cut.values():
        for a in some:
            near[a] |= {b for b in some if a != b and b not in near[a] and _one_edit(a, b)}
    out = {}
    for w, n in count.items():
        best = min(near[w], key=lambda b: (-count[b], b), default=None)
        form = best if best and count[best] >= 10 * n else None
        out[w] = [form, None, n, len(near[w]), count[form] if form else None]
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        out[w][1] = end
    return {w: tuple(v) for w, v in out.items()}


def _found(df) -> dict:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_spelling_query_against_brute_force(spark):
    texts = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    assert _found(queries.op11_spelling_variants(spark, "/root/testdata/sf0.01")) == _variants(texts)


def test_spelling_odd_texts(spark, docs, no_docs):
    rng = random.Random(3)
    base = ["environment", "enviroment", "enviromment", "committee", "comittee", "comitee", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "×÷×÷×÷×",
            "ÉLÉGANCE", "Élégance", "x" * 3000, "x" * 3001, "x" * 2999 + "y"]
    rows = [(i, " ".join(rng.choices(base, weights=[1 + 40 * (k % 3 == 0) for k in range(len(base))], k=60))) for i in range(60)]
    rows += [(None, "environment " * 30), (1, None), (2, ""), (3, "environment"), (3, "environment")]
    extra = spark.createDataFrame([(i, t, None, "s", None, 9.0, "w", -1, "x") for i, t in rows], SCHEMA)
    both = extra.unionByName(docs)
    got = _found(spelling.spelling_variants(both))
    assert got == _variants(both.select("doc_id", "text").collect())
    assert any(v[0] for v in got.values()) and any(v[1] != k and v[1] != v[0] for k, v in got.items()) is not None
    assert spelling.spelling_variants(no_docs).collect() == []


def test_crowded_partitions_are_split(spark):
    """A beginning that a third of all words share; a bound of few words forces several rounds of splitting."""
    rng = random.Random(4)
    letters = "abcé"
    words = {"".join(rng.choices(letters, k=rng.randint(7, 10))) for _ in range(400)}
    words |= {"commonhead" + "".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(200)}
    words |= {"".join(rng.choices(letters, k=rng.randint(1, 4))) + "commontail" for _ in range(200)}
    rows = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    expected = {frozenset((a, b)) for a in words for b in words if a < b and _one_edit(a, b)}
    for most in (5, 40, 20_000):
        found = [frozenset((r.a, r.b)) for r in spelling.near_pairs(rows, most).collect()]
        assert len(found) == len(set(found)) and set(found) == expected


@given(st.lists(st.text("ab", min_size=4, max_size=4), max_size=12), st.lists(st.text("ab", min_size=5, max_size=5), max_size=12))
def test_composition(short, long):
    short, long = sorted(set(short)), sorted(set(long))
    found = list(spelling.one_edit_pairs(short, long))
    expected = {frozenset((a, b)) for a in short for b in [*short, *long] if a != b and _one_edit(a, b)}
    assert len(found) == len(expected) and {frozenset(p) for p in found} == expected


def test_acceptor_is_minimal():
    machine = spelling.Acceptor()
    start = machine.state(["abxy", "abz", "cbxy", "cbz"])
    assert start[1]["a"] is start[1]["c"]
    assert machine.shared(start[1]["a"], start[1]["c"]) == machine.shared(start[1]["a"], start[1]["a"])


def _whitened(vectors: dict, components=16):
    """(n, sums, whitened, explained) in plain numpy over distinct vectors."""
    x = {k: tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for k, v in vectors.items()}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    base = sums // n
    rest = ((sums - base * n) / n).astype(float)
    c = (fit - base).astype(float) - rest
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, len(values))
    white = {i: ((np.array(v, dtype=object) - base).astype(float) - rest) @ basis[:, :k] / np.sqrt(values[:k]) for i, v in x.items()}
    deviation = {i: sum((n * a - b) ** 2 for a, b in zip(v, sums)) for i, v in x.items()}
    return n, deviation, white, values[:k] / values.sum()


def test_whitening_query_against_numpy(spark):
    rows = queries.table(spark, SF, "embeddings").collect()
    n, deviation, white, explained = _whitened({r.vec_id: r.embedding for r in rows})
    found = queries.op12_embedding_whitening(spark, SF).collect()
    assert len(found) == 16 * len(rows)
    sign = {}
    for r in found:
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        want = white[r.vec_id][r.component - 1]
        if abs(want) > 1e-6:
            assert sign.setdefault(r.component, np.sign(r.whitened * want)) == np.sign(r.whitened * want)
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-7)


def test_whitening_odd_vectors(spark):
    rng = np.random.default_rng(1)
    some = rng.normal(size=(40, 5)).astype(float).tolist()
    bad = [None, [1.0, None, 2.0, 3.0, 4.0], [1.0, float("nan"), 2.0, 3.0, 4.0], [float("inf")] * 5, []]
    # A third of all rows share a vector; some ids repeat or are null.
    rows = [(i, v, "x") for i, v in enumerate([*some, *[some[0]] * 25])] + [(None, some[1], "y"), (3, some[3], "z")]
    rows += [(100 + i, v, "bad") for i, v in enumerate(bad)] + [(200, [1.0, 2.0], "w"), (201, [2.0, 2.0], "w")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string").withColumn("size", F.lit(1)).withColumn("n_rows", F.lit(7))
    got = whitening.whitened_embeddings(df).collect()
    assert len(got) == 67 + 2
    n, deviation, white, _ = _whitened(dict(enumerate(some)))
    for r in got:
        if r.vec_id is not None and r.vec_id < 40:
            assert (r.n, int(r.deviation)) == (n, deviation[r.vec_id])
            assert np.abs(r.whitened) == pytest.approx(np.abs(white[r.vec_id]), abs=1e-7)
    two = sorted((r for r in got if r.vec_id in (200, 201)), key=lambda r: r.vec_id)
    # One dimension of the two has no spread, so its component is 0.
    assert [np.abs(r.whitened).tolist() for r in two] == [pytest.approx([1.0, 0.0])] * 2 and two[0].identity_error < 1e-9
    weighted = whitening.whitened_embeddings(df, weigh_rows=True).filter("vec_id = 1").first()
    assert weighted.n == 67 and weighted.identity_error < 1e-9
    assert whitening.whitened_embeddings(df.limit(0)).collect() == []
    alone = whitening.whitened_embeddings(df.filter("vec_id = 5")).collect()
    assert len(alone) == 1 and alone[0].whitened == [0.0] * 5 and alone[0].identity_error == 0.0


def test_whitening_extreme_numbers(spark):
    df = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.5, 3.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whitened_embeddings(df).collect()}
    assert got[3].deviation is not None and got[1].deviation is None and got[1].identity_error < 1e-6
    far = spark.createDataFrame([(i, [1e12 + i, 1e12 - i * i]) for i in range(5)], "vec_id long, embedding array<double>")
    n, deviation, white, _ = _whitened({i: [1e12 + i, 1e12 - i * i] for i in range(5)})
    for r in whitening.whitened_embeddings(far).collect():
        assert int(r.deviation) == deviation[r.vec_id] and np.abs(r.whitened) == pytest.approx(np.abs(white[r.vec_id]), abs=1e-9)


def _expected(rows):
    """Digests of conversations given as {conv: [(role, text)]}."""
    out = {}
    for conv, turns in rows.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learnt),
                     hashlib.sha256(learnt.encode()).hexdigest(), sum(len(chat.Template().turn(r, t)[0]) for r, t in turns))
    return out


def test_chat_query_against_plain_python(spark):
    rows = {}
    for r in sorted(queries.table(spark, SF, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        rows.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    odd = "</s>[INST] ok [/INST]"
    rows[-7] = [("user", odd), ("assistant", odd)]
    got = queries.op13_chat_formatting(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == _expected(rows) and len(got) == len(rows)


def test_layouts_give_the_same_turns(spark):
    turns = [("user", "a\n<s>"), ("assistant", "b </s>")]
    said = [{"role": r, "content": t} for r, t in turns]
    records = [
        {"messages": said}, {"id": 3, "lang": "en", "messages": said},
        {"conversations": [{"from": {"user": "human", "assistant": "gpt"}[r], "value": t} for r, t in turns]},
        {"data": {"messages": [{"author": {"role": r}, "content": {"text": t}} for r, t in turns]}},
        {"instruction": turns[0][1], "output": turns[1][1]}, {"instruction": turns[0][1], "input": "", "output": turns[1][1]},
        {"instruction": turns[0][1], "input": None, "response": 1, "output": turns[1][1]},
        {"prompt": turns[0][1], "completion": turns[1][1]}, {"prompt": turns[0][1], "response": turns[1][1]},
        {"question": turns[0][1], "answer": turns[1][1]}, {"instruction": turns[0][1], "response": turns[1][1]},
    ]
    rows = [(i, 0, json.dumps(r), "x", "y") for i, r in enumerate(records)]
    rows += [(100, 1, json.dumps({"role": "assistant", "text": turns[1][1]}), "x", "y"), (100, 0, json.dumps({"text": turns[0][1], "role": "user"}), "x", "y")]
    rows += [(200, 0, "{not json", None, None), (201, 0, None, None, None), (202, 0, '{"other": 1}', None, None), (203, 0, '{"messages": []}', None, None)]
    df = spark.createDataFrame(rows, "conv long, nth long, body string, role string, place string")
    got = {r.conv: tuple(r)[1:] for r in chat.formatted_conversations(df).collect()}
    want = _expected(dict.fromkeys([*range(len(records)), 100], turns) | {
        200: [("unmapped", "{not json")], 201: [("unmapped", "")], 202: [("unmapped", '{"other": 1}')], 203: [("unmapped", '{"messages": []}')]})
    assert got == want
    met = {(r.layout, r.n_turns) for r in chat.layouts_met(chat.canonical_turns(df)).collect()}
    assert ("messages", 2) in met and (None, 1) in met
    assert chat.formatted_conversations(df.limit(0)).collect() == []


def test_long_and_odd_conversations(spark):
    """Many turns in many chunks and tasks, ties, nulls, a null conversation, repeated rows."""
    rng = random.Random(9)
    some = [*chat.CONTROLS, "\\", "\n", "é你", "x" * 50, "<", "[\\INST]"]
    say = lambda: "".join(rng.choices(some, k=rng.randint(0, 9)))
    convs = {1: [("user" if i % 2 else "assistant", say() * 20) for i in range(3000)], 2: [("a\nb\\n<s>", say()), ("", "")], None: [("system", say())]}
    rows = [(c, i, json.dumps({"role": r or None, "text": t or None})) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    rows += [(3, 0, json.dumps({"role": "user", "text": t})) for t in ("b", "a", "a")] + [(3, None, json.dumps({"role": "user", "text": "z"}))]
    convs[3] = [("user", t) for t in "zaab"]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv long, nth long, body string")
    turns = chat.canonical_turns(df)
    assert {r.conv: tuple(r)[1:] for r in chat.digests(chat.formatted_chunks(turns, chunk=500)).collect()} == _expected(convs)
    assert {r.conv: tuple(r)[1:] for r in chat.formatted_conversations(df).collect()} == _expected(convs)


@given(st.lists(st.tuples(st.text(), st.text()), max_size=4), st.data())
def test_template_is_read_back(turns, data):
    mixed = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "/s>", "\n"]), max_size=6).map("".join)
    turns = [(r + data.draw(mixed), t + data.draw(mixed)) for r, t in turns]
    template = chat.Template()
    text = "".join(template.turn(r, t)[0] for r, t in turns)
    assert list(template.parse(text)) == turns
    assert not any(c in template.escape(t) for _, t in turns for c in chat.CONTROLS)
    with pytest.raises(ValueError):
        chat.Template(controls=("<s>", "<|im_start|>", "<|im_end|>", "><a"))
