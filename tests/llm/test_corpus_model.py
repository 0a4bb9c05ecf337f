"""The language model's contexts are counted in the whole corpus: events, their buckets, and copies that lie apart."""

import random
import statistics
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("daybook.llm")
from daybook.llm import mixing


def _is_held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def test_copies_inform_each_other_wherever_they_lie(spark):
    """Texts that occur twice among those to learn from are far easier than others, however many buckets there are."""
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("r", "st", "nd", "lo")]
    ids = [i for i in range(400) if not _is_held(i)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(200)]
    rows = list(zip(ids, texts + texts[:40]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.bits_per_byte for r in mixing.language_model_scores(docs, shard_bytes=5_000).collect()}
    twice, once = [got[i] for i in ids[:40]], [got[i] for i in ids[40:200]]
    assert max(twice) < min(once) and statistics.median(twice) < 0.7 * statistics.median(once)
    assert got[ids[0]] == got[ids[200]]


def test_held_out_texts_meet_contexts_of_all_texts(spark):
    """A held-out text whose lines come one from each of many texts scores as its lines do, not as new ones."""
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "te", "po") for b in ("ran", "vel", "dok", "pim", "sor", "tul")]
    ids, held = [i for i in range(1500) if not _is_held(i)], [i for i in range(1500) if _is_held(i)]
    lines = [" ".join(rng.choices(words, k=12)) for _ in range(200)]
    texts = ["\n".join(rng.sample(lines, 4)) for _ in range(300)]
    known = [(i, "\n".join(rng.sample(lines, 4))) for i in held[:20]]
    new = [(i, "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(4))) for i in held[20:40]]
    docs = spark.createDataFrame([*zip(ids, texts), *known, *new], "doc_id long, text string")
    got = {r.doc_id: r.bits_per_byte for r in mixing.language_model_scores(docs, shard_bytes=4_000).collect()}
    assert max(got[i] for i, _ in known) < 0.8 * min(got[i] for i, _ in new)


def test_mixer_counts_as_often_as_told():
    """Events given once with their number give the tables of the same events given one by one."""
    rng = np.random.default_rng(3)
    words = rng.integers(0, 5, (60, 3))
    times = np.where(rng.random(60) < 0.2, 700, rng.integers(1, 4, 60))
    contexts = lambda w: lambda a, b: [mixing._mixed(w[a:b, 1]), mixing._mixed(w[a:b, 1], w[a:b, 2])]
    every = np.repeat(words, times, axis=0)
    code = mixing.Code(np.bincount(every[:, 0], minlength=5) + 1)
    one = mixing.Mixer(code, words[:, 0], contexts(words), times)
    many = mixing.Mixer(code, every[:, 0], contexts(every))
    for k in range(2):
        many.tables[k] = mixing._table(many._keys[k] >> np.uint32(many.bits[k] - one.bits[k]) & ~np.uint32(1) | many._keys[k] & np.uint32(1), one.bits[k])
        assert one.tables[k].any() and (one.tables[k] == many.tables[k]).all()
    assert np.allclose(one._whole, many._whole) and np.allclose(one._less, many._less)
    one.run(words[:, 0], contexts(words), True, True)
    given = [c[:1].repeat(5) for c in contexts(words)(0, 1)]
    assert (10 ** one.block(np.arange(5), given, False, False)).sum() == pytest.approx(1, abs=1e-4)


def test_numbers_come_back_from_few_bytes():
    for x in ([], [0], [1, 255, 256], [2**24, 5], [2**40, 0, 7]):
        assert mixing.unpack(mixing.pack(np.array(x, np.int64))).tolist() == x
    for x in ([], [0.0], [-1.5, 2e-30, 0.0]):
        assert mixing.unpack(mixing.pack(np.array(x, np.float32)), np.float32).tolist() == np.array(x, np.float32).tolist()


def test_events_are_dealt_whole():
    """Against plain Python: how often each event occurs, where it is, and which contexts a bucket holds whole."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["the", "of", "a", *"bcdefghij"], [30, 9, 9, *[1] * 9], k=rng.randrange(9))) for _ in range(60)]
    held = np.array([rng.random() < 0.3 for _ in texts])
    shard = mixing.Shard()
    shard.add([*range(60)], held, pa.array(texts))
    rows = mixing.part_rows(shard, 7, 4)
    assert rows[0][3] == sum(len(t.split()) + 1 for t, h in zip(texts, held) if not h) and rows[0][8] == [*range(60)]
    number, back = {}, []
    for place, _, part, _, *data, _, _ in rows[1:]:
        words = mixing._words_of(*data[:2]).to_pylist()
        assert part == 7 and words and not number.keys() & set(words)
        number |= {w: 1 + len(number) + k for k, w in enumerate(words)}
        count = mixing.unpack(data[2]).tolist()
        assert count == [sum(t.split().count(w.decode()) for t, h in zip(texts, held) if not h) for w in words]
        back.append((7, 1, place, 0, mixing.pack(np.array([number[w] for w in words])), mixing.pack(np.array(count)),
                     mixing.pack(np.zeros(len(words), np.float32)), None))
    part = mixing.Part([*back[::-1], rows[0][:8]], int((~held).sum()))
    want = Counter()
    order = []
    for t, h in zip(texts, held.tolist()):
        seen = [0, 0]
        for w in [*(number[w.encode()] for w in t.split()), 0]:
            order.append((h, seen[-1], seen[-2], w))
            seen.append(w)
    want.update(order)
    events = part.events(20, 5)
    place, got, buckets, firsts = 0, [], defaultdict(set), defaultdict(set)
    for bucket, _, source, learnt, *data in events.rows(7):
        for i, (a, b, w, n) in enumerate(zip(*(mixing.unpack(x).tolist() for x in data))):
            got.append((i >= learnt, a, b, w))
            assert source == 7 and want[got[-1]] == n
            buckets[a, b].add(bucket)
            firsts[a].add(bucket)
    assert len(got) == len(set(got)) == len(want) and [got[i] for i in events.inverse.tolist()] == order
    assert all(len(x) == 1 for x in buckets.values()) and len(firsts[number[b"the"]]) > 1
    assert all(len(firsts[a]) == 1 for w, a in number.items() if sum(t.split().count(w.decode()) for t in texts) <= 20)


def test_words_lie_at_places_of_their_own():
    words = pa.array([b"a", b"b", b"abc", b"\xc3\x84", b"abc", b"x" * 3000], pa.binary())
    places = mixing.word_places(words, 1000).tolist()
    assert places[2] == places[4] and len(set(places)) == 5 and mixing.word_places(words.slice(2, 2), 1000).tolist() == places[2:4]
    assert mixing.word_places(words.slice(0, 0), 3).tolist() == []


def test_a_bucket_merges_events_some_rows_at_a_time(monkeypatch):
    """The same scores, row by row, as if all rows were read at once; equal events of different rows are one."""
    rng = np.random.default_rng(7)
    rows = []
    for source in range(6):
        x = rng.integers(0, 6, (40, 3))
        learnt = 30
        rows.append((3, 0, source, learnt, *(mixing.pack(c) for c in x.T), mixing.pack(rng.integers(1, 5, 40))))
    want, coded = mixing.Bucket(rows).scored(False)
    monkeypatch.setattr(mixing, "_EVENTS", 50)
    found, again = mixing.Bucket(rows).scored(False)
    assert len(found) == 6 and coded.tolist() == again.tolist()
    events = defaultdict(set)
    for row, (s, e), (t, f) in zip(rows, want, found):
        assert s.tolist() == t.tolist() and e.tolist() == f.tolist() and len(s) == 40
        for i, key in enumerate(zip(*(mixing.unpack(c).tolist() for c in row[4:7]))):
            events[i >= 30, key].add((float(s[i]), bool(e[i])))
    assert all(len(x) == 1 for x in events.values()) and len(events) < 240
