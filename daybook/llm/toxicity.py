"""Toxicity by a support vector machine with a gap-weighted subsequence kernel and Nyström landmarks.

Two words are as alike as the triples of letters that they share in order, with up to ``MAX_SPAN - 2`` letters skipped;
each skipped letter costs a factor ``DECAY``. Signs inside a word are skipped and letters written one by one are joined, so
"i.d.i.o.t", "i d i o t" and "idxiot" stay near "idiot". A text is labelled, its words are not: words of labelled
texts that are toxic beyond chance or explain toxic texts are the first positive examples, and words with a positive margin in
toxic texts only join them. The words that the machine compares others to (landmarks) span its feature space.

The kernel has finitely many features, one per triple, so the trained sum over landmarks is one weight per triple: a
text is scored in a single pass over its letters with a table of 64 ** 3 weights, which is all that is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import ship, whole

DECAY, MAX_SPAN, LETTERS = 0.7, 5, 64
_SKIP, _EDGE = LETTERS - 1, 0
_STEPS = [(a, b) for a in range(1, MAX_SPAN - 1) for b in range(1, MAX_SPAN - a)]
_PIECE = 1_000_000


def _letter_table() -> np.ndarray:
    """Code points below 0x3040 to letters: a-z are 1..26, others share 27..62, white space parts words, signs are skipped."""
    table = np.array([27 + p % 36 for p in range(0x3040)], np.uint8)
    table[:0x80] = _SKIP
    table[0x80:0xC0] = _SKIP
    table[0x2000:0x2070] = table[0x3000:0x3040] = _SKIP
    for p in [*range(0x41, 0x5B), *range(0x61, 0x7B)]:
        table[p] = (p & 31)
    table[0xC0:0xDF] = table[0xE0:0xFF]  # accented capitals as their small letters
    for p in [*range(9, 14), 0x20, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x3000]:
        table[p] = _EDGE
    return table


_TABLE = _letter_table()
_BLANK = re.compile("[" + "".join(map(chr, np.flatnonzero(_TABLE == _EDGE))) + "]")


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(texts' numbers, pieces): runs of some ``_PIECE`` characters; longer texts are cut at white space."""
    numbers, parts, size = [], [], 0
    for n, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = min(len(text), at + _PIECE)
            if stop < len(text):
                # At white space of any kind, the next one if there is none in the piece, so no word is cut.
                blank = max(text.rfind(" ", at + 1, stop), text.rfind("\n", at + 1, stop))
                if blank < 0:
                    found = _BLANK.search(text, stop)
                    blank = found.start() if found else len(text)
                stop = blank
            numbers.append(n)
            parts.append(text[at:stop])
            size += stop - at
            at = stop
            if size >= _PIECE:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


def letters(parts: list[str], join_singles: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, edges, part of each word): the words of all parts, each after an edge, and one more edge at the end."""
    points = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = 1 + np.cumsum([0, *[len(p) + 1 for p in parts]])
    codes = _TABLE[np.minimum(points, 0x303F)]
    high = points >= 0x3040
    if high.any():
        codes[high] = 27 + points[high] % 36
    at = np.flatnonzero(codes != _SKIP)
    codes = codes[at]
    keep = np.ones(len(codes), bool)
    keep[:-1] = (codes[:-1] != _EDGE) | (codes[1:] != _EDGE)  # of a run of edges the last stays
    codes, at = codes[keep], at[keep]
    if join_singles and len(codes) > 4:
        edge = codes == _EDGE
        inner = np.flatnonzero(edge[2:-2] & edge[:-4] & edge[4:] & ~edge[1:-3] & ~edge[3:-1]) + 2
        owner = np.searchsorted(begins, at, "right")
        inner = inner[owner[inner - 1] == owner[inner + 1]]
        keep = np.ones(len(codes), bool)
        keep[inner] = False
        codes, at = codes[keep], at[keep]
    edges = np.flatnonzero(codes == _EDGE)
    if len(edges) < 2:
        return codes, edges, np.empty(0, np.int64)
    return codes, edges, np.searchsorted(begins, at[edges[:-1] + 1], "right") - 1


def triples(codes: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(places, triple numbers, weight) for each way to step twice inside a word; a word's two edges count as letters."""
    codes = codes.astype(np.int32)
    room = np.zeros(len(codes), np.int32)
    room[edges[:-1]] = np.diff(edges)
    inside = np.repeat(edges[1:], np.diff(edges))
    room[edges[0]:edges[-1]] = inside - np.arange(edges[0], edges[-1])
    first, second = codes << 12, codes << 6
    for a, b in _STEPS:
        n = len(codes) - a - b
        if n <= 0:
            continue
        number = first[:n] | second[a:a + n] | codes[a + b:]
        yield room[:n] >= a + b, number, DECAY ** (a + b + 1)


def _norms(sizes: np.ndarray) -> np.ndarray:
    """The length of a word's feature vector as if its triples were all different, from its letters and edges."""
    total = np.zeros(len(sizes))
    for a, b in _STEPS:
        total += np.maximum(0, sizes - (a + b)) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Model:
    weights: np.ndarray  # one per triple
    bias: float
    texts: np.ndarray  # of a text's features, the last is the constant

    def margins(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(margin, part) of each word."""
        codes, edges, part = letters(parts)
        if not len(part):
            return np.empty(0), part
        sums = np.zeros(len(codes), np.float32)
        for fits, number, weight in triples(codes, edges):
            sums[:len(number)] += np.where(fits, self.weights[number], 0) * np.float32(weight)
        found = np.add.reduceat(sums, edges[:-1]) / _norms(np.diff(edges) + 1)
        return found + self.bias, part

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: the log of its words' squared positive margins, the log of their number, and 1."""
        strength, words = np.zeros(len(texts)), np.zeros(len(texts))
        for numbers, parts in _pieces(texts):
            margin, part = self.margins(parts)
            text = np.asarray(numbers)[part]
            np.add.at(strength, text, np.clip(margin, 0, 1) ** 2)
            np.add.at(words, text, 1)
        return np.stack([np.log1p(4 * strength), np.log1p(words), np.ones(len(texts))], axis=1)

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-self.features(texts) @ self.texts))


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of words and landmarks."""
    def rows(part: list[str]):
        codes, edges, _ = letters(part, join_singles=False)
        place = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        found = [(place[np.flatnonzero(fits)], number[fits], np.full(fits.sum(), w)) for fits, number, w in triples(codes, edges)]
        return [np.concatenate(c) for c in zip(*found)] + [_norms(np.diff(edges) + 1)]

    word, number, weight, norm = rows(landmarks)
    used, slot = np.unique(number, return_inverse=True)
    table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(table, (slot, word), weight / norm[word])
    where = np.full(LETTERS ** 3, len(used), np.int32)
    where[used] = np.arange(len(used))
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for at in range(0, len(words), 5000):
        word, number, weight, norm = rows(words[at:at + 5000])
        known = where[number] < len(used)
        word, number, weight = word[known], number[known], weight[known]
        order = np.argsort(word, kind="stable")
        word, values = word[order], table[where[number[order]]] * weight[order, None].astype(np.float32)
        if len(word):
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            out[at + word[begin]] = np.add.reduceat(values, begin, axis=0) / norm[word[begin], None]
    return out


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """The weights of a linear support vector machine (squared hinge loss), by Newton steps; the last is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3 * ridge
    v = np.zeros(x.shape[1])
    for _ in range(12):
        inside = y * (x @ v) < 1
        own, w = x[inside], weight[inside]
        new = np.linalg.solve(own.T @ (own * w[:, None]) + np.diag(penalty), own.T @ (w * y[inside]))
        if np.abs(new - v).max() < 1e-6:
            break
        v = new
    return v


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    v = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ v))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(v)), x.T @ (y - p) - ridge * v)
        v += step
        if np.abs(step).max() < 1e-8:
            break
    return v


def _seeds(bags: list[np.ndarray], toxic: np.ndarray, size: int, most: int) -> list[int]:
    """Words that are toxic beyond chance (a likelihood ratio against all words), then a greedy cover of what is left:
    words that each explain toxic texts that no earlier one does, and are rare in the others."""
    inside = [b for b, t in zip(bags, toxic) if t]
    count = lambda some: np.bincount(np.concatenate([*some, np.empty(0, np.int64)]).astype(np.int64), minlength=size)
    number, clean = count(inside), count([b for b, t in zip(bags, toxic) if not t])
    share, total = len(inside) / len(bags), number + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.nan_to_num(number * np.log(number / (total * share))) + np.nan_to_num(clean * np.log(clean / (total * (1 - share))))
    allowed = (number >= 2) & (clean <= 0.05 * number / share * (1 - share))
    sure = np.flatnonzero(allowed & (ratio > np.log(size) + 5))
    chosen = sure[np.argsort(-number[sure], kind="stable")][:most].tolist()
    left = [b for b in inside if not np.isin(b, chosen).any()]
    while left and len(chosen) < most:
        gain = np.where(allowed, count(left), 0)
        best = int(gain.argmax())
        if gain[best] < max(2, 0.01 * len(inside)):
            break
        chosen.append(best)
        left = [b for b in left if best not in b]
    return chosen


def _signature(words: list[str]) -> tuple[int, int]:
    """Two smallest hashes of a text's words: near copies nearly always share them."""
    raw = [w.encode() for w in words]
    return min(map(zlib.crc32, raw)), min(zlib.crc32(w, 0x9E3779B9) for w in raw)


def train(samples: list[tuple[str, int]], landmarks: int = 160, negatives: int = 20_000, rounds: int = 3) -> Model:
    """A model of (text, label) pairs, as ``fit`` makes it of their words."""
    return fit([(Counter(_words(text)), label) for text, label in samples], landmarks, negatives, rounds)


def fit(samples: list[tuple[dict[str, int], int]], landmarks: int = 160, negatives: int = 20_000, rounds: int = 3) -> Model:
    """A model of texts given as (number of each word, label); without both labels among them, one that gives all texts
    the same score. Of texts whose words have the same two smallest hashes, copies nearly always, the first counts.

    ``landmarks`` and ``negatives`` bound the words that others are compared to, and the clean words and those of toxic
    texts alone that are used, the nearest to toxic ones first.
    """
    seen, bags, toxic, times = set(), [], [], []
    vocabulary: dict[str, int] = {}
    for counts, label in samples:
        words = sorted(counts)
        if not words or (sign := _signature(words)) in seen:
            continue
        seen.add(sign)
        bags.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words]))
        times.append(np.array([counts[w] for w in words], float))
        toxic.append(label)
    toxic = np.array(toxic, int)
    seeds = _seeds(bags, toxic, len(vocabulary), landmarks // 2) if 0 < toxic.sum() < len(toxic) else []
    if not seeds:
        share = (toxic.sum() + 1) / (len(toxic) + 2)
        return Model(np.zeros(LETTERS ** 3, np.float32), -1.0, np.array([0, 0, np.log(share / (1 - share))]))
    names = list(vocabulary)
    clean = np.bincount(np.concatenate([b for b, t in zip(bags, toxic) if not t]), minlength=len(names))
    bad = np.bincount(np.concatenate([b for b, t in zip(bags, toxic) if t]), minlength=len(names))
    seed_names = [names[i] for i in seeds]
    nearness = np.concatenate([_kernel(names[i:i + 20_000], seed_names).max(axis=1) for i in range(0, len(names), 20_000)])
    ranked = np.argsort(-nearness, kind="stable")
    near = [i for i in ranked if clean[i] and i not in seeds][:negatives]
    step = max(1, len(near) // max(1, landmarks - len(seeds) - landmarks // 4))
    marks = [*seeds, *near[:landmarks // 4], *near[landmarks // 4::step]][:landmarks]
    only_bad = [i for i in ranked if not clean[i]][:negatives]
    held = np.concatenate([seeds, np.setdiff1d(only_bad, seeds), near]).astype(int)
    values = _kernel([names[i] for i in held], [names[i] for i in marks]).astype(float)
    own = _kernel([names[i] for i in marks], [names[i] for i in marks]).astype(float)
    size, basis = np.linalg.eigh((own + own.T) / 2)
    use = size > 1e-4 * size.max()
    root = basis[:, use] / np.sqrt(size[use])
    x, is_near = values @ root, np.isin(held, near)
    positive = np.isin(held, seeds)
    for _ in range(rounds):
        chosen = positive | is_near
        y = np.where(positive, 1.0, -1.0)[chosen]
        weight = np.where(y > 0, np.sqrt(bad[held][chosen]) * 0.3 * is_near.sum() / max(1.0, np.sqrt(bad[held][positive]).sum()), 1.0)
        v = _squared_hinge(x[chosen], y, weight, 1.0)
        grown = ~is_near & (x @ v[:-1] + v[-1] > 0.0) & (positive | (bad[held] >= 1))
        positive = grown | np.isin(held, seeds)
    table = np.zeros(LETTERS ** 3)
    codes, edges, _ = letters([names[i] for i in marks], join_singles=False)
    place, norm = np.repeat(np.arange(len(edges) - 1), np.diff(edges)), _norms(np.diff(edges) + 1)
    beta = root @ v[:-1]
    for fits, number, w in triples(codes, edges):
        at = np.flatnonzero(fits)
        np.add.at(table, number[fits], w * beta[place[at]] / norm[place[at]])
    model = Model(table.astype(np.float32), float(v[-1]), np.zeros(3))
    strength = np.zeros(len(names))
    for i in range(0, len(names), 20_000):
        margin, part = model.margins(names[i:i + 20_000])
        strength[i + part] = np.clip(margin, 0, 1) ** 2
    features = [(np.log1p(4 * t @ strength[b]), np.log1p(t.sum()), 1.0) for b, t in zip(bags, times)]
    return Model(model.weights, model.bias, _logistic(np.array(features), toxic))


def _words(text: str) -> list[str]:
    """The words that ``letters`` sees, as text again: one character per letter code."""
    out = []
    for _, parts in _pieces([text]):
        codes, edges, _ = letters(parts)
        out += _AS_TEXT[codes].tobytes().decode("utf-32-le").split()
    return out


#: A character for each letter code, which ``_TABLE`` gives that code.
_AS_TEXT = np.array([0x20, *range(0x61, 0x7B), *[0x100 + (c - 27 - 0x100) % 36 for c in range(27, _SKIP)], 0x20], "<u4")


def is_held_out(id_col: str | Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows that no label is learnt from: the CRC-32 of the id as text falls in the fold."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(_k, _t, _y): at most ``most`` texts of either label, those of the smallest hashes of their ids, outside the
    held-out fold."""
    known = labels.select(F.col(id_col).alias("_k"), F.col(label_col).alias("_y")).filter(
        F.col("_y").isNotNull() & ~is_held_out("_k")).groupBy("_k").agg(F.max("_y").alias("_y"))
    order = [F.xxhash64("_k"), F.col("_k")]
    chosen = [known.filter(side).orderBy(*order).limit(most) for side in (F.col("_y") == 1, F.col("_y") != 1)]
    # Twice ``most`` rows of an id and a label.
    texts = docs.select(F.col(id_col).alias("_k"), whole(text_col).alias("_t"))
    return texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_k").select("_k", "_t", "_y").dropDuplicates(["_k"])


def learn(sample: DataFrame) -> Model:
    """The model of a sample (_k, _t, _y). Tasks cut the texts into words, one task fits the machine to them; only its
    table of weights reaches the driver."""
    ship(sample.sparkSession)

    def counted(batches):
        from daybook.llm import toxicity as own

        for batch in batches:
            found = [Counter(own._words(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(c) for c in found], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int64())), batch.column(2)], names=["key", "words", "times", "y"])

    def fitted(batches):
        from daybook.llm import toxicity as own

        samples = []
        for batch in batches:
            for words, times, y in zip(*[batch.column(k) for k in (1, 2, 3)]):
                samples.append((dict(zip(words.as_py(), times.as_py())), int(y.as_py() == 1)))
        model = own.fit(samples)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype(np.float32).tobytes()]), pa.array([float(model.bias)]),
                                          pa.array([[float(x) for x in model.texts]])], names=["weights", "bias", "texts"])

    rows = sample.select(F.col("_k").cast("string").alias("key"), "_t", F.col("_y").cast("int").alias("y")).mapInArrow(
        counted, "key string, words array<string>, times array<long>, y int")
    # One task, as the sample is bounded; without any row it still gives a model.
    found = rows.repartition(1).sortWithinPartitions("key", "y").mapInArrow(fitted, "weights binary, bias double, texts array<double>").collect()
    if not found:
        return fit([])
    weights, bias, texts = found[0]
    return Model(np.frombuffer(weights, np.float32), bias, np.array(texts))


def toxicity_score(model: Model, text_col: str | Column, spark) -> Column:
    """The score of a text, 0 to 1; null counts as empty."""
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.texts))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from daybook.llm.toxicity import Model as Own

        own = Own(*shared.value)
        for texts in parts:
            yield pd.Series(own.score(texts.tolist()))

    return score(whole(text_col))


def with_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", most: int = 2500, score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text. Labels are learnt from ``most`` texts of either label at most.

    Null and empty texts get the score of a text without words. Rows without labels are scored alike.
    """
    model = learn(labelled_sample(docs, labels, id_col, text_col, label_col, most))
    return docs.withColumn(score_col, toxicity_score(model, text_col, docs.sparkSession))
