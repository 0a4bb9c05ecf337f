"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, vocabulary acceptor.

Every pair of words that one inserted, deleted or replaced letter turns into each other is accepted by the composed
machine. It is enumerated by partitions of its initial states: words of equal length (or one letter longer) that share
the letters before ``lo`` and those from ``hi`` on start in one state, and the transducer's edit lies between. The
vocabulary is first split at the middle of its words (an edit in one half leaves the other half as it is). Partitions
of more than ``most`` words are split again at the middle of what is left, until one letter is left, so a beginning or
ending that a third of all words share is dealt over many tasks, and nothing is left out.

A task compiles the words of one partition into minimal acceptors: a state is its right language, equal ones are one
state, and a state of a single word is the word's remaining letters themselves. Words with one edit are found where two
paths part: the rest of both must be accepted by both states, whose common right language is looked up once per pair.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import LOWER, UPPER, ship, spread, whole, written

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_KEEP = 300_000


def runs(key: str, text: str, least: int, modulus: int = 31) -> Iterator[str]:
    """The words of a text: runs of letters, A-Z in lower case; of one in ``modulus``, chosen by the CRC-32 of ``key``
    and the run, a letter is deleted. Those that end up shorter than ``least`` letters are left out."""
    first = zlib.crc32(f"{key}:".encode())
    for run in re.findall(r"[A-Za-zÀ-ÿ]{%d,}" % least, text.encode().translate(_FOLD).decode()):
        h = zlib.crc32(run.encode(), first)
        if h % modulus == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        yield run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7) -> DataFrame:
    """(word, n): the words of at least ``least`` letters of all texts and their occurrences."""
    ship(docs.sparkSession)

    def counted(batches):
        from daybook.llm import spelling as own

        totals: Counter = Counter()

        def packed():
            words, numbers = list(totals), list(totals.values())
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + 50_000], pa.string()),
                                                  pa.array(numbers[at:at + 50_000], pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(*batch.columns):
                totals.update(own.runs(key.as_py(), text.as_py(), least))
                if len(totals) > own._KEEP:
                    yield from packed()
                    totals.clear()
        yield from packed()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), whole(text_col).alias("text"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """Minimal acceptors over shared states.

    A state is a string, whose right language is that string alone, or a ``(final, arcs)`` pair; equal right languages
    are the same object.
    """

    def __init__(self):
        self._states: dict[tuple, tuple] = {}
        self._shared: dict[tuple[int, int], list[str]] = {}

    def state(self, words: list[str], at: int = 0):
        """The state from which the rest of the sorted, distinct ``words`` after ``at`` letters is accepted."""
        if len(words) == 1:
            return words[0][at:]
        final = len(words[0]) == at
        arcs = {c: self.state(list(some), at + 1) for c, some in groupby(words[final:], lambda w: w[at])}
        key = (final, *[(c, to if type(to) is str else id(to)) for c, to in arcs.items()])
        return self._states.setdefault(key, (final, arcs))

    def shared(self, a, b) -> list[str]:
        """The strings that both states accept."""
        if type(a) is str:
            return [a] if _accepts(b, a) else []
        if type(b) is str:
            return [b] if _accepts(a, b) else []
        key = (id(a), id(b))
        found = self._shared.get(key)
        if found is None:
            found = [""] if a[0] and b[0] else []
            arcs, other = a[1], b[1]
            for c in arcs.keys() & other.keys():
                found += [c + rest for rest in self.shared(arcs[c], other[c])]
            self._shared[key] = found
        return found


def _accepts(state, text: str) -> bool:
    for at, c in enumerate(text):
        if type(state) is str:
            return state == text[at:]
        state = state[1].get(c)
        if state is None:
            return False
    return state == "" if type(state) is str else state[0]


def _arcs(state) -> dict:
    if type(state) is str:
        return {state[0]: state[1:]} if state else {}
    return state[1]


def one_edit_pairs(short: list[str], long: list[str], at_end: bool = True) -> Iterator[tuple[str, str]]:
    """The pairs of sorted distinct strings that the composed machine accepts: two of ``short`` (all of one length) that
    differ in one letter, or one of ``short`` and one of ``long`` with a letter more. An inserted letter stands as far
    right as it can; without ``at_end`` it isn't the last one."""
    if not short or len(short) + len(long) < 2:
        return
    deep = 2 * len(short[0]) + 1000
    if deep > sys.getrecursionlimit():
        sys.setrecursionlimit(deep)
    acceptor = Acceptor()
    start = acceptor.state(short), acceptor.state(long) if long else None
    stack = [("", *start)]
    while stack:
        path, a, b = stack.pop()
        if type(a) is str and (b is None or type(b) is str):
            if b is not None:
                same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
                if b[same + 1:] == a[same:] and (at_end or same < len(a)):
                    yield path + a, path + b
            continue
        arcs = _arcs(a)
        if len(arcs) > 1:
            sides = list(arcs.items())
            for i, (x, left) in enumerate(sides):
                for y, right in sides[:i]:
                    for rest in acceptor.shared(left, right):
                        yield path + x + rest, path + y + rest
        if b is not None:
            for x, to in _arcs(b).items():
                for rest in acceptor.shared(to, a):
                    if rest[:1] != x and (rest or at_end):
                        yield path + rest, path + x + rest
        other = {} if b is None else _arcs(b)
        for x, to in arcs.items():
            below = other.get(x)
            if below is not None or type(to) is not str:
                stack.append((path + x, to, below))


def _dealt(words: DataFrame) -> DataFrame:
    """(size, low, high, word, n) for each half of a word, as one of the shorter and as one of the longer words."""
    length = F.char_length("word")
    sizes = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")).filter("size > 0")
    half = F.floor(F.col("size") / 2).cast("int")
    parts = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), F.col("size").alias("high")))
    return sizes.select("word", "n", "size", F.explode(parts).alias("_p")).select("word", "n", "size", "_p.low", "_p.high").filter("low < high")


def _keyed(parts: DataFrame) -> DataFrame:
    """``parts`` with the name of each one's partition: size, bounds, and the letters before and after them."""
    tail = F.col("size") - F.col("high")
    return parts.withColumn("key", F.concat_ws(":", "size", "low", "high", F.expr("left(word, low)"), F.expr("right(word, size - high)"))
                            ).withColumn("tail", tail)


def _halved(parts: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    return parts.select("word", "n", "size", F.explode(both).alias("_p")).select("word", "n", "size", "_p.low", "_p.high")


def near_pairs(words: DataFrame, most: int = 20_000) -> DataFrame:
    """(a, n_a, b, n_b): each pair of distinct words of ``words`` (word, n) with one edit between them, once.

    ``most`` is the number of words that a task compiles at once. A partition of one letter has some 10,000 words at
    most and isn't split; ``most`` only says how work is dealt, not what is found.
    """
    ship(words.sparkSession)
    out, parts = None, _dealt(words)
    while True:
        keyed = _keyed(parts)
        crowded = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("key"), "spelling-crowded")
        # One row per ``most`` words at the least.
        fits = keyed.join(crowded, "key", "left_anti") if not crowded.isEmpty() else keyed
        single = keyed.filter("high - low = 1").join(crowded, "key", "left_semi")
        rows = fits.unionByName(single).select("key", "low", "tail", "size", "word", "n")
        found = spread(rows, "key").sortWithinPartitions("key", "word").mapInArrow(_composed, "a string, n_a long, b string, n_b long")
        out = found if out is None else out.unionByName(found)
        rest = keyed.filter("high - low > 1").join(crowded, "key", "left_semi")
        if crowded.isEmpty() or rest.isEmpty():
            return out
        parts = written(_halved(rest), "spelling-parts")


def _composed(batches):
    """Rows sorted by partition to the pairs of each partition."""
    from daybook.llm import spelling as own

    def rows():
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    held: list[list] = [[], [], [], []]

    def packed():
        kinds = [pa.string(), pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names=["a", "n_a", "b", "n_b"])

    for _, group in groupby(rows(), lambda r: r[0]):
        group = list(group)
        if len(group) < 2:
            continue
        _, low, tail, size, word, _ = group[0]
        cut = lambda w: w[low:len(w) - tail]
        number = {r[4]: r[5] for r in group}
        short, long = [], []
        for w in number:
            (short if len(w) == size else long).append(cut(w))
        # Words of one partition share what is cut off.
        before, after = word[:low], word[len(word) - tail:]
        for a, b in own.one_edit_pairs(sorted(short), sorted(long), at_end=tail == 0):
            a, b = before + a + after, before + b + after
            for column, value in zip(held, (a, number[a], b, number[b])):
                column.append(value)
            if len(held[0]) >= 50_000:
                yield packed()
                held[:] = [], [], [], []
    yield packed()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form; each word once, no circles) ends, by doubling the steps."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = written(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                               F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        now = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7,
                      least_n: int = 2, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a row per word of at least ``least`` letters and ``least_n`` occurrences.

    ``form`` is the most frequent word with one edit between (of equally frequent ones the first in code-point order)
    if it is at least ``ratio`` times as frequent, else null; ``root`` is where the forms lead. Null texts have no words;
    a null id is empty; rows that repeat an id and a text count each. An empty table gives an empty result.
    """
    words = written(word_counts(docs, id_col, text_col, least).filter(F.col("n") >= least_n), "spelling-words")
    pairs = written(near_pairs(words), "spelling-pairs")
    other = lambda side: F.struct((-F.col(f"n_{side}")).alias("less"), F.col(side).alias("word"))
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), other("b").alias("near")), F.struct(F.col("b").alias("word"), other("a").alias("near"))))
    near = pairs.select(both.alias("_p")).select("_p.word", "_p.near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    is_form = -F.col("best.less") >= F.col("n") * ratio
    named = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(named.filter("form is not null"))
    return named.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
