"""Language-model scores by logistic mixing of hashed-context bit predictors, counted in the whole corpus.

A text is its words and an end. Each of these is an event: a symbol after the word before and the two words before. The
events of all texts are dealt to buckets by the word before, so a bucket holds all that the corpus has after its contexts;
after a word that alone would fill much of a bucket they are dealt by the second word before as well, so that the context
of both is whole. The number of buckets grows with the corpus, some ``SHARD_BYTES`` of text each. There a symbol is a run of
bits: its path in a Huffman tree of the words that the bucket's training events hold at least twice. Three predictors tell
how often the bit was 0 and 1 at this place of the tree: always, after the word before (of a word that is dealt further:
where its share of second words goes), and after the two words before. Contexts are hashed into tables of more slots than
there are forms of them. Their log odds are added with weights that a gate chooses, how often the two contexts were seen;
the weights learn online, block by block, over all training events of the bucket in the order of a hash; a last table
corrects the mixed probability by what came out where it stood before. What a training event adds to the tables itself is
left out, bit by bit, when it is learnt from and scored. Equal events are predicted once and weigh as often as they occur.

Other words are an escape and what follows it: their share of the counts of the whole corpus, mixed evenly with their
spelling, letter by letter, by three predictors of the same kind over the last two and three letters, counted in all
distinct words of the corpus and dealt by the last two. So a score sums the bits of a proper model, depends on the
order of words, and is learnt from all training texts.

Spark deals packed events to buckets and their scores back to the texts: parts of the texts are numbered word by word once,
the distinct words of all parts meet at places by a hash, get numbers by falling count, and go back. Frequent words (at
least 1 / ``HEAD`` of all tokens, so ``HEAD`` at most) are broadcast, as a bucket must know what its escapes don't hold. A
text's result does not depend on tasks or partitions.
"""

from __future__ import annotations

import math
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import ship, written

HEAD = 1_000_000
SHARD_BYTES = 6 << 20
_KEEP, _BLOCK, _PIECE = 32 << 20, 8192, 4 << 20  # bytes of words, symbols, bytes of text
_STEPS, _PART = 1 << 14, 1 << 17  # predicted and counted at a time, so that a core's cache holds them
_LANES = 8
_UPDATES = 24  # of the weights, at least
_EVENTS = 1 << 21  # made distinct at a time
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LEVELS = np.array([0, 1, 2, 2, 2, 3])  # of the number of times a context was seen, 5 standing for more
_GATES, _KNOTS, _RANGE = 12, 33, 8.0
_LEAST_BITS = 10  # of the slots of a table
_END = 0x20  # what follows a word's letters, none of which is a blank


def _split(texts: pa.Array):
    """The words of all texts, runs without white space, A-Z in lower case, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    # White space at a text's ends gives empty words.
    filled = pc.binary_length(words).to_numpy() > 0
    if not filled.all():
        ends = np.concatenate([[0], np.cumsum(filled)])[ends - ends[0]]
        words = words.filter(pa.array(filled))
    return words.cast(pa.binary()), np.diff(ends).astype(np.int64)


def _pieces(text: memoryview):
    """A text in runs of some ``_PIECE`` bytes that end at white space."""
    at = 0
    while len(text) - at > _PIECE:
        blank = _BLANK.search(text, at + _PIECE)
        if not blank:
            break
        yield text[at:blank.start()]
        at = blank.start()
    yield text[at:]


def word_runs(texts: pa.Array):
    """(a text's number, words of it and those after it, how many each has): words in order, of some ``_PIECE`` bytes of
    text at a time; a text that is longer comes in several runs."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.view(pa.string())
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        begin = int(ends[at - 1]) if at else 0
        stop = int(np.searchsorted(ends, begin + _PIECE, side="right"))
        if stop > at:
            yield at, *_split(texts.slice(at, stop - at))
            at = stop
        else:
            for piece in _pieces(memoryview(texts[at].as_buffer())):
                place = pa.py_buffer(np.array([0, len(piece)], np.int32))
                yield at, *_split(pa.Array.from_buffers(pa.string(), 1, [None, place, pa.py_buffer(piece)]))
            at += 1


def numbered(runs: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of all runs as they come, and the number of each word there."""
    found = pa.chunked_array(runs, pa.binary()).dictionary_encode().chunks
    words = found[0].dictionary if found else pa.array([], pa.binary())
    return words, np.concatenate([*[c.indices.to_numpy() for c in found], np.empty(0, np.int32)])


def is_held_out(id_col: str | Column, folds: int = 10, fold: int = 0) -> Column:
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string")) % folds == fold, F.lit(False))


class Code:
    """A Huffman code: of symbol i the steps from the root, twice a node's number and the bit that is taken there, are
    ``step[k]`` for k from ``start[i]`` on, ``size[i]`` of them."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        order = np.argsort(counts, kind="stable")
        # Nothing is left of leaves, or of inner nodes, where there stands infinity.
        weight, inner = [*counts[order].tolist(), math.inf], [math.inf] * n
        parent, bit = [0] * (2 * n - 1), bytearray(2 * n - 1)
        # Leaves by rising weight and inner nodes as they come are both sorted.
        leaf, made = 0, 0
        for k in range(n - 1):
            if weight[leaf] <= inner[made]:
                zero, w, leaf = leaf, weight[leaf], leaf + 1
            else:
                zero, w, made = n + made, inner[made], made + 1
            if weight[leaf] <= inner[made]:
                one, more, leaf = leaf, weight[leaf], leaf + 1
            else:
                one, more, made = n + made, inner[made], made + 1
            parent[zero] = parent[one] = n + k
            bit[one], inner[k] = 1, w + more
        parent, bit = np.array(parent, np.int64), np.frombuffer(bit, np.uint8)
        self.nodes = max(n - 1, 1)
        self.size = np.zeros(n, np.int64)
        at = np.arange(n)
        top = 2 * n - 2
        while (up := at != top).any():
            self.size[order[up]] += 1
            at = np.where(up, parent[at], at)
        self.start = np.cumsum(self.size) - self.size
        self.step = np.zeros(int(self.size.sum()), np.int32)
        at, place = np.arange(n), (self.start + self.size)[order]
        while len(which := np.flatnonzero(at != top)):
            place[which] -= 1
            self.step[place[which]] = (parent[at[which]] - n) * 2 + bit[at[which]]
            at[which] = parent[at[which]]

    def spread(self, symbols: np.ndarray):
        """(number of each symbol's steps, the steps) of some symbols, one after the other."""
        size = self.size.take(symbols, mode="clip")
        ends = np.cumsum(size)
        at = np.repeat(self.start.take(symbols, mode="clip") - ends + size, size)
        at += np.arange(len(at))
        return size, self.step.take(at, mode="clip")


def _odds_table() -> np.ndarray:
    """Log odds of every pair of counts below 256, ones in the high byte."""
    n = np.arange(256) + 0.4
    return np.log(n[:, None] / n[None, :]).astype(np.float32).ravel()


def _level_tables() -> list[np.ndarray]:
    """What each context adds to the gate, for every pair of counts."""
    n = np.arange(256)
    level = _LEVELS[np.minimum(n[:, None] + n[None, :], 5)].ravel()
    return [(level * 3).astype(np.int8), np.minimum(level, 2).astype(np.int8)]


_ODDS, _LEVEL = _odds_table(), _level_tables()
_LANE = np.arange(_STEPS) % _LANES * _GATES
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_NODE = np.uint64(0xD6E8FEB86659FD93 * 0xBF58476D1CE4E5B9 % 2**64)  # of a node in the hash, spread as well
_MIDDLE = np.tile(1 / (1 + np.exp(-np.linspace(-_RANGE, _RANGE, _KNOTS))), _GATES)


def _table(keys: np.ndarray, bits: int, times: np.ndarray | None = None) -> np.ndarray:
    """How often each slot saw 1, in the high byte, and 0, from twice the slot and the bit of each event, and how often it
    occurred, once each if that is not given; counts of slots that are seen more often than a byte can tell keep their ratio."""
    counts = np.zeros(2 << bits, np.uint8)
    if times is not None:
        # An eighth of the slots at a time.
        for k in range(8):
            which = keys >= k << (bits - 2)
            which &= keys <= ((k + 1) << (bits - 2)) - 1
            _count_often(keys[which], times[which], counts)
        return counts.view("<u2")
    keys.sort()
    at, crowded = 0, []
    while at < len(keys):
        # All events of the last key are in one part.
        stop = int(np.searchsorted(keys, keys[min(at + _PART, len(keys)) - 1], side="right"))
        part, at = keys[at:stop], stop
        new = np.flatnonzero(part[1:] != part[:-1])
        new += 1
        key, number = part[np.append(0, new)], np.diff(new, prepend=0, append=len(part))
        many = number > 255
        if many.any():
            crowded.append(key[many] >> 1)
            np.minimum(number, 255, out=number)
        counts[key.astype(np.int64)] = number.astype(np.uint8)
    if crowded:
        slots = np.unique(np.concatenate(crowded)).astype(np.int64)
        low, middle, high = np.searchsorted(keys, (slots[:, None] * 2 + np.arange(3)).astype(np.uint32).T)
        pairs = np.stack([middle - low, high - middle])
        counts[slots * 2], counts[slots * 2 + 1] = np.where(pairs > 0, np.maximum(1, pairs * 255 // pairs.max(axis=0)), 0)
    return counts.view("<u2")


def _count_often(keys: np.ndarray, times: np.ndarray, counts: np.ndarray) -> None:
    both = keys.astype(np.uint64)
    both <<= np.uint64(32)
    both |= times
    both.sort()
    at, crowded = 0, []
    while at < len(both):
        # All events of the last slot are in one part.
        stop = int(np.searchsorted(both, ((both[min(at + _PART, len(both)) - 1] >> np.uint64(33)) + np.uint64(1)) << np.uint64(33)))
        part, at = both[at:stop], stop
        key = part >> np.uint64(32)
        new = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
        key, number = key[new].view(np.int64), np.add.reduceat(part & np.uint64(0xFFFFFFFF), new).view(np.int64)
        many = number > 255
        if many.any():
            crowded.append((key, number, np.unique(key[many] >> 1)))
        counts[key] = np.minimum(number, 255).astype(np.uint8)
    for key, number, slots in crowded:
        pairs = np.zeros((2, len(slots)))
        for bit in range(2):
            place = np.minimum(np.searchsorted(key, slots * 2 + bit), len(key) - 1)
            pairs[bit] = np.where(key[place] == slots * 2 + bit, number[place], 0)
        counts[slots * 2], counts[slots * 2 + 1] = np.where(pairs > 0, np.maximum(1, pairs * 255 // pairs.max(axis=0)), 0).astype(np.uint8)


def first_weights() -> np.ndarray:
    """Of the predictors and a constant, per gate."""
    return np.full((4, _GATES), 0.4, np.float32)


class Mixer:
    """Bit predictors over the paths of symbols and the weights that mix them.

    The predictors' counts are those of ``symbols`` after ``contexts(a, b)``, which gives each predictor's context of
    symbols a to b; there are no others. Each is counted, and learnt from, as often as ``times`` says, once by itself.
    ``run`` predicts symbols, and learns from them if it is told to. Steps and slots of the counted symbols are kept for
    the run over them.
    """

    def __init__(self, code: Code, symbols: np.ndarray, contexts, times: np.ndarray | None = None):
        self._times = times
        self.code, self.tables, self.used = code, [], []
        self.weights, self.curve = first_weights(), np.zeros((_GATES * _KNOTS, 2))
        events = int(code.size[symbols].sum())
        bits = max(_LEAST_BITS, events.bit_length() - 1)
        # The longer context is met in about twice as many forms as the other.
        self.bits = [bits, bits + 1]
        if times is not None:
            # Most steps of different events are forms of their own.
            self.bits = [min(bits + 2, 30)] * 2
        self._steps, at = np.empty(events, np.int32), 0
        self._keys = [np.empty(events, np.uint32) for _ in range(2)]
        for i in range(0, len(symbols), _BLOCK):
            stop = min(i + _BLOCK, len(symbols))
            size, step = code.spread(symbols[i:stop])
            here = slice(at, at + len(step))
            self._steps[here] = step
            place, one = self._places(step), (step & 1).astype(np.uint32)
            for k, context in enumerate(contexts(i, stop)):
                key = self._keys[k][here]
                key[:] = self._slots(k, context, size, place)
                key <<= np.uint32(1)
                key |= one
            at += len(step)
        often = None
        if times is not None:
            often = np.repeat(np.minimum(times, 2**32 - 1).astype(np.min_scalar_type(int(min(times.max(initial=0), 2**32 - 1)))), code.size[symbols])
        for k in range(2):
            table = _table(self._keys[k].copy() if times is None else self._keys[k], self.bits[k], often)
            self.tables.append(table)
            self.used.append(np.count_nonzero(table) / len(table))
        met = np.repeat(np.bincount(symbols, times, minlength=len(code.size)), code.size)
        whole = np.bincount(code.step, met, minlength=2 * code.nodes)
        zeros, ones = whole.reshape(-1, 2).T + 0.4
        self._whole = np.repeat(np.log(ones / zeros), 2).astype(np.float32)
        # Without one 0, and without one 1.
        less = [np.log(ones / np.maximum(zeros - 1, 0.4)), np.log(np.maximum(ones - 1, 0.4) / zeros)]
        self._less = np.stack(less, axis=1).astype(np.float32).ravel()

    @staticmethod
    def _places(step: np.ndarray) -> np.ndarray:
        """What a step's node adds to the hash of its context."""
        place = (step >> 1).astype(np.uint64)
        place *= _NODE
        return place

    def _slots(self, k: int, context: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        h = np.repeat(context * _SPREAD, size)
        h += place
        h >>= np.uint64(64 - self.bits[k])
        return h.view(np.int64)

    def block(self, symbols: np.ndarray, contexts: list[np.ndarray], own: bool, learning: bool) -> np.ndarray:
        """The log10 probability of each symbol of a block; ``own``: they were counted, and are left out of the counts."""
        size, step = self.code.spread(symbols)
        place = self._places(step)
        return self._predicted(size, step, [self._slots(k, contexts[k], size, place) for k in range(2)], own, learning)

    def _predicted(self, size: np.ndarray, steps: np.ndarray, slots: list[np.ndarray], own: bool, learning: bool,
                   times: np.ndarray | None = None) -> np.ndarray:
        if not len(steps):
            return np.zeros(len(size))
        corrected = ((self.curve[:, 1] + 4 * _MIDDLE) / (self.curve.sum(axis=1) + 4)).astype(np.float32)
        constant = self.weights[3] * np.float32(0.3)
        # No place is out of range; ``take`` is twice as fast where it needn't raise.
        each, met = np.empty(len(steps)), np.zeros(self.curve.size)
        number, weight, slopes = np.zeros(_GATES, np.int64), np.zeros(_GATES), np.zeros((4, _GATES))
        often = np.repeat(times, size).astype(float) if learning and times is not None else None
        for i in range(0, len(steps), _STEPS):
            step = steps[i:i + _STEPS]
            one = (step & 1).astype(bool)
            odds = [(self._less if own else self._whole).take(step, mode="clip")]
            # Arithmetic on the bits: choosing by them costs a branch each.
            less = one * np.uint16(255) + np.uint16(1) if own else None
            level = np.zeros(len(step), np.int8)
            for k in range(2):
                pair = self.tables[k].take(slots[k][i:i + _STEPS], mode="clip")
                if own:
                    pair -= less
                pair = pair.astype(np.int64)
                odds.append(_ODDS.take(pair, mode="clip"))
                level += _LEVEL[k].take(pair, mode="clip")
            gate = level.astype(np.int64)
            mixed = constant.take(gate, mode="clip")
            for k in range(3):
                weighted = self.weights[k].take(gate, mode="clip")
                weighted *= odds[k]
                mixed += weighted
            np.clip(mixed, -_RANGE, _RANGE, out=mixed)
            p = np.exp(-mixed)
            p += 1
            np.reciprocal(p, out=p)
            at = gate * _KNOTS
            mixed += np.float32(_RANGE)
            mixed *= np.float32((_KNOTS - 1) / (2 * _RANGE))
            at += np.rint(mixed, out=mixed).astype(np.int64)
            q = corrected.take(at, mode="clip")
            q += p
            q *= np.float32(0.5)
            q -= ~one
            np.abs(q, out=q)
            each[i:i + _STEPS] = np.log(np.maximum(q, np.float32(1e-6), out=q), out=q)
            if learning:
                error = one - p
                # Neighbours add to different sums, so that none waits for the one before.
                gate += _LANE[:len(gate)]
                number += np.bincount(gate, minlength=_LANES * _GATES).reshape(_LANES, -1).sum(axis=0)
                here = None
                if often is not None:
                    here = often[i:i + _STEPS]
                    error *= here
                    weight += np.bincount(gate, here, minlength=_LANES * _GATES).reshape(_LANES, -1).sum(axis=0)
                for k in range(4):
                    slope = np.bincount(gate, error * odds[k] if k < 3 else error, minlength=_LANES * _GATES)
                    slopes[k] += slope.reshape(_LANES, -1).sum(axis=0)
                at *= 2
                at += one
                met += np.bincount(at, here, minlength=len(met))
        if learning:
            # The mean slope of all occurrences, by the root of the number of different steps.
            rate = (0.02 * np.sqrt(number) / np.maximum(number if often is None else weight, 1)).astype(np.float32)
            self.weights[:3] += rate * slopes[:3].astype(np.float32)
            self.weights[3] += rate * slopes[3].astype(np.float32) * np.float32(0.3)
            self.curve += met.reshape(-1, 2)
        # Every symbol has a step if any has: a code of two symbols or more has no empty path.
        return np.add.reduceat(each, np.cumsum(size) - size) / math.log(10)

    def run(self, symbols: np.ndarray, contexts, own: bool, learning: bool) -> np.ndarray:
        """``block`` over all symbols, ``contexts(a, b)`` giving those of symbols a to b. With ``own`` they are the first of
        those that were counted."""
        parts, at = [], 0
        for i in range(0, len(symbols), _BLOCK):
            some = symbols[i:i + _BLOCK]
            if own:
                size = self.code.size.take(some, mode="clip")
                here = slice(at, at + int(size.sum()))
                parts.append(self._predicted(size, self._steps[here], [key[here] >> np.uint32(1) for key in self._keys], own, learning,
                                             None if self._times is None else self._times[i:i + _BLOCK]))
                at = here.stop
            else:
                parts.append(self.block(some, contexts(i, i + len(some)), own, learning))
        return np.concatenate([*parts, np.empty(0)])


def _mixed(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = (h + p.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h


def word_contexts(words: np.ndarray):
    """Contexts of a run of words and ends, ends being negative; nothing is seen across an end."""
    def contexts(a: int, b: int) -> list[np.ndarray]:
        near = np.concatenate([np.full(max(0, 2 - a), -1), words[max(0, a - 2):b]]) + 1
        one, two = near[1:-1], near[:-2]
        two = np.where(one == 0, 0, two)
        return [_mixed(one), _mixed(one, two)]

    return contexts


def letter_contexts(letters: np.ndarray):
    """Contexts of a run of letters and ``_END``s: the two and three letters before, not beyond an end."""
    def contexts(a: int, b: int) -> list[np.ndarray]:
        one, two, three = _letters_before(letters, a, b)
        return [_mixed(one, two), _mixed(one, two, three)]

    return contexts


def _letters_before(letters: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    near = np.concatenate([np.full(max(0, 3 - a), _END), letters[max(0, a - 3):b]])
    one, two, three = near[2:-1], near[1:-2], near[:-3]
    two = np.where(one == _END, _END, two)
    return [one, two, np.where(two == _END, _END, three)]


class Shard:
    """Some texts as numbers of their words."""

    def __init__(self):
        self.ids, self._held, self._bytes, self._sizes = [], [], [], []
        self._runs, self._numbered = [], []

    def add(self, keys: list, held: np.ndarray, texts: pa.Array) -> None:
        size = np.zeros(len(texts), np.int64)
        for first, words, number in word_runs(texts):
            self._runs.append(words)
            if sum(r.nbytes for r in self._runs) > _KEEP:
                self._pack()
            size[first:first + len(number)] += number
        self.ids += keys
        self._held.append(held)
        self._sizes.append(size)
        self._bytes.append(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))

    def _pack(self) -> None:
        words, found = numbered(self._runs)
        self._numbered.append(pa.DictionaryArray.from_arrays(pa.array(found), words))
        self._runs = []

    def number(self) -> None:
        """Once all texts are added: ``words``, ``found`` (each text's words by number, one text after the other), and per
        text ``sizes`` (how many), ``bytes`` and ``held``."""
        self._pack()
        runs = (pa.chunked_array(self._numbered).unify_dictionaries() if len(self._numbered) > 1 else pa.chunked_array(self._numbered)).chunks
        pa.default_memory_pool().release_unused()
        self.words, self.found = runs[-1].dictionary, np.concatenate([r.indices.to_numpy() for r in runs])
        self.sizes, self.bytes, self.held = (np.concatenate(x) for x in (self._sizes, self._bytes, self._held))


def _log10_sum(a, b):
    top = np.maximum(a, b)
    return top + np.log10(10.0 ** (a - top) + 10.0 ** (b - top))


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers of at least 0, or float32, in few bytes: their bytes of the same weight lie together, compressed."""
    numbers = numbers.view(np.uint32) if numbers.dtype == np.float32 else numbers
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    wide = 1 << (width - 1).bit_length()
    planes = np.ascontiguousarray(numbers.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide)[:, :width].T)
    return len(numbers).to_bytes(8, "little") + bytes([width]) + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    n, width, wide = int.from_bytes(data[:8], "little"), data[8], np.dtype(kind).itemsize
    planes = pa.Codec("zstd", 1).decompress(memoryview(data)[9:], n * width)
    out = np.zeros((n, wide), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view(kind).reshape(n)


def _unpacked(parts: list[bytes], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([*(unpack(p, kind) for p in parts), np.empty(0, kind)])


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, one after the other, and where each begins and the last ends."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    return np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]], ends.astype(np.int64) - ends[0]


def _words_of(letters: bytes, size: bytes) -> pa.Array:
    size = unpack(size)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(unpack(letters, np.uint8))])


def _dealt(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(n)).view(np.int64)


def word_places(words: pa.Array, n: int) -> np.ndarray:
    """Of each word, none of which is empty, one of ``n`` places by a hash of its letters."""
    letters, ends = _bytes_of(words)
    if not len(words):
        return np.empty(0, np.int64)
    size = np.diff(ends)
    power = np.multiply.accumulate(np.full(int(size.max()), 0xD6E8FEB86659FD93, np.uint64))
    h = (letters.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(letters)) - np.repeat(ends[:-1], size)]
    return _dealt(_mixed(np.add.reduceat(h, ends[:-1])), n)


class Events:
    """Symbols after their contexts, given by the one before and the one before that, dealt to buckets: distinct ones by
    bucket, those to learn from first, and how often each occurs. ``inverse`` tells of each one given its place there."""

    def __init__(self, first: np.ndarray, second: np.ndarray, symbol: np.ndarray, held: np.ndarray, bucket: np.ndarray):
        key = bucket.astype(np.uint64) * np.uint64(2)
        key += held
        key <<= np.uint64(40)
        key |= _mixed(first) >> np.uint64(48) << np.uint64(24)
        key |= _mixed(first, second, symbol) >> np.uint64(40)
        order = np.argsort(key)
        key >>= np.uint64(40)
        group = key.astype(np.int32)
        del key
        new, self.inverse = _runs_of([group, first, second, symbol], order)
        there = order[new]
        self.first, self.second, self.symbol = first[there], second[there], symbol[there]
        self.times = np.diff(new, append=len(order))
        group = group[there]
        self.groups = np.unique(group // 2)
        self.cuts = np.searchsorted(group, np.stack([self.groups * 2, self.groups * 2 + 1, self.groups * 2 + 2], axis=1))

    def rows(self, source: int):
        """(bucket, 0, source, how many to learn from, the two before, symbols, times) of each bucket."""
        for bucket, (at, middle, stop) in zip(self.groups.tolist(), self.cuts.tolist()):
            yield bucket, 0, source, middle - at, *(pack(x[at:stop]) for x in (self.first, self.second, self.symbol, self.times))


def _runs_of(columns: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where, in this order, rows begin that differ from the one before, and the number of such a run for each row."""
    differ = np.zeros(len(order), bool)
    differ[:1] = True
    for x in columns:
        x = x[order]
        differ[1:] |= x[1:] != x[:-1]
    inverse = np.empty(len(order), np.int32)
    inverse[order] = np.cumsum(differ, dtype=np.int32) - np.int32(1)
    return np.flatnonzero(differ), inverse


def _narrow(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.uint32) if numbers.max(initial=0) < 2**32 else numbers


class Bucket:
    """The events of the whole corpus after the contexts that are dealt to one bucket, their model and its scores."""

    def __init__(self, rows: list[tuple]):
        self._learnt, self._sizes, self._sides = np.array([r[3] for r in rows]), np.zeros(len(rows), np.int64), []
        # Contexts that are met very often come from every part: their events are made distinct some rows at a time.
        found, at = ([], []), 0
        while at < len(rows):
            some, size = [], 0
            while at + len(some) < len(rows) and size < _EVENTS:
                some.append([_narrow(unpack(x)) for x in rows[at + len(some)][4:8]])
                self._sizes[at + len(some) - 1] = len(some[-1][0])
                size += len(some[-1][0])
            for held in range(2):
                cut = [slice(m, None) if held else slice(m) for m in self._learnt[at:at + len(some)].tolist()]
                found[held].append(self._distinct(*(np.concatenate([x[c] for x, c in zip(xs, cut)]) for xs in zip(*some))))
            at += len(some)
        for parts in found:
            *events, inverse = parts[0]
            if len(parts) > 1:
                *events, again = self._distinct(*(np.concatenate(x) for x in [*zip(*parts)][:4]))
                begin = np.cumsum([0, *(len(x[0]) for x in parts)])
                inverse = np.concatenate([again[x[4] + i] for x, i in zip(parts, begin.tolist())])
            self._sides.append((*events, inverse))

    @staticmethod
    def _distinct(one: np.ndarray, two: np.ndarray, symbol: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each event once, how often it occurred, and where given ones are, in an order that depends on the events alone."""
        order = np.argsort(_mixed(one, two, symbol))
        new, inverse = _runs_of([one, two, symbol], order)
        there = order[new]
        often = np.add.reduceat(times[order], new, dtype=np.int64) if len(new) else times.astype(np.int64)
        return one[there], two[there], symbol[there], often, inverse

    def scored(self, letters: bool):
        """Per row the log10 probability of its events; whether each is an escape, and the symbols that never are. Letters
        are coded all, of words the end and those that the bucket's training events hold at least twice."""
        (*_, s, n, _), (*_, other, _, _) = self._sides
        symbols, place = np.unique(np.concatenate([s, other]), return_inverse=True)
        count = np.bincount(place[:len(s)], n, minlength=len(symbols)).astype(np.int64)
        if letters:
            coded, code = np.ones(len(symbols), bool), Code(np.bincount(s, n, minlength=256).astype(np.int64) + 1)
            number = symbols
        else:
            # Symbol 0 is a text's end, 1 the escape.
            end = symbols == 0
            coded = (count >= 2) & ~end
            code = Code(np.concatenate([[count[end].sum() + 1, count[~coded & ~end].sum() + 1], count[coded]]))
            number = np.where(coded, np.cumsum(coded) + 1, 1)
            number[end], coded = 0, coded | end
        out, escaped = [], []
        place = np.split(place, [len(s)])
        mixer = None
        for held, (one, two, _, often, inverse) in enumerate(self._sides):
            contexts = lambda a, b, one=one, two=two: [_mixed(one[a:b]), _mixed(one[a:b], two[a:b])]
            if not mixer:
                mixer = Mixer(code, number[place[held]], contexts, often)
                # Few events are learnt from several times before they are scored.
                for _ in range(min(_UPDATES, _UPDATES * _BLOCK // max(1, len(often)))):
                    mixer.run(number[place[held]], contexts, True, True)
                    mixer.curve[:] = 0
            out.append(mixer.run(number[place[held]], contexts, not held, not held).astype(np.float32)[inverse])
            escaped.append(~coded[place[held]][inverse])
        self.used = mixer.used
        cuts = [np.cumsum(self._learnt)[:-1], np.cumsum(self._sizes - self._learnt)[:-1]]
        by_row = [zip(*(np.split(x[held], cuts[held]) for held in range(2))) for x in (out, escaped)]
        return [(np.concatenate(x), np.concatenate(e)) for x, e in zip(*by_row)], symbols[coded]


class Part:
    """Some texts, their words' numbers and counts in the whole corpus, and their events."""

    def __init__(self, rows: list[tuple], ends: int):
        rows = sorted(rows, key=lambda r: r[1:3])
        tokens, texts, self.bytes, place = (unpack(x) for x in rows[0][4:8])
        self.tokens, self.sizes, self.held = tokens.astype(np.int32), texts >> 1, (texts & 1).astype(bool)
        # Words came back by their place; the end of a text is word 0.
        back = np.empty(len(place), np.int64)
        back[np.argsort(place, kind="stable")] = np.arange(len(place))
        self.words = np.append(np.uint32(0), _narrow(_unpacked([r[4] for r in rows[1:]])[back]))
        self.counts = np.append(ends, _unpacked([r[5] for r in rows[1:]])[back])
        self.spelt = np.append(np.float32(0), _unpacked([r[6] for r in rows[1:]], np.float32)[back])
        self.held_tokens = np.repeat(self.held, self.sizes + 1)

    def events(self, limit: int, buckets: int) -> Events:
        """Dealt by the word before; after words that occur more than ``limit`` times by the one before that as well."""
        one, two = np.zeros((2, len(self.tokens)), np.int32)
        one[1:], two[2:] = self.tokens[:-1], self.tokens[:-2]
        two[one == 0] = 0
        cut = -(-self.counts // limit)
        hashes = _mixed(self.words)
        h = hashes[one]
        which = np.flatnonzero(cut[one] > 1)
        share = (hashes[two[which]] >> np.uint64(32)) % cut[one[which]].astype(np.uint64)
        h[which] = _mixed(self.words[one[which]], share)
        return Events(self.words[one], self.words[two], self.words[self.tokens], self.held_tokens, _dealt(h, buckets))


def part_rows(shard: Shard, part: int, places: int) -> list[tuple]:
    """(part, 0, 0, number of tokens to learn from, tokens, twice the words of each text and 1 if it is held out, its bytes,
    the places of words, ids), and (place, 1, part, 0, words, their lengths, how often to learn from, null, null) for each place of words."""
    shard.number()
    # Frequent words get small numbers, so that tokens are told in few bytes.
    order = np.argsort(-np.bincount(shard.found, minlength=len(shard.words)), kind="stable")
    words, now = shard.words.take(pa.array(order)), np.empty(len(order), np.int32)
    now[order] = np.arange(len(order))
    found, learnt, place = now[shard.found], np.repeat(~shard.held, shard.sizes), word_places(words, places)
    counts = np.bincount(found[learnt], minlength=len(words))
    tokens = np.insert(found + np.int32(1), np.cumsum(shard.sizes), 0)
    packed = [pack(x) for x in (tokens, shard.sizes * 2 + shard.held, shard.bytes, place)]
    rows = [(part, 0, 0, int(learnt.sum() + (~shard.held).sum()), *packed, shard.ids)]
    order = np.argsort(place, kind="stable")
    words, place, counts = words.take(pa.array(order)), place[order], counts[order]
    letters, ends = _bytes_of(words)
    for at in np.unique(place).tolist():
        i, j = np.searchsorted(place, [at, at + 1])
        rows.append((at, 1, part, 0, pack(letters[ends[i]:ends[j]]), pack(np.diff(ends[i:j + 1])), pack(counts[i:j]), None, None))
    return rows


def _spelling(words: pa.Array, known: int, buckets: int) -> tuple[Events, np.ndarray]:
    """The letters of words, the first ``known`` of which are learnt from, and where each word begins."""
    letters, ends = _bytes_of(pc.binary_join_element_wise(words, b"", bytes([_END])))
    one, two, three = (x.astype(np.int64) for x in _letters_before(letters, 0, len(letters)))
    first = one | two << 8
    return Events(first, three, letters.astype(np.int64), np.arange(len(letters)) >= ends[known], _dealt(_mixed(first), buckets)), ends[:-1]


def vocabulary_rows(place: int, rows: list[tuple], places: int, head: float, letter_buckets: int):
    """Numbers and counts the distinct words of one place. (place, 1, 0, how many are learnt from, words by falling count,
    their lengths, their counts, null), (place, 3, part, 0, numbers of a part's words there, null, null, null), the events
    of their letters with kind 4 in place of 0, and (place, 5, 0, how many are learnt from, frequent words, counts, ..)."""
    runs = [_words_of(r[4], r[5]) for r in rows]
    words, found = numbered(runs)
    counts = np.bincount(found, _unpacked([r[6] for r in rows]), minlength=len(words)).astype(np.int64)
    order = pc.sort_indices(pa.table({"n": counts, "w": words}), sort_keys=[("n", "descending"), ("w", "ascending")]).to_numpy()
    words, counts, rank = words.take(pa.array(order)), counts[order], np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = 0
    for row, run in zip(rows, runs):
        yield place, 3, row[2], 0, pack(rank[found[at:at + len(run)]]), None, None, None
        at += len(run)
    letters, ends = _bytes_of(words)
    known, often = int(np.count_nonzero(counts)), int(np.count_nonzero((counts >= head) & (counts > 0)))
    yield place, 1, 0, known, pack(letters), pack(np.diff(ends)), pack(counts), None
    yield place, 5, 0, known, pack(1 + np.arange(often) * places + place), pack(counts[:often]), None, None
    for bucket, _, *rest in _spelling(words, known, letter_buckets)[0].rows(place):
        yield bucket, 4, *rest


def spelling_rows(place: int, rows: list[tuple], places: int, letter_buckets: int):
    """(part, 1, place, 0, words, counts, log10 probabilities of their letters, null) for each part's words at the place."""
    (*_, known, data, size, counts, _), rows = rows[0], rows[1:]
    words, counts = _words_of(data, size), unpack(counts)
    events, begin = _spelling(words, known, letter_buckets)
    each = _unpacked([r[4] for r in rows if r[1] == 2], np.float32).astype(float)
    spelt = np.add.reduceat(each[events.inverse], begin).astype(np.float32)
    for r in rows:
        if r[1] == 3:
            rank = unpack(r[4])
            yield r[2], 1, place, 0, pack(1 + rank * places + place), pack(counts[rank]), pack(spelt[rank]), None


def bucket_rows(bucket: int, rows: list[tuple], letters: bool, total: int = 0, head: tuple | None = None):
    """(source, 2, bucket, how many tokens of the corpus the bucket leaves to escapes, or more, scores, whether each is an
    escape, null, null) for each source."""
    found, coded = Bucket(rows).scored(letters)
    escapes = 0
    if head:
        numbers, counts = head
        escapes = max(1, total - int(counts[np.isin(numbers, coded)].sum()))
    for r, (scores, escaped) in zip(rows, found):
        yield r[2], 2, bucket, escapes, pack(scores), pack(escaped), None, None


def text_rows(left: list[tuple], right: list[tuple], ends: int, limit: int, buckets: int, below: float):
    """Per text of a part: held out, number of tokens and of known ones, base score, score, bytes."""
    part, right = Part(left, ends), sorted(right, key=lambda r: r[2])
    inverse = part.events(limit, buckets).inverse
    scores, escaped = [unpack(r[4], np.float32) for r in right], [unpack(r[5]).astype(bool) for r in right]
    escapes = np.repeat([float(r[3]) for r in right], [len(x) for x in scores])[inverse]
    scores, escaped = np.concatenate(scores).astype(float)[inverse], np.concatenate(escaped)[inverse]
    which = np.flatnonzero(escaped)
    word = part.tokens[which]
    share = np.maximum(part.counts[word] - ~part.held_tokens[which], 0) / escapes[which] / 2
    with np.errstate(divide="ignore"):
        scores[which] += _log10_sum(np.log10(share), part.spelt[word].astype(float) - math.log10(2))
    base = np.log10(part.counts + 0.1) - below
    begin = np.cumsum(part.sizes + 1) - part.sizes - 1
    add = lambda x: np.add.reduceat(x, begin)
    known = add((part.counts > 0)[part.tokens].astype(np.int64))
    return part.held, part.sizes + 1, known, add(base[part.tokens]), add(scores), part.bytes


_ROW = "dest long, kind int, source long, n long, a binary, b binary, c binary, d binary"


def _in_groups(rows: DataFrame, n: int, solve) -> DataFrame:
    """What ``solve`` gives for the rows of each ``dest``, sorted by kind and source, ``n`` partitions of them."""
    def solved(batches):
        now, group = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in batch.columns[:8])
                if row[0] != now and group:
                    yield from packed(solve(now, group))
                    group = []
                now = row[0]
                group.append(row)
        if group:
            yield from packed(solve(now, group))

    def packed(found):
        found = iter(found)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        while some := [*islice(found, 200)]:
            columns = [pa.array(x, k) for x, k in zip(zip(*some), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["dest", "kind", "source", "n", "a", "b", "c", "d"])
        some = found = None
        pa.default_memory_pool().release_unused()

    return rows.repartition(n, "dest").sortWithinPartitions("dest", "kind", "source").mapInArrow(solved, _ROW)


def tokenized(docs: DataFrame, id_col: str, text_col: str, held: Column, part_bytes: int, places: int) -> DataFrame:
    """``part_rows`` of parts of some ``part_bytes`` of text; a text is in one part."""
    kind = docs.schema[id_col].dataType

    def parts(batches):
        from pyspark import TaskContext

        from daybook.llm import mixing as own

        part, shard, size, ids = TaskContext.get().partitionId() << 32, own.Shard(), 0, None
        for batch in batches:
            ids, texts = batch.column(0), batch.column(2)
            out = batch.column(1).to_numpy(zero_copy_only=False)
            sums = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
            at = 0
            while at < len(texts):
                before = int(sums[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(sums, before + part_bytes - size, side="right")))
                shard.add(ids.slice(at, stop - at).to_pylist(), out[at:stop], texts.slice(at, stop - at))
                size, at = size + int(sums[stop - 1]) - before, stop
                if at < len(texts) or size >= part_bytes:
                    yield from packed(own.part_rows(shard, part, places), ids.type)
                    part, shard, size = part + 1, own.Shard(), 0
        if shard.ids:
            yield from packed(own.part_rows(shard, part, places), ids.type)

    def packed(found, of):
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.list_(of)]
        columns = [pa.array(x, k) for x, k in zip(zip(*found), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["dest", "kind", "source", "n", "a", "b", "c", "d", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), held.alias("held"), F.col(text_col).alias("text"))
    return rows.mapInArrow(parts, f"{_ROW}, ids array<{kind.simpleString()}>")


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10,
                          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of each row's whole text.

    A text is its words and one end. ``base_score`` is the unigram model with 0.1 added to each count. Null and empty
    texts are an end alone. Without any text to learn from, bits are equally odd at first. Repeated rows count each.
    ``shard_bytes`` is the text whose events one bucket, and so one task, holds, about; a text is in one task.
    """
    spark = docs.sparkSession
    ship(spark)
    kind, held = docs.schema[id_col].dataType.simpleString(), is_held_out(id_col, folds)
    ends, size = docs.agg(F.count_if(~held), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    buckets, places = max(1, math.ceil(size / shard_bytes)), max(1, math.ceil(size / shard_bytes / 4))
    letter_buckets = max(1, places // 2)
    texts = written(tokenized(docs, id_col, text_col, held, 3 * shard_bytes, places), "mixing-texts")
    n_parts, total = texts.filter("kind = 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    limit = max(1, math.ceil(total / buckets / 4))

    def words_of(place, rows):
        from daybook.llm import mixing as own

        return own.vocabulary_rows(place, rows, places, total / HEAD, letter_buckets)

    def letters_of(bucket, rows):
        from daybook.llm import mixing as own

        return own.bucket_rows(bucket, rows, True)

    def spelt(place, rows):
        from daybook.llm import mixing as own

        return own.spelling_rows(place, rows, places, letter_buckets)

    def dealt(part, rows):
        from daybook.llm import mixing as own

        return own.Part(rows, ends).events(limit, buckets).rows(part)

    def scored(bucket, rows):
        from daybook.llm import mixing as own

        return own.bucket_rows(bucket, rows, False, total, head.value)

    def summed(left, right):
        from daybook.llm import mixing as own

        rows = [[*zip(*[c.to_pylist() for c in x.columns[:8]])] for x in (left, right)]
        held, *found = own.text_rows(*rows, ends, limit, buckets, below)
        first = left.filter(pc.equal(left["kind"], 0))["ids"].combine_chunks()
        return pa.table([first.flatten(), pa.array(held), *map(pa.array, found)],
                        names=["id", "held", "n_tokens", "n_known", "base", "score", "bytes"])

    of = texts.columns[:8]
    words = written(_in_groups(texts.filter("kind = 1").select(of), places, words_of), "mixing-words")
    # Frequent words, HEAD at most, as their counts add up to no more than the total.
    frequent = words.filter("kind = 5").select("n", "a", "b").collect()
    distinct = sum(r.n for r in frequent) + (ends > 0)
    numbers, counts = np.append(0, _unpacked([r.a for r in frequent])), np.append(ends, _unpacked([r.b for r in frequent]))
    head = spark.sparkContext.broadcast((numbers, counts))
    below = math.log10(total + 0.1 * (distinct + 1))
    letters = _in_groups(words.filter("kind = 4"), letter_buckets, letters_of)
    of_words = _in_groups(words.filter("kind in (1, 3)").unionByName(letters), places, spelt)
    parts = texts.filter("kind = 0").unionByName(of_words, allowMissingColumns=True).repartition(max(1, n_parts), "dest")
    events = _in_groups(parts, max(1, n_parts), dealt)
    found = _in_groups(events, buckets, scored).repartition(max(1, n_parts), "dest")
    every = parts.groupBy("dest").cogroup(found.groupBy("dest")).applyInArrow(
        summed, f"id {kind}, held boolean, n_tokens long, n_known long, base double, score double, bytes long")
    return every.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
        (-F.col("score") * math.log2(10) / (F.col("bytes") + 1)).alias("bits_per_byte"))
