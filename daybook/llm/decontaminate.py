"""Benchmark decontamination by a distributed positional inverted index.

The index is a table of segments. A segment holds the postings of every word of some 260,000 words of whole documents,
whatever the benchmark: its words, and for each the ascending places where it stands. It is built where the documents
are read, without a shuffle, and can be searched for any later benchmark. A search takes each test window's words from
the rarest of the segment on, intersects their lists, each shifted by the word's place in the window, and stops as soon
as nothing is left; windows with a word that the segment lacks are not looked at. Test items are taken in blocks of a
fixed number of words, so what is broadcast has a bound whatever the benchmark.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import LOWER, UPPER, folder, ship

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPANS = "array<struct<start: long, stop: long>>"


def split_words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z in lower case; of UTF-8 these are whole characters."""
    return _WORD.findall(text.translate(_FOLD))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = 1 << 18) -> DataFrame:
    """The segments of all rows' whole texts, written to the shared folder.

    Null counts as empty; a document is never split over segments, so one that is longer has a segment of its own.
    """
    spark = docs.sparkSession
    ship(spark)

    def segments(batches):
        from pyspark import TaskContext

        from daybook.llm import decontaminate as own

        number = count(TaskContext.get().partitionId() << 32)
        ids, sizes, found = [], [], []
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                words = own.split_words(texts[i].as_py() or b"")
                if found and len(found) + len(words) > segment_words or len(ids) >= 1 << 15:
                    yield own.segment(next(number), ids, sizes, found, kind)
                    ids, sizes, found = [], [], []
                ids.append(batch.column(0)[i].as_py())
                sizes.append(len(words))
                found += words
        if ids:
            yield own.segment(next(number), ids, sizes, found, kind)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[id_col].dataType)
    path = f"{folder(spark)}/index-{uuid.uuid4().hex}"
    schema = (f"segment long, ids array<{docs.schema[id_col].dataType.simpleString()}>, sizes array<long>, "
              "terms binary, first binary, places binary")
    docs.select(id_col, text_col).mapInArrow(segments, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _bases(sizes: np.ndarray) -> np.ndarray:
    """Where documents begin: one place between two documents stays free, so nothing stands across them."""
    return np.concatenate([[0], np.cumsum(sizes + 1)])


def segment(number: int, ids: list, sizes: list[int], words: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
    """One segment: its words, where each one's list begins, and all lists, each as gaps between places."""
    numbers: dict[bytes, int] = {}
    term = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
    place = np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(term, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(numbers)))]).astype(np.int32)
    gaps = np.diff(place[order], prepend=0).astype(np.int32)
    columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())),
               *[pa.array([b], pa.binary()) for b in (b" ".join(numbers), first.tobytes(), gaps.tobytes())]]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "ids", "sizes", "terms", "first", "places"])


class Windows:
    """The windows of a block of test items: ``width`` words each, or all of a shorter item's; equal ones are one."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.items = [i for i, _ in items]
        self.terms: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for n, (_, text) in enumerate(items):
            words = [self.terms.setdefault(w, len(self.terms)) for w in split_words((text or "").encode())]
            for at in range(max(1, len(words) - width + 1)) if words else ():
                owners.setdefault(tuple(words[at:at + width]), set()).add(n)
        self.owners = [sorted(v) for v in owners.values()]
        self.sizes = np.array([len(w) for w in owners], np.int64)
        self.words = np.full((len(owners), width), -1, np.int32)
        for i, w in enumerate(owners):
            self.words[i, :len(w)] = w

    def search(self, ids, sizes, terms, first, places, slack: int):
        """For a segment: per document the merged places that windows cover, and the items of those windows."""
        bases = _bases(sizes)
        covered, met = np.zeros(bases[-1] + 1, np.int64), [set() for _ in ids]
        known = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
        local = np.array([*(known.get(t, -1) for t in self.terms), 0])
        number = np.where(local >= 0, first[local + 1] - first[local], 0) if known else np.zeros(len(local), np.int64)
        number[-1] = np.iinfo(np.int64).max  # beyond a shorter window's end
        lists = np.cumsum(places) if len(places) else places
        for i in np.flatnonzero(number[self.words].min(axis=1) > 0) if len(self.words) else ():
            own = self.words[i, :self.sizes[i]]
            rank = np.argsort(number[own], kind="stable")
            starts = None
            for k in rank:
                term = local[own[k]]
                stands = lists[first[term]:first[term + 1]] - k
                if starts is None:
                    starts = stands
                else:
                    at = np.searchsorted(stands, starts - slack)
                    starts = starts[(at < len(stands)) & (stands[np.minimum(at, len(stands) - 1)] <= starts + slack)]
                if not len(starts):
                    break
            # With slack, a window may reach over the ends of its document.
            doc = np.searchsorted(bases, np.maximum(starts, 0) + own.size // 2, "right") - 1
            low, high = np.maximum(starts, bases[doc]), np.minimum(starts + own.size, bases[doc + 1] - 1)
            np.add.at(covered, low, 1)
            np.add.at(covered, high, -1)
            for d in set(doc.tolist()):
                met[d].update(self.owners[i])
        inside = np.concatenate([[0], (np.cumsum(covered[:-1]) > 0).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(inside))
        return bases, edges[::2], edges[1::2], met


_BUILT: dict[tuple, Windows] = {}


def built(items: list, key: tuple, width: int) -> Windows:
    """The windows of a block of items, made once by each worker, which holds one block's at a time."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Windows(items, width)
    return _BUILT[key]


def _blocks(items: DataFrame, id_col: str, text_col: str, words: int) -> Iterator[list[tuple[object, str | None]]]:
    block, size = [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "") // 2 + 1  # two characters a word at least, with what parts it from the next
        if size >= words:
            yield block
            block, size = [], 0
    yield block


def search(index: DataFrame, items: DataFrame, width: int = 13, slack: int = 0, id_col: str = "item_id",
           text_col: str = "text", block_words: int = 1_000_000) -> DataFrame:
    """(id, n_words, spans, items) of each document: merged places [start, stop) in words, and the items met there.

    A window is met where its words stand one after the other; with ``slack``, where each word stands at most that many
    words from its place as the rarest one gives it. A shorter item is one window, one without words is none. More than
    ``block_words`` words of items are searched for in several passes, whose results are merged; the driver hands on the
    texts of one block at a time, and workers make its windows. Rows of the same id are
    one item; an item without an id has spans but is not listed.
    """
    spark = index.sparkSession
    ship(spark)
    kinds = index.schema["ids"].dataType.elementType, items.schema[id_col].dataType
    schema = f"segment long, nth long, id {kinds[0].simpleString()}, n_words long, spans {_SPANS}, items array<{kinds[1].simpleString()}>"
    found = None
    for block in _blocks(items, id_col, text_col, block_words):
        shared, key = spark.sparkContext.broadcast(block), (uuid.uuid4().hex, width)

        def searched(batches, shared=shared, key=key):
            from daybook.llm import decontaminate as own

            windows = own.built(shared.value, key, width)
            for batch in batches:
                for row in batch.to_pylist():
                    parts = [np.frombuffer(row[c], np.int32).astype(np.int64) for c in ("first", "places")]
                    sizes = np.array(row["sizes"], np.int64)
                    bases, low, high, met = windows.search(row["ids"], sizes, row["terms"], *parts, slack)
                    spans = [[] for _ in row["ids"]]
                    for d, a, b in zip((np.searchsorted(bases, low, "right") - 1).tolist(), low.tolist(), high.tolist()):
                        spans[d].append({"start": a - int(bases[d]), "stop": b - int(bases[d])})
                    n = len(sizes)
                    items = [[windows.items[i] for i in sorted(m)] for m in met]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(([row["segment"]] * n, range(n), row["ids"], row["sizes"], spans, items), types)],
                        names=["segment", "nth", "id", "n_words", "spans", "items"])

        from pyspark.sql.pandas.types import to_arrow_type

        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        types = [pa.int64(), pa.int64(), to_arrow_type(kinds[0]), pa.int64(), span, pa.list_(to_arrow_type(kinds[1]))]
        part = index.mapInArrow(searched, schema)
        found = (part, False) if found is None else (found[0].unionByName(part), True)
    rows, several = found
    if several:
        rows = rows.groupBy("segment", "nth", "id", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        rows = rows.withColumn("spans", merged("spans"))
    return rows.select("id", "n_words", "spans", F.array_distinct(F.array_compact("items")).alias("items"))


def merged(spans: str) -> Column:
    """Overlapping and touching spans joined, in order."""
    return F.expr(f"""aggregate(array_sort({spans}), cast(array() as {_SPANS}), (a, s) -> if(
        size(a) > 0 and s.start <= element_at(a, -1).stop,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start,
            'stop', greatest(element_at(a, -1).stop, s.stop)))),
        concat(a, array(s))))""")


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, share: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items, contaminated) per row: a document is contaminated if one word in ``share`` or more is hit.

    Null and empty texts have no words and are never contaminated; an empty benchmark hits nothing.
    """
    found = search(build_index(docs, id_col, text_col), items, width, id_col=item_col, text_col=item_text)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    return found.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
