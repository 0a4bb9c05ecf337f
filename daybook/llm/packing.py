"""Packing token pieces into sequences, best fit decreasing.

Documents are cut into full windows and a rest. Rests are dealt into shards by hash, a shard's pieces are taken from
the longest to the shortest, and each goes to the open window that it fills best, found in a segment tree over the
remaining capacities. A shard holds one number per open window, and leaves a few windows open at its end whatever its
size, so shards of a fixed number of pieces keep the padding low at any size of the corpus.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import ship, written


def cut_pieces(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int | None = 2, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): the pieces of each row's whole text.

    A text's ids, then ``end_id``, are cut every ``window`` ids. ``ids`` are little-endian unsigned 32-bit integers.
    Null counts as empty: only the end. Without an end, empty texts have no piece.
    """
    ship(docs.sparkSession)
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def pieces(batches):
        from daybook.llm.tokens import encoder, in_slices

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, part in in_slices(texts):
                rows = []
                for i, ids in enumerate(encoder(vocabulary).encode(part), at):
                    ids += end
                    for start in range(0, len(ids), 4 * window):
                        own = ids[start:start + 4 * window]
                        rows.append((i, start // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4, own if with_ids else None))
                which, *columns = [list(c) for c in zip(*rows)] or [[]] * 6
                out = [batch.column(0).take(pa.array(which, pa.int64())), *[pa.array(c, pa.int64()) for c in columns[:4]]]
                if with_ids:
                    out.append(pa.array(columns[4], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    cut = docs.select(id_col, text_col).mapInArrow(pieces, schema + ", ids binary" * with_ids)
    return cut.withColumnRenamed("id", id_col)


class Tightest:
    """Open windows by remaining capacity: a segment tree over 0..window that counts the windows below each node."""

    def __init__(self, window: int):
        self._base = 1 << window.bit_length()
        self._count = [0] * (2 * self._base)
        self._open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, which: int) -> None:
        self._open[capacity].append(which)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        node = self._base + capacity
        while node:
            self._count[node] += n
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The (capacity, window) of the smallest capacity of at least ``length``, taken out; None if there is none."""
        count, node = self._count, self._base + length
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._base:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self._base
        self._add(capacity, -1)
        return capacity, self._open[capacity].pop()


def _best_fit(window: int):
    """Arrow batches sorted by shard and falling length, with the sequence and offset of each piece."""

    def fit(batches):
        shard, tree, opened = None, None, 0
        for batch in batches:
            sequences, offsets = [], []
            for own, length in zip(batch.column("_shard").to_pylist(), batch.column("length").to_pylist()):
                if own != shard:
                    shard, tree, opened = own, Tightest(window), 0
                capacity, which = tree.take(length) or (window, opened)
                if capacity == window:
                    opened += 1
                if capacity > length:
                    tree.put(capacity - length, which)
                sequences.append(own << 32 | which)
                offsets.append(window - capacity)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                                             names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return fit


def pack(pieces: DataFrame, key: list[str], window: int = 4096, per_shard: int = 50_000) -> DataFrame:
    """``pieces`` (a written table with ``length``) with ``sequence_id`` and ``offset``.

    ``key`` names the columns that tell pieces apart; they deal pieces to shards and order equal lengths, so a task
    that runs again gives the same sequences. Repeated rows are packed one by one. Lengths are 1 to ``window``.
    """
    ship(pieces.sparkSession)
    shards = max(1, -(-pieces.count() // per_shard))
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(*key), F.lit(shards)))
    ordered = dealt.repartition(shards, "_shard").sortWithinPartitions("_shard", F.desc("length"), *key)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ordered.mapInArrow(_best_fit(window), schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int | None = 2,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of ``cut_pieces`` with their places. An empty table gives an empty result."""
    pieces = written(cut_pieces(docs, vocabulary, window, end_id, id_col, text_col, with_ids), "packing-pieces")
    return pack(pieces, [id_col, "start", "ids_crc32"], window)


def sequences(packed: DataFrame, window: int = 4096, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): pieces packed ``with_ids`` joined in order and padded, unless their length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_p")).withColumn(
        "_ids", F.expr("aggregate(_p, x'', (a, p) -> concat(a, p.ids))"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    full = F.expr("bit_count(n_tokens)") == 1
    short = F.when(full, F.lit(0)).otherwise(window - F.col("n_tokens")).cast("int")
    return whole.select("sequence_id", "n_tokens", F.concat("_ids", F.unhex(F.repeat(F.hex(pad), short))).alias("ids"))
