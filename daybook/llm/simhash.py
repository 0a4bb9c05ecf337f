"""Near duplicates by SimHash and covering locality-sensitive hashing.

A document's fingerprint is the bitwise majority of its shingles' hashes. Fingerprints are linked if they differ in
``radius`` bits at most. A covering code gives ``2 ** (radius + 1) - 1`` masks such that for any set of ``radius`` bits
some mask avoids all of them: two fingerprints within the radius agree under that mask, so no link is missed.

Copies are collapsed to one row per fingerprint before anything is compared. A bucket (a mask and the bits under it) of
many fingerprints is not compared pairwise: its members are dealt out again by a covering code of the bits that its
mask leaves free, until buckets are small; with eight free bits a bucket has 256 fingerprints at most. A bucket gives
one link per member, a spanning forest of its pairs within the radius, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import TOKEN, grams, repeated, whole, words, written

BITS = 64
_PAIRS = 0x0000000100000001


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fingerprint long, n_rows) per document: bit i is set if over half of the shingles' XXH64 (seed 42) have it.

    Shingles are ``width`` words with repeats; a shorter text is one shingle, an empty or null one has fingerprint 0.
    Rows that repeat both the id and the text are one document, of ``n_rows`` rows.
    """
    size = F.size("_words")
    shingles = F.when((size > 0) & (size < width), F.array(F.concat_ws(" ", "_words"))).otherwise(grams("_words", width))
    rows = (
        docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
        .select("_id", F.xxhash64("_text").alias("_row"), words(F.col("_text"), TOKEN).alias("_words"))
        .select("_id", "_row", F.posexplode_outer(shingles).alias("_pos", "_gram"))
        .select("_id", "_row", "_pos", F.when(F.col("_gram").isNotNull(), F.xxhash64("_gram")).alias("_hash"))
    )
    # One sum counts bit i in its low half and bit i + 32 in its high half.
    counts = [F.sum(F.shiftright("_hash", i).bitwiseAND(F.lit(_PAIRS))).alias(f"_b{i}") for i in range(BITS // 2)]
    starts = F.count_if(F.coalesce("_pos", F.lit(0)) == 0).alias("n_rows")
    summed = rows.groupBy("_id", "_row").agg(F.count("_hash").alias("_n"), starts, *counts)
    value: Column = F.lit(0).cast("long")
    for i in range(BITS):
        count = F.col(f"_b{i % 32}").bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftright(f"_b{i % 32}", 32)
        value = value.bitwiseOR(F.when(count * 2 > F.col("_n"), F.lit(_signed(1 << i))).otherwise(F.lit(0).cast("long")))
    return summed.select(F.col("_id").alias(id_col), value.alias("fingerprint"), "n_rows")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """``2 ** (radius + 1) - 1`` masks; any ``radius`` of the given bits are outside at least one of them.

    Bit number i has the vector (i mod (2 ** (radius + 1) - 1)) + 1 of ``radius + 1`` bits; a mask holds the bits whose
    vector is not orthogonal to its own. ``radius`` vectors never span the space, so some vector is orthogonal to all.
    """
    n = (1 << (radius + 1)) - 1
    return [sum(1 << b for i, b in enumerate(bits) if ((i % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def _finer(paths: dict[int, int], radius: int) -> list[tuple[int, int, int]]:
    """(path, child path, the child's mask) for each covering mask of the bits that a path's mask leaves free."""
    out = []
    for path, mask in paths.items():
        free = [b for b in range(BITS) if not mask >> b & 1]
        for k, extra in enumerate(covering_masks(free, radius)):
            out.append((path, path * (1 << (radius + 1)) + k + 1, mask | extra))
    return out


def _forests(radius: int):
    """Arrow batches of fingerprint arrays to (a, b): each member that has a link, and the smallest it is joined to."""

    def spanning(batches):
        for batch in batches:
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            two = np.flatnonzero(np.diff(ends) == 2)
            a, b = flat[ends[two]], flat[ends[two] + 1]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
            left.append(np.maximum(a, b)[near])
            right.append(np.minimum(a, b)[near])
            for i in np.flatnonzero(np.diff(ends) > 2):
                own = np.sort(flat[ends[i]:ends[i + 1]])
                linked = np.bitwise_count((own[:, None] ^ own[None, :]).view(np.uint64)) <= radius
                label = np.arange(len(own))
                while True:
                    lowest = np.where(linked, label[None, :], len(own)).min(axis=1)
                    lowest = lowest[lowest]
                    if (lowest == label).all():
                        break
                    label = lowest
                joined = label != np.arange(len(own))
                left.append(own[joined])
                right.append(own[label[joined]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return spanning


def _dealt(members: DataFrame, table: list[tuple[int, int, int]]) -> DataFrame:
    """(path, key, fingerprint) of each member under each mask of its path."""
    if len({p for p, _, _ in table}) == 1:
        # All members are on the first path: its masks are written out by each row.
        masks = F.explode(F.array(*[F.struct(F.lit(c).cast("long").alias("child"), F.lit(_signed(m)).cast("long").alias("mask")) for _, c, m in table]))
        dealt = members.select("fingerprint", masks.alias("_m")).select("fingerprint", "_m.child", "_m.mask")
    else:
        # 225 or 3,375 rows.
        masks = members.sparkSession.createDataFrame([(p, c, _signed(m)) for p, c, m in table], "path long, child long, mask long")
        dealt = members.join(F.broadcast(masks), "path")
    return dealt.select(F.col("child").alias("path"), F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"), "fingerprint")


def links(prints: DataFrame, radius: int = 3, bucket: int = 256) -> DataFrame:
    """(a, b), a > b: links between distinct fingerprints that join the same ones as all pairs within ``radius``.

    ``bucket`` is the number of fingerprints that one task compares at once, 256 at least; larger buckets are dealt out
    again, three times at most: then seven bits are free.
    """
    bucket = max(bucket, 256)
    out = None
    paths, members = {0: 0}, prints.select(F.lit(0).cast("long").alias("path"), "fingerprint").distinct()
    while True:
        table = _finer(paths, radius)
        dealt = _dealt(members, table)
        shared = dealt.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = written(dealt.join(shared, ["path", "key"]), "simhash-buckets")
        small = shared.filter(F.col("n") <= bucket).groupBy("path", "key").agg(F.collect_list("fingerprint").alias("all"))
        found = small.select("all").mapInArrow(_forests(radius), "a long, b long")
        out = found if out is None else out.unionByName(found)
        large = shared.filter(F.col("n") > bucket)
        if large.isEmpty():
            return out.distinct()
        paths = {c: m for _, c, m in table}
        members = large.select("path", "fingerprint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each end of an edge the smallest node that it is connected to, by large and small stars."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        seen = both.join(lowest, "a")
        up = seen.filter("b > a").select("b", "m") if large else seen.select("b", "m").unionByName(lowest.select(F.col("a").alias("b"), "m"))
        return up.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    before, now = None, written(edges.select("a", "b"), "simhash-links")
    while True:
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, now = after, written(star(star(now, True), False), "simhash-stars")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 3, bucket: int = 256) -> DataFrame:
    """(id, fingerprint long, component) per row: the smallest id that its fingerprint links to, itself included.

    Empty texts share fingerprint 0 and are linked like any others. A null id is never the smallest; a component of
    null ids alone has none. An empty table gives an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    classes = written(prints.groupBy("fingerprint").agg(F.min(id_col).alias("_least")), "simhash-classes")
    found = components(links(classes, radius, bucket))
    rooted = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component"))
    named = written(rooted.join(least, "_root").select("fingerprint", "component"), "simhash-components")
    return repeated(prints.join(named, "fingerprint").select(id_col, "fingerprint", "component", "n_rows"), "n_rows")


def as_hex(fingerprint: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))
