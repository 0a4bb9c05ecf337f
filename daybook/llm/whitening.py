"""Whitening of embeddings from the covariance of distinct vectors.

Entries become whole numbers, so equal vectors are equal exactly. Identical vectors are grouped once, with their number
of rows; every later step works on the distinct ones, weighted by that number or by one. Sums are exact integers. The
covariance is a weighted product of centred matrices, a block of vectors at a time and one matrix per task, added up
by Spark; each distinct vector is then whitened once, and rows get theirs back by a digest of the vector. Vectors that
many rows share are broadcast, as there are few of them; the others are joined by a shuffle, where none is hot.

Vectors of different lengths are different spaces and are fitted and whitened by themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import ship, spread, written

#: A vector of at least 1 / ``HEAD`` of all rows is broadcast; there are ``HEAD`` of them at most.
HEAD = 2_000
_MOST = (1 << 63) - 1


def whole_entries(vector: str | Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """Each entry c as the long floor(``scale`` * c) + ``shift``; products beyond a long's range are its nearest ends."""
    column = F.col(vector) if isinstance(vector, str) else vector
    bound = _MOST - shift
    return F.transform(column, lambda c: F.least(F.floor(c.cast("double") * scale), F.lit(bound)) + shift)


def usable(vector: str | Column) -> Column:
    """Whether the vector and all its entries are there and finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    fine = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.forall(column, fine), F.lit(False))


def _matrix(lists: pa.ListArray, kind=np.int64) -> np.ndarray:
    """Lists of one length as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(lists), -1)


def _by_size(batch):
    """(length, positions) of the batch's lists of each length."""
    sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), pa.array(np.flatnonzero(sizes == size))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, n_rows, key) of rows with ``x``: each distinct vector once."""
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("key", _key("x"))


def _key(x: str) -> Column:
    return F.unhex(F.sha2(F.array_join(x, ","), 256))


def exact_sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length of vectors the total weight and the weighted sums of each dimension. A number per dimension reaches the driver."""
    def summed(batches):
        from daybook.llm import whitening as own

        totals: dict[int, list[int]] = {}
        for batch in batches:
            for size, places in own._by_size(batch):
                x, w = own._matrix(batch.column(0).take(places)), batch.column(1).take(places).to_numpy()
                if max(int(np.abs(x.astype(float)).max(initial=0)), 1) * float(w.sum()) < 2.0 ** 62:
                    found = (x * w[:, None]).sum(axis=0).tolist()
                else:
                    found = (x.astype(object) * w.astype(object)[:, None]).sum(axis=0).tolist()
                total = totals.setdefault(size, [0] * (size + 1))
                totals[size] = [a + b for a, b in zip(total, [int(w.sum()), *found])]
        for size, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(total)), pa.array(range(len(total))), pa.array(map(str, total))], names=["size", "place", "total"])

    parts = distinct.select("x", "weight").mapInArrow(summed, "size long, place long, total string")
    rows = parts.groupBy("size", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("size", "place").collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for size, place, total in rows:
        if place == 0:
            out[size] = int(total), []
        else:
            out[size][1].append(int(total))
    return out


def centre(n: int, sums: list[int]) -> tuple[list[int], np.ndarray]:
    """The mean as a whole number and what is left of it, per dimension."""
    base = [s // n for s in sums]
    return base, np.array([(s - b * n) / n for s, b in zip(sums, base)])


def scatter(vectors: DataFrame, spaces: dict[int, tuple]) -> dict[int, np.ndarray]:
    """Per length the weighted sum of the outer products of centred vectors, of rows (values, weight).

    ``spaces`` gives the centre per length, (whole part, rest). One row of a matrix per task travels at a time; a matrix
    per length reaches the driver."""
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)

    def products(batches):
        from daybook.llm import whitening as own

        totals = {}
        for batch in batches:
            for size, places in own._by_size(batch):
                if size:
                    x = own.centred(batch.column(0).take(places), *shared.value[size])
                    w = batch.column(1).take(places).to_numpy()
                    totals[size] = totals.get(size, 0) + x.T @ (x * w[:, None])
        for size, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * size), pa.array(range(size)), pa.array(list(total))],
                                             names=["size", "line", "part"])

    def added(batches):
        totals = {}
        for batch in batches:
            for size, line, part in zip(*[c.to_pylist() for c in batch.columns]):
                totals[size, line] = totals.get((size, line), 0) + np.array(part)
        sizes, lines = zip(*totals) if totals else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(lines, pa.int64()), pa.array(list(totals.values()), pa.list_(pa.float64()))],
                                         names=["size", "line", "part"])

    schema = "size long, line long, part array<double>"
    lines = vectors.mapInArrow(products, schema)
    out: dict[int, np.ndarray] = {}
    for size, line, part in spread(lines, "size", "line").mapInArrow(added, schema).toLocalIterator():
        out.setdefault(size, np.zeros((size, size)))[line] = part
    return out


def centred(lists: pa.ListArray, base, rest: np.ndarray) -> np.ndarray:
    """Vectors minus a centre; the whole part is taken off in whole numbers, so no digit of a small spread is lost."""
    if pa.types.is_floating(lists.type.value_type):
        return _matrix(lists, np.float64) - base - rest
    x = _matrix(lists)
    if max(abs(b) for b in base) < 1 << 62 and np.abs(x.astype(float)).max(initial=0) < 2.0 ** 62:
        return (x - np.array(base)).astype(np.float64) - rest
    return (x.astype(object) - np.array(base, object)).astype(np.float64) - rest


class Space:
    """What whitens vectors of one length: the exact sums, the centre, and the first components of the covariance."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, most: int):
        self.n, self.sums = n, sums
        self.base, self.rest = centre(n, sums)
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        # Rounding alone leaves values of this size.
        self.used = values[:most] > values[:1].max(initial=0.0) * len(values) * np.finfo(float).eps
        trace = float(np.trace(covariance))
        self.explained = np.maximum(values[:most], 0.0) / trace if trace > 0 else np.zeros(min(most, len(values)))
        self.basis = np.where(self.used, vectors[:, :most] / np.sqrt(np.where(self.used, values[:most], 1.0)), 0.0)


def fit(distinct: DataFrame, most: int = 16) -> dict[int, Space]:
    """The space of each length of vectors in ``distinct`` (x, weight)."""
    sums = exact_sums(distinct)
    centres = {size: centre(n, s) for size, (n, s) in sums.items()}
    products = scatter(distinct.select("x", "weight"), centres)
    return {size: Space(n, s, products[size] / n, most) for size, (n, s) in sums.items() if size}


def whiten(distinct: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """(key, n_rows, weight, size, deviation decimal, whitened): each distinct vector, whitened once."""
    shared = distinct.sparkSession.sparkContext.broadcast(spaces)

    def projected(batches):
        from daybook.llm import whitening as own

        for batch in batches:
            for size, places in own._by_size(batch):
                if not size:
                    continue
                space = shared.value[size]
                part = batch.take(places)
                out = own.centred(part.column(0), space.base, space.rest) @ space.basis
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([size] * len(part)), own.deviations(part.column(0), space.n, space.sums),
                     pa.array(list(out), pa.list_(pa.float64()))],
                    names=["n_rows", "weight", "key", "size", "deviation", "whitened"])

    found = distinct.select("x", "n_rows", "weight", "key").mapInArrow(
        projected, "n_rows long, weight long, key binary, size long, deviation string, whitened array<double>")
    return found.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def deviations(lists: pa.ListArray, n: int, sums: list[int]) -> pa.Array:
    """The exact sum over dimensions of (n * x - sum) ** 2, as text."""
    x = _matrix(lists)
    far = max(np.abs(x.astype(float)).max(initial=0) * n, max(map(abs, sums))) * 2
    if far < 2.0 ** 62 and np.abs(x.astype(float) * n - np.array(sums, float)).max(initial=0) ** 2 * x.shape[1] < 2.0 ** 62:
        return pa.array(map(str, ((x * n - np.array(sums)) ** 2).sum(axis=1).tolist()))
    return pa.array(map(str, ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1).tolist()), pa.string())


def whitened_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
                        scale: int = 64, shift: int = 1_000_000, weigh_rows: bool = False) -> DataFrame:
    """(id, n, deviation decimal, whitened, explained, identity_error) per row with a usable vector.

    A vector's entries become x = floor(``scale`` * c) + ``shift``. ``n`` is the weight of all distinct vectors of a
    length: one each, or with ``weigh_rows`` the number of their rows. ``deviation`` is the exact sum of (n * x - S) ** 2 (null beyond 38 digits),
    ``whitened`` the projections on the first ``components`` unit eigenvectors of the covariance (divisor n), each over
    the root of its eigenvalue, ``explained`` their shares of the variance. ``identity_error`` is the largest absolute
    entry of the covariance of ``whitened`` minus the identity. A component without variance is 0 for every row and is
    left out of the error. Null vectors, those with null or non-finite entries, and empty ones have no row; rows that
    repeat each have theirs. An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.filter(usable(vector_col) & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("id"), whole_entries(vector_col, scale, shift).alias("x"))
    weight = F.col("n_rows") if weigh_rows else F.lit(1).cast("long")
    distinct = written(distinct_vectors(rows.select("x")).withColumn("weight", weight), "whitening-distinct")
    spaces = fit(distinct, components)
    done = written(whiten(distinct, spaces), "whitening-done")
    errors = _identity_errors(done, spaces)
    told = [(size, int(s.n), s.explained.tolist(), float(errors[size])) for size, s in spaces.items()]
    # A row per length of vectors, each of ``components`` numbers.
    about = spark.createDataFrame(told, "size long, n long, explained array<double>, identity_error double")
    total = done.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar()
    often = F.col("n_rows") * HEAD >= F.col("_total")
    values = done.withColumn("_total", total).select("*", often.alias("_often")).drop("_total", "n_rows", "weight")
    keyed = rows.select("id", _key("x").alias("key"))
    # HEAD vectors at most, as their rows add up to no more than the total.
    hot = F.broadcast(values.filter("_often").drop("_often"))
    few = keyed.join(hot, "key", "left")
    others = few.filter("whitened is null").select("id", "key").join(values.filter("not _often").drop("_often"), "key")
    every = few.filter("whitened is not null").unionByName(others).drop("key")
    return every.join(F.broadcast(about), "size").select(
        F.col("id").alias(id_col), "n", "deviation", "whitened", "explained", "identity_error")


def _identity_errors(done: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Per length the largest absolute entry of the covariance of the whitened vectors minus the identity."""
    shared = done.sparkSession.sparkContext.broadcast({size: len(s.used) for size, s in spaces.items()})

    def moments(batches):
        totals = {}
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            for size in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == size))
                z = batch.column(1).take(at).flatten().to_numpy().reshape(len(at), shared.value[int(size)])
                w = batch.column(2).take(at).to_numpy()[:, None]
                first = np.concatenate([(z * w).sum(axis=0), (z.T @ (z * w)).ravel()])
                totals[int(size)] = totals.get(int(size), 0) + first
        for size, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(total)), pa.array(range(len(total))), pa.array(total)],
                                             names=["size", "place", "total"])

    rows = done.select("size", "whitened", "weight").mapInArrow(moments, "size long, place long, total double").groupBy(
        "size", "place").agg(F.sum("total").alias("total")).collect()
    out = {}
    for size, space in spaces.items():
        k = len(space.used)
        values = np.zeros(k + k * k)
        for _, place, total in (r for r in rows if r[0] == size):
            values[place] = total
        mean = values[:k] / space.n
        # The vectors were centred already; what is left of their mean is a rounding error.
        got = values[k:].reshape(k, k) / space.n - np.outer(mean, mean)
        out[size] = np.abs(got - np.eye(k))[np.ix_(space.used, space.used)].max(initial=0.0)
    return out
