"""Whitening of integer vectors by exact, bit-sliced covariances.

Components become integers x. Blocks of rows are cut into bit planes: for each dimension and bit
(of x less the smallest x of the block) one bit a row, packed into words. The number of rows in
which two planes both have a one, weighted by their powers of two, adds up to the exact sum of
products of two dimensions. Spark adds the sums of all blocks; only the matrix of one vector's
dimensions reaches the driver, is centred there in integers and broken into eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import ship_code

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows whose planes are held at once.
BLOCK_ROWS = 4096
#: Eigenvalues below this share of their sum are rounding: their component is left out.
LEAST_SHARE = 1e-12
_WORD_BITS = 64
#: Components from here on have no x in a long.
LIMIT = float((1 << 53) - 128)
#: Integers up to here are exact as doubles.
_EXACT = 1 << 52
#: Sums leave a partition in digits of this base, each a long.
_BASE = 10**18


def usable(embedding: Column) -> Column:
    """Whether a vector is there, has components, and each has an x: none is null, infinite, no
    number, or beyond `LIMIT`."""
    # no number is above all numbers here
    held = F.forall(embedding, lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False)))
    return F.coalesce((F.size(embedding) > 0) & held, F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """x of each component: as int64, or as Python integers where that does not hold them."""
    floors = np.floor(SCALE * vectors)
    if np.abs(floors).max(initial=0) < _EXACT:
        return floors.astype(np.int64) + OFFSET
    return np.array([[int(c) + OFFSET for c in row] for row in floors.tolist()], object).reshape(vectors.shape)


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums over rows of x and of the products of every two dimensions, as Python integers."""
    low = x.min(0)
    shifted = x - low
    bits = [max(int(v).bit_length(), 1) for v in shifted.max(0)]
    rows, dims = x.shape
    width = -(-rows // _WORD_BITS) * _WORD_BITS
    planes = np.zeros((sum(bits), width // _WORD_BITS), np.uint64)
    weights, owner = [], np.repeat(np.arange(dims), bits)
    at = 0
    for d in range(dims):
        for b in range(bits[d]):
            ones = np.zeros(width, np.uint8)
            ones[:rows] = (shifted[:, d] >> b) & 1
            planes[at] = np.packbits(ones).view(np.uint64)
            weights.append(1 << b)
            at += 1
    small = max(bits) <= 24 and rows <= 1 << 14
    number = np.int64 if small else object
    weight = np.array(weights, number)
    starts = np.cumsum(bits) - np.array(bits)
    products = np.zeros((dims, dims), object)
    for d in range(dims):
        # all planes of this dimension against those of this one and later ones
        later = slice(int(starts[d]), None)
        of_dim = np.zeros(len(weight) - starts[d], number)
        for b in range(bits[d]):
            both = np.bitwise_count(planes[starts[d] + b] & planes[later]).sum(1, dtype=np.int64)
            of_dim = of_dim + both.astype(number) * weight[later] * (1 << b)
        sums = np.add.reduceat(of_dim, starts[d:] - starts[d])
        products[d, d:] = sums
        products[d:, d] = sums
    ones = np.bitwise_count(planes).sum(1, dtype=np.int64)
    total = np.zeros(dims, object)
    for p, d in enumerate(owner):
        total[d] += int(ones[p]) << (weights[p].bit_length() - 1)
    # undo the shift: x = u + low
    low = np.array([int(v) for v in low], object)
    sums = total + rows * low
    return sums, products + np.outer(low, total) + np.outer(total, low) + rows * np.outer(low, low)


@dataclass
class Whitening:
    """What the fit list gives; an empty one has no components."""

    rows: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: int64 if that holds it, else Python integers."""
        edge = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.rows + max(map(abs, self.sums))
        if x.dtype != object and edge < 1 << 62:
            return self.rows * x - np.array(self.sums, np.int64)
        return self.rows * x.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.rows) @ self.vectors / np.sqrt(self.values)


def deviations(centred: np.ndarray) -> list[int | None]:
    """Exact sums of squares of each row; None where a long does not hold it."""
    high = max(abs(int(centred.max(initial=0))), abs(int(centred.min(initial=0))))
    if centred.dtype != object and centred.shape[1] * high * high < 1 << 63:
        return (centred * centred).sum(1).tolist()
    sums = (int(sum(v * v for v in map(int, row))) for row in centred)
    return [s if s < 1 << 63 else None for s in sums]


def digits(value: int) -> list[int]:
    """Digits of a signed number, lowest first, each with its sign."""
    out, rest = [], abs(value)
    while rest or not out:
        rest, digit = divmod(rest, _BASE)
        out.append(digit if value >= 0 else -digit)
    return out


def decompose(rows: int, sums: list[int], products: np.ndarray, most: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance, centred in integers, by falling eigenvalue."""
    scatter = rows * products - np.outer(np.array(sums, object), np.array(sums, object))
    # integers divided by integers: rounded once
    covariance = np.array([[int(v) / (rows * rows) for v in line] for line in scatter])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    trace = float(np.trace(covariance))
    kept = [i for i in order[:most] if values[i] > LEAST_SHARE * trace]
    return Whitening(rows, sums, vectors[:, kept], values[kept], values[kept] / trace if kept else values[kept])


def _matrices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of a batch with their integers. All vectors have one length."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            flat = part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part, integers(flat.reshape(part.num_rows, -1))


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of all of `vectors` (embedding: usable and of one length), None if there are
    none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, 0, 0
        for part, x in _matrices(batches, 0):
            s, p = cross_products(x)
            count, sums, products = count + len(x), sums + s, products + p
        if not count:
            return
        made = [(-1, -1, count)] + [(-1, d, v) for d, v in enumerate(sums)]
        made += [(i, j, products[i, j]) for i, j in zip(*np.triu_indices(len(sums)))]
        made = [(int(i), int(j), k, digit) for i, j, v in made for k, digit in enumerate(digits(int(v)))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], ["i", "j", "k", "v"])

    ship_code(vectors)
    parts = vectors.select("embedding").mapInArrow(run, "i int, j int, k int, v long")
    # as many rows as a vector has pairs of dimensions, however large the table is
    rows = parts.groupBy("i", "j", "k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    got: dict[tuple[int, int], int] = {}
    for r in rows:
        got[r.i, r.j] = got.get((r.i, r.j), 0) + int(r.v) * _BASE**r.k
    if not got:
        return None
    dims = max(j for _, j in got) + 1
    products = np.zeros((dims, dims), object)
    for (i, j), v in got.items():
        if i >= 0:
            products[i, j] = products[j, i] = v
    return decompose(got[-1, -1], [got[-1, d] for d in range(dims)], products, most)


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, over all
    rows: partitions give means and centred products, which are put together."""
    size = len(fitted.values)
    if not size:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 0):
            w = fitted.whitened(fitted.centred(x))
            mean = w.mean(0)
            away = w - mean
            # within the block about its mean, and of the mean about zero, which all rows centre on
            products = away.T @ away + len(w) * np.outer(mean, mean)
            made = np.concatenate([len(w) * mean, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int32()), pa.array(made)], ["k", "v"])

    parts = vectors.select("embedding").mapInArrow(run, "k int, v double")
    got = {r.k: r.v for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([got[k] for k in range(size + size * size)]) / fitted.rows
    mean, raw = flat[:size], flat[size:].reshape(size, size)
    return float(np.abs(raw - np.outer(mean, mean) - np.eye(size)).max())


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    Vectors that are null, empty, or hold null or non-finite entries or one beyond `LIMIT` are left
    out; so are, where lengths differ, those that have not the most frequent one (of equally frequent ones the
    longest). All others are fit and returned, repeated rows and rows without id as well.
    Components of no variance are left out: equal vectors, or a single one, give no rows, as does
    an empty table. `deviation` is null where a long does not hold it. Other columns are not read.
    """
    vectors = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding")).where(
        usable(F.col("embedding"))
    )
    lengths = vectors.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not lengths:
        return table.sparkSession.createDataFrame([], out)
    vectors = vectors.where(F.size("embedding") == lengths[0]["size"])
    fitted = fit(vectors, most)
    error = identity_error(vectors, fitted)
    size = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 1):
            if not size:
                continue
            centred = fitted.centred(x)
            made, rows = fitted.whitened(centred), len(x)
            each = pa.array(np.repeat(np.arange(rows), size))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * size, fitted.rows, np.int64)),
                    pa.array(deviations(centred), pa.int64()).take(each),
                    pa.array(made.ravel()),
                    pa.array(np.tile(fitted.explained, rows)),
                    pa.array(np.full(rows * size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, out)
