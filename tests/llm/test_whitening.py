"""Bit-sliced whitening against plain integer and double arithmetic."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from foliospark.llm import queries, whitening


@pytest.mark.parametrize("high", [1, 3, 1000, 1 << 30, 1 << 61])
@pytest.mark.parametrize("rows", [1, 63, 64, 65, 300])
def test_cross_products_are_exact(high, rows):
    rng = random.Random(high + rows)
    table = [[rng.randint(-high, high) for _ in range(5)] for _ in range(rows)]
    sums, products = whitening.cross_products(np.array(table, np.int64 if high < 1 << 50 else object))
    assert list(sums) == [sum(r[d] for r in table) for d in range(5)]
    for i in range(5):
        for j in range(5):
            assert products[i, j] == sum(r[i] * r[j] for r in table)


def test_digits():
    for v in (0, 1, -1, 10**18 - 1, 10**18, -(10**40) - 5):
        assert sum(d * 10 ** (18 * k) for k, d in enumerate(whitening.digits(v))) == v


def plain(vectors):
    """Per row: n, deviation, and the whitened values (up to sign); explained."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    away = [[n * r[d] - sums[d] for d in range(dims)] for r in x]
    deviation = [sum(a * a for a in r) for r in away]
    centred = np.array(away, np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    kept = [i for i in order if values[i] > 1e-9 * values.sum()]
    return n, deviation, centred @ vectors[:, kept] / np.sqrt(values[kept]), values[kept] / values.sum()


def compare(got, vectors):
    n, deviation, whitened, explained = plain([v for _, v in vectors])
    size = whitened.shape[1]
    assert len(got) == len(vectors) * size
    made = {(r.vec_id, r.component): r for r in got}
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-6
    for c in range(1, size + 1):
        values = np.array([made[i, c].whitened for i, _ in vectors])
        sign = np.sign((values * whitened[:, c - 1]).sum())
        assert np.allclose(values * sign, whitened[:, c - 1], atol=1e-6)
        assert all(abs(made[i, c].explained / explained[c - 1] - 1) < 1e-6 for i, _ in vectors)
    for (i, _), d in zip(vectors, deviation):
        assert made[i, 1].deviation == (d if d < 1 << 63 else None)


def test_query_equals_plain(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    compare(queries.QUERIES["op13_whitening"](spark, SF_SMALL).collect(), [(r.vec_id, r.embedding) for r in rows])


def test_unusable_vectors_and_wide_ranges(spark):
    rng = random.Random(2)
    good = [(i, [rng.uniform(-1, 1) * s for s in (1, 1e3, 1e12, 0.001)]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [1.0, -inf, 1.0, 1.0]),
           (105, [1e300, 1.0, 1.0, 1.0]), (106, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit(1) for c in ("n", "component", "i", "j", "v", "a.b")}).repartition(3)
    compare(whitening.whiten(df).collect(), good)
    # a long holds the deviations of none of them: the third dimension is too wide
    assert whitening.whiten(df).where("deviation IS NOT NULL").count() == 0


def test_repeated_equal_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    twice = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 2.0]), (3, [3.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(twice, schema)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (3, 1), (3, 2)]
    assert {r.n for r in got} == {4}
    assert whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0])], schema)).count() == 0
    empty = whitening.whiten(spark.createDataFrame([(1, None)], schema))
    assert empty.count() == 0 and empty.dtypes == whitening.whiten(spark.createDataFrame(twice, schema)).dtypes
