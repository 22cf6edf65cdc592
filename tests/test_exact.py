"""Sums of doubles: the same bits under any partitioning, and the right value."""

import math
import random
import struct
from fractions import Fraction

from pyspark.sql import functions as F

from foliospark.functions import exact as X
from foliospark.operators import analyze as A


def _bits(x):
    return struct.pack(">d", x)


def _values(rng, n):
    out = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(n)]
    return out + [5e-324, -5e-324, 2.2250738585072014e-308, 1.0, 2.0**32, -(2.0**32), 2.0**-32, 2.0**992, 0.0, -0.0, 0.1, 1e22 + 2**20]


def test_limbs_are_the_number(spark):
    values = _values(random.Random(1), 800) + [1.7976931348623157e308, float("nan"), float("inf"), None]
    rows = spark.createDataFrame(list(enumerate(values)), "i INT, v DOUBLE")
    got = {r.i: r.l for r in rows.select("i", X.limbs_of(F.col("v")).alias("l")).collect()}
    for i, v in enumerate(values):
        if v is None or not math.isfinite(v):
            assert got[i] is None, v
            continue
        assert sum((Fraction(int(x.limb)) * Fraction(2) ** (32 * x.place) for x in got[i]), Fraction(0)) == Fraction(v), v
        assert len(got[i]) <= 3


def test_same_bits_under_any_partitioning(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), v) for v in _values(rng, 3000)]
    want = None
    for seed in range(4):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(1 + 5 * seed)
        got = {r.k: _bits(r.s) for r in X.exact_sums(df, ["k"], F.col("v"), "s").collect()}
        want = want or got
        assert got == want
    for k, bits in want.items():
        true = float(sum((Fraction(v) for x, v in rows if x == k), Fraction(0)))
        assert abs(struct.unpack(">d", bits)[0] / true - 1) < 1e-15


def test_spend_beyond_decimals(spark):
    rng = random.Random(3)
    amounts = ["$1,200.00", "0.1", "1e-9", "1e300", "1e300", "123456789012345678901234567890", "2.5e-12", "12.50", "-4", "x", "1e16"]
    rows = [(f"v{rng.randrange(3)}", rng.choice(amounts), rng.choice(["invoice", "credit_note", "receipt"])) for _ in range(600)]
    rows += [("small", "0.10", "invoice"), ("small", "0.20", "invoice"), ("fine", "1e-30", "invoice")]
    want = None
    for n in (1, 4, 9):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "vendor_name STRING, total_amount STRING, document_type STRING").repartition(n)
        df = df.withColumn("extraction_status", F.lit("success_regex"))
        got = {r.vendor_name: (_bits(r.net_spend), r.doc_count) for r in A.vendor_net_spend(df).collect()}
        want = want or got
        assert got == want
    assert got["small"] == (_bits(0.3), 2) and got["fine"] == (_bits(0.0), 1)
    for vendor in ("v0", "v1", "v2"):
        own = [(Fraction(a.strip("$").replace(",", "")), -1 if t == "credit_note" else 1) for v, a, t in rows if v == vendor and a != "x"]
        total = float(sum((f * s for f, s in own if f > 0), Fraction(0)))
        assert abs(struct.unpack(">d", got[vendor][0])[0] - total) <= 1e-15 * abs(total) + 0.01
        assert got[vendor][1] == sum(f > 0 for f, _ in own)
