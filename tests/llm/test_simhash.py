import random

import brute

from foliospark.llm import simhash
from foliospark.llm.common import components


def test_fingerprint_equals_plain():
    rng = random.Random(1)
    words = ["a", "B", "É", "ß", "x\x0by", "word", "日本", " ", "\t", " "]
    for n in [0, 1, 2, 3, 4, 5, 30, 200]:
        text = " ".join(rng.choice(words) for _ in range(n))
        assert simhash.fingerprint(text) == brute.simhash(text)
    assert simhash.fingerprint(None) == 0


def test_every_start_of_a_near_pair_is_found():
    rng = random.Random(2)
    for _ in range(3000):
        a = rng.getrandbits(64)
        diff = 0
        for b in rng.sample(range(64), rng.randint(0, 2)):
            diff |= 1 << b
        starts = simhash.ring(2)
        assert any(
            (key & ((1 << 64) - 1)) & diff == 0
            and all(((mask & ((1 << 64) - 1)) & diff).bit_count() <= most for mask, most in chains)
            for key, chains, _ in starts
        ), a


def _clusters(rng, centres, each):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            f = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def test_components_equal_brute_force_for_small_and_large_buckets(spark):
    prints = _clusters(random.Random(3), 6, 50)
    want = brute.components(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    fps = spark.createDataFrame(rows, "fp long, node long")
    for limit in (3, 1000):  # most buckets over the limit, none over it
        edges = simhash.links(fps, 2, limit)
        for r in edges.collect():
            assert (prints[r.a] ^ prints[r.b]).bit_count() <= 2
        got = {r.node: r.component for r in components(edges).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_long_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, i) for i in range(1001, 1500)]
    edges = spark.createDataFrame(chain + hub + [(7, 7), (None, 3), (2000, 2001)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert len(got) == 301 + 500 + 2
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1500)} == {1000}
    assert got[2001] == 2000
