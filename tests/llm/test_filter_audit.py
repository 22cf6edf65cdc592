"""The filter audit against a plain version that runs every order over every document."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """(part, order, step) → counts, by applying the filters to the documents one after another."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text, words = text or "", WORD.findall(text or "")
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            fails.add("E")
        rows.append((source or "", fails, i in good, i in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing, alone = sum(f in r[1] for r in own), sum(r[1] == {f} for r in own)
                out[part, "".join(order), step] = (
                    len(left), len(gone), failing - len(gone), alone, sum(r[2] for r in gone), sum(r[3] for r in gone),
                )
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_place_counts_equal_plain():
    rng = np.random.default_rng(3)
    for n in [0, 1, 2, 3, 4, 5, 26, 27, 28, 1000, 4097]:
        words = rng.integers(0, 1 << 32, n, np.uint32)
        times = rng.integers(1, 1 << 40, n)
        for t in (None, times):
            want = [sum((int(w) >> b & 1) * int(k) for w, k in zip(words, np.ones(n, int) if t is None else t)) for b in range(32)]
            assert filter_audit.place_counts(words, t).tolist() == want


def test_survival_words():
    for m, w in enumerate(filter_audit.survival_words(np.arange(32))):
        assert [int(w) >> s & 1 for s in range(32)] == [int(s & m == 0) for s in range(32)]


def _random_docs(rng):
    kinds = [
        lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(190, 210))),
        lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(190, 210))),
        lambda: "AB cd " * rng.randrange(3),
        lambda: rng.choice(["a|b", "x y #", "\x0b\x1c", "É" * 100 + "AA", "É" * 100 + "AAA", "", None]),
        lambda: "same text\nagain " * 100,
    ]
    return [(rng.choice([None, 1, 1, 7, *range(60)]), rng.choice(kinds)(), rng.choice(["s", "t", "", None])) for _ in range(150)]


def test_audit_equals_plain(spark):
    rng = random.Random(8)
    docs = _random_docs(rng)
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    table = table.withColumns({c: F.lit(1) for c in ("part", "failed", "digest", "n", "good", "toxic", "_salt", "a.b")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(table, marks).collect()}
    assert got == plain(docs, labels)
    assert filter_audit.audit(table.limit(0), marks).count() == 0
    none = filter_audit.audit(table, marks.limit(0))
    assert none.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_hot_rows_and_long_text(spark):
    long = "word " * 400_000 + "A" * 50_000
    rows = [(i, long if i % 3 == 0 else "short", "hot") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.union(docs)
    got = filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    first = {r.step: r for r in got.where("filter_order = 'ABCDE'").collect()}
    # the short ones go by length, the long one by its repeated words
    assert (first[1].removed, first[1].kept, first[2].removed, first[2].kept) == (40, 20, 20, 0)
    # but for those of the smallest doc_id all rows are copies
    last = got.where("filter_order = 'EABCD' AND step = 1").first()
    assert (last.removed, last.kept) == (56, 4)
