"""Large rule sets: the same results as one test for each keyword."""

import random

import pytest
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import classify as C
from foliospark.operators import keywords as KW


@pytest.fixture
def automaton(monkeypatch):
    monkeypatch.setattr(KW, "EXPRESSION_KEYWORDS", 0)


def _documents(spark, rng, n=300):
    words = [w for ks in rules.CONTENT_KEYWORDS.values() for w in ks] + ["symbol", "INVOICES", "x", "Über", "carriers"]
    names = [w for ks in rules.FILENAME_KEYWORDS.values() for w in ks] + ["scan", "PO-7", ""]
    rows = [(i, rng.choice(names) + ".txt", rng.choice(["\n", " ", ""]).join(rng.choice(words) for _ in range(rng.randrange(8)))) for i in range(n)]
    rows += [(n, None, None), (n + 1, "x", "  "), (n + 2, None, "invoice bill to remittance")]
    return spark.createDataFrame(rows, "doc_id INT, file_name STRING, text STRING").withColumn("document_name", F.col("file_name"))


@pytest.mark.parametrize("rule_set", [rules.FULL_RULES, rules.COMPACT_RULES])
def test_shipped_rules_give_the_same_results(spark, monkeypatch, rule_set):
    docs = _documents(spark, random.Random(4))
    flows = (C.classify_with_rules, C.classify_by_content, C.classify_by_filename)
    plain = [f(docs, rule_set).orderBy("doc_id").collect() for f in flows]
    monkeypatch.setattr(KW, "EXPRESSION_KEYWORDS", 0)
    many = [f(docs, rule_set) for f in flows]
    assert [m.orderBy("doc_id").collect() for m in many] == plain
    assert all("ArrowEval" in m._jdf.queryExecution().executedPlan().toString() for m in many)


def test_fifty_thousand_keywords(spark):
    rng = random.Random(6)
    make = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(3, 9)))
    kinds = [f"t{i:02}" for i in range(30)]
    listed: dict[str, set[str]] = {k: set() for k in kinds}
    while sum(map(len, listed.values())) < 50_000:
        listed[rng.choice(kinds)].add(rng.choice([make, lambda: make() + " " + make()])())
    listed["t07"].add("")  # which every text contains
    keywords = {k: tuple(sorted(v)) for k, v in listed.items()}
    texts = [" ".join(make() for _ in range(rng.randrange(0, 40))) for _ in range(60)] + [None, "", "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING").repartition(3)
    got = {r.id: r["_hits"] for r in KW.with_hits(df, "t", keywords).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
            continue
        want = {place: sum(w in t for w in ws) for place, ws in enumerate(keywords.values())}
        assert {h.type: h.score for h in got[i]} == {k: v for k, v in want.items() if v}
    typed = C.classify_by_content(df, rules.RuleSet(filename={}, content=keywords), "t").collect()
    by_id = {r.id: r.predicted_type for r in typed}
    for i, t in enumerate(texts):
        scores = {} if t is None else {k: sum(w in t for w in ws) for k, ws in keywords.items()}
        top = max(scores.values(), default=0)
        assert by_id[i] == (next(k for k, v in scores.items() if v == top) if top >= 2 else None)


def test_keywords_of_a_table(spark, automaton):
    rows = [("b", "x"), ("a", "two words"), ("b", "x"), ("b", "w"), (None, "n"), ("c", None)]
    table = spark.createDataFrame(rows, "type STRING, keyword STRING")
    assert KW.keywords_of(table) == {"a": ("two words",), "b": ("w", "x")}
    assert KW.keywords_of(table.limit(0)) == {}


def test_too_large_a_rule_set_is_refused(spark, monkeypatch):
    monkeypatch.setattr(KW, "MOST_CHARACTERS", 20)
    with pytest.raises(ValueError, match="characters of keywords"):
        KW.keywords_of(spark.createDataFrame([("a", "k" * 30)], "type STRING, keyword STRING"))


def test_no_rules_at_all(spark):
    docs = _documents(spark, random.Random(1), 5)
    got = C.classify_with_rules(docs, rules.RuleSet(filename={}, content={})).collect()
    assert {r.status for r in got} == {"unresolved", "error"}
