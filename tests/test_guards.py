"""Literal guards: never stop a text that has a match, and spare the search of one that cannot."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import guards as G
from foliospark.functions.patterns import SEARCH_LINES, search, tame_spaces, with_ranked_search
from foliospark.operators.extract import extract_fields
from foliospark.operators.invoices import HEADER_PATTERNS

PATTERNS = [p for ps in HEADER_PATTERNS.values() for p in ps] + list(rules.TAX_PATTERNS)
PATTERNS += [p for fields in rules.FIELD_PATTERNS.values() for p in fields.values()]


@pytest.mark.parametrize(
    "pattern, want",
    [
        (r"invoice\s*no", [{"invoice"}]),
        (r"(?:grand\s*)?total\s*\d", [{"total"}, {"\\d"}]),
        (r"(?:from|bill\s*to|vendor)x", [{"from", "bill", "vendor"}]),
        (r"(?:invoice|inv)\d", [{"inv"}, {"\\d"}]),
        (r"a(?:bcd)e", [{"abcde"}]),
        (r"(?:abc)?", []),
        (r"(?:one|two|\s)x", []),
        (r"[abc]+\w\.", []),
        (r"(?:one|two|three|four|five)", []),
        (r"(?:total){2}", [{"total"}]),
        (r"Größe", []),
        (r"\p{Alpha}abc", []),  # Java only
    ],
)
def test_needs(pattern, want):
    assert [set(n) for n in G.guards_of(pattern)] == want


def test_folding_finds_all_that_patterns_take_for_a_letter(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    chars = [chr(c) for c in range(1, 0x110000, 1) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or 0xA000 <= c < 0x10000 or c > 0x10400 and c < 0x10500)]
    df = spark.createDataFrame([(c,) for c in chars], "char STRING").repartition(4)
    tests = [(F.col("char").rlike("(?imduU)" + x) & ~G.folded(F.col("char")).contains(x)).alias(x) for x in letters]
    missed = df.select("char", *tests).where(" OR ".join(letters))
    assert missed.collect() == []


def _texts(rng, n):
    bits = ["Invoice", "ınvoıce", "INVOİCE", "inv", "no.", "#", ":", "bill", "to", "Total", "amount", "due", "balance", "$", "12.50", "1,200.00",
            "date", "01/02/2024", "2024-01-05", "12 Jan 2024", "Feb 3, 2024", "from", "Some Company Ltd", "referencE", "vat", "4123456789",
            "\n", "\n\n", "ACME TRADING HOUSE", "A1-77", "tax", "prose", "ſome", "ref", "٣٤"]
    return [rng.choice([" ", "", "  "]).join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def test_guarded_searches_equal_plain_ones(spark):
    rng = random.Random(12)
    rows = [(t,) for t in _texts(rng, 1500)] + [(None,), ("",)]
    df = G.with_folded(spark.createDataFrame(rows, "t STRING").repartition(4), "t")
    both = []
    for i, p in enumerate(PATTERNS):
        plain = search(F.col("t"), tame_spaces(p), SEARCH_LINES)
        both.append((~plain.eqNullSafe(G.guarded(p, plain))).alias(f"p{i}"))
    assert df.select("t", *both).where(" OR ".join(f"p{i}" for i in range(len(PATTERNS)))).collect() == []


def test_fields_of_each_type_equal_unguarded_ones(spark):
    rng = random.Random(13)
    types = [*rules.FIELD_PATTERNS, "contract", None]
    rows = [(i, rng.choice(types), t) for i, t in enumerate(_texts(rng, 600) + [None])]
    df = spark.createDataFrame(rows, "doc_id INT, document_type STRING, text STRING")
    both = [extract_fields(df, linear=linear).orderBy("doc_id").collect() for linear in (True, False)]
    assert both[0] == both[1]


def test_long_texts_without_literals_are_not_searched(spark):
    """Every pattern would take its time over these; the guards let none of them begin."""
    slow = {"f": (r"zebra(?:\s*\w+\s*)*!", r"yellow(?:\s*\w+\s*)*!")}  # grows exponentially once begun
    text = ("all work and no play makes a dull day " * 30_000).strip()
    df = spark.createDataFrame([(text,), ("a zebra!",)], "t STRING")
    assert [(r.f, r.f_rank) for r in with_ranked_search(df, "t", {"f": [p.replace("!", "(!)") for p in slow["f"]]}).orderBy(F.length("t")).collect()] == [
        ("!", 0), (None, None)]
    # all that a text of prose is scanned for: literals, and a digit
    assert sum(bool(G.guards_of(p)) for p in PATTERNS) == len(PATTERNS) - 1
    assert not re.search("[0-9]", text)
