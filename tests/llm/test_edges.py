"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliospark.llm import (
    html_extract,
    lang_id,
    line_dedup,
    merkle,
    mixing,
    near_vectors,
    sentencepiece_codec,
    simhash,
    toxicity,
    url_filter,
)

LONG = ("all work and no play makes a dull day. " * 40 + "\n") * 60
ROWS = [
    (1, "a b c d e f", "en", "s1"),
    (2, "a b c d e f", "en", "s1"),
    (2, "a b c d e f", "en", "s1"),
    (3, None, None, None),
    (4, "", "en", None),
    (5, " \n\t ", "de", ""),
    (6, LONG, "de", "s1"),
    (7, "12 34 !!", "de", "s2"),
    (None, "no id here", "en", "s1"),
    (None, None, None, None),
]
CLASHING = "pos start stop fp words rank size copies bucket guest doc row id n at _salt score target copy turn own".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="module")
def network():
    texts = ["you idiot " + w for w in "abcdefgh"] + ["kind words " + w for w in "abcdefgh"]
    return toxicity.fit(texts, [1] * 8 + [0] * 8)


MODEL = public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "lang": lambda d, net: lang_id.identify(d, lang_id.train(d)),
    "mix": lambda d, net: mixing.mix(d),
    "pieces": lambda d, net: sentencepiece_codec.round_trip(d, MODEL),
    "encode": lambda d, net: sentencepiece_codec.encode(d, MODEL),
    "toxic": lambda d, net: toxicity.score(d, net),
    "lines": lambda d, net: line_dedup.remove_repeats(d),
    "merkle": lambda d, net: merkle.edited_fingerprints(d),
    "simhash": lambda d, net: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, network, name):
    got = OPERATORS[name](docs, network).select("doc_id").collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert [r.doc_id for r in sorted(got, key=key)] == [1, 2, 2, 3, 4, 5, 6, 7, None, None]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, network, name):
    assert OPERATORS[name](docs.limit(0), network).count() == 0


def test_stage_operators_keep_columns(docs, network):
    for out in (
        toxicity.reject(docs, network),
        line_dedup.remove_repeats(docs),
        simhash.keep_one(docs),
        mixing.apply(docs),
    ):
        assert out.dtypes == docs.dtypes
        assert all(r[c] == c for r in out.collect() for c in CLASHING)


def test_keep_one_of_repeated_rows(docs):
    kept = sorted(r.doc_id or 0 for r in simhash.keep_one(docs).collect())
    # 1 and 2 are alike, as are the blank 3, 4 and 5; rows without doc_id stay
    assert kept == [0, 0, 1, 3, 6, 7]


def test_keep_one_keeps_unlike_texts_of_one_id(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (1, " ".join(reversed(words))), (1, " ".join(words)), (2, " ".join(words)), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit(7) for c in ("a.b", "h", "fp", "root", "low", "_salt", "doc")})
    kept = simhash.keep_one(df)
    assert kept.dtypes == df.dtypes
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([rows[0], rows[1], (3, "")])
    assert simhash.keep_one(df.limit(0)).count() == 0
    # the two texts of document 1 are no link between their own copies
    got = simhash.near_duplicates(spark.createDataFrame([*rows, (0, rows[1][1])], "doc_id long, text string"))
    assert sorted(r.component_id for r in got.collect()) == [0, 0, 1, 1, 1, 3]


def test_long_text_repeats_itself(docs):
    out = {r.doc_id: r for r in line_dedup.remove_repeats(docs, counted=True).collect()}
    assert out[6].n_lines_deleted == 59 and out[6].text.count("dull day") == 40
    assert out[3].text is None and out[4].text == ""


def test_mixing_takes_null_source_last(docs):
    by_id = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert by_id[3]["size"] == 0 and by_id[3].taken == 0
    assert by_id[5].source_size == 0 and by_id[5].target == 0


PAGES = [
    (1, "https://a.net/es/x", "<p>one</p>"),
    (1, "https://a.net/es/x", "<p>one</p>"),
    (2, None, "<p>two</p>"),
    (3, "no scheme", None),
    (4, "https://b.org", ""),
    (None, "://", "<article>" + "<p>long text here</p>" * 5000),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(c) for c in ("host", "path", "suffix", "n", "votes", "rule")})


def test_pages(pages):
    for f in (html_extract.extract, url_filter.judge):
        got = f(pages).collect()
        assert sorted((r.page_id or 0) for r in got) == [0, 1, 1, 2, 3, 4]
        assert f(pages.limit(0)).count() == 0
    text = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert text[3] == "" and text[4] == "" and text[2] == "two"
    assert text[None].count("long text here") == 5000


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]),
        (8, [nan, 1.0]), (9, [1.0, None]), (10, [inf, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.0]),
        (None, [1.0, 0.0]), (4, [0.0, 1.0]), (13, [1e200, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(0))
    out = near_vectors.near_duplicates(df).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert len(out) == len(rows)
    for i in (1, 2, 3, 12, 13):
        assert got[i] == (4, 1, i == 1), i
    assert got[4] == (1, 4, True)
    for i in (5, 6, 7, 8, 9, 10, 11):
        assert got[i] == (0, i, True), i
    assert got[None] == (0, None, True)
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0
