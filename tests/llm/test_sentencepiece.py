import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest import SF_SMALL

from foliospark.llm import sentencepiece_codec
from foliospark.llm.sentencepiece_codec import Codec

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return Codec(f.read(), cache_entries=200)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts():
    rng = random.Random(4)
    parts = (
        "a|the|ing|un|tion|é|日|𝒳|\x00|<0x0A>|<s>|\n|\t|0|1234|   | |  |▁|▁▁|aaaa|=|==|-|ñ|ё|привет|\xa0|　|²|².|"
        "_|__|'s|.|,|!!|\x01|�|🏳️‍🌈"
    ).split("|")
    yield from ("", " ", "a" * 3000, "ab" * 1500, "=" * 999, "▁" * 70, " " * 70)
    for _ in range(3000):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
    yield from pq.read_table(f"{SF_SMALL}/documents.parquet").column("text").to_pylist()


def test_encoding_and_decoding_equal_the_library(codec, library):
    for text in _texts():
        want = library.encode(text)
        assert codec.encode(text) == want, repr(text)
        decoded = library.decode(want)
        assert codec.decode(want) == decoded, repr(text)
        ids, out = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, want)), decoded))
        assert codec.round_trip(text) == (len(want), ids, out)


def test_decoding_any_ids_equals_the_library(codec, library):
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.5 else rng.randrange(3, 262) for _ in range(rng.randint(0, 9))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_backtracking_takes_failed_positions_back(codec):
    # pieces from the left only would take the longest one and be wrong somewhere
    greedy = lambda w: codec.trie.longest_prefix(w)
    words = {w for t in _texts() for w in codec.units(t) if "▁▁" not in w}
    assert any(len(codec.backtracked(w)[0]) < greedy(w) for w in words)
    assert all(codec.backtracked(w) == codec.merged(w) for w in list(words)[:3000])


def test_tables(spark, library):
    rows = [(1, "Hello  world\n"), (2, None), (3, "日本")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = sentencepiece_codec.encode(df, PATH)
    assert {r.doc_id: r.ids for r in ids.collect()} == {i: library.encode(t or "") for i, t in rows}
    back = sentencepiece_codec.decode(ids, PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "Hello  world\n", 2: "", 3: "日本"}
