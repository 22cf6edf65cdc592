"""The registered queries: equal to their SQL, and the pipeline to its plain version."""

import hashlib
import zlib

import brute
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, difference
from conftest import SF_SMALL

import __spark_entry__ as entry_points
import corpus_pipeline
from foliospark.llm import mixing, queries, toxicity

COLUMNS = {
    "op1_lang_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_html": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_near_vectors": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op4_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op8_line_dedup": {"doc_id": "bigint", "text_sha256": "string"},
    "op9_merkle": {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
        "edited_fingerprint": "string", "near_edited": "double", "near_next": "double",
    },
    "op10_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_filter_audit": {
        "part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint",
        "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint",
    },
    "op12_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13_whitening": {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    },
}


def test_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert COLUMNS[name].items() <= dict(df.dtypes).items()
    if name in queries.ORACLES:
        assert difference(df, connect(SF_SMALL), queries.ORACLES[name]) is None
    else:
        table = {"op2": "pages", "op7": "pages", "op3": "embeddings", "op13": "embeddings"}.get(name.split("_")[0], "documents")
        rows = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
        assert df.count() == rows * (8 if name == "op13_whitening" else 1)


def test_held_out_rows(spark):
    for name, parts, left in (("op1_lang_id", 4, 2), ("op6_toxicity", 3, 1), ("op12_quality", 3, 1)):
        for r in queries.QUERIES[name](spark, SF_SMALL).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == left)


def test_simhash_equals_plain(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    want = brute.near_copies(texts)
    got = queries.QUERIES["op10_simhash"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{brute.simhash(t):016x}", want[i]) for i, t in texts.items()
    }


def test_targets_are_shared_by_weight(spark):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 500), (None, 3000), ("d", 0), ("a", 30)])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.copies) for r in mixing.mix(df).collect()}
    want = brute.mix(rows)
    assert {i: (a, b, round(c, 6), d) for i, (a, b, c, d) in got.items()} == {
        i: (a, b, round(c, 6), d) for i, (a, b, c, d) in want.items()
    }


def test_pipeline_equals_plain(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    net = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    scorer = toxicity.Scorer(net)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {i: r.text for i, r in rows.items() if next(iter(scorer.scores([r.text]))) < toxicity.THRESHOLD}
    kept = brute.without_repeats(kept)
    first = brute.near_copies(kept)
    kept = {i: t for i, t in kept.items() if first[i] == i}
    copies = brute.mix([(i, rows[i].source, t) for i, t in kept.items()])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in kept.items():
        ids = library.encode(t)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want += [(i, len(ids), *digests)] * copies[i][3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(want)
    assert 0 < len(kept) < len(rows)
