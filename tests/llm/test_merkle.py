import hashlib

from pyspark.sql import functions as F

from foliospark.llm import merkle


def _prints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    return [r[1] for r in sorted(df.select("i", merkle.fingerprint(F.col("text"))).collect())]


def test_roots_tell_texts_apart(spark):
    texts = ["", " ", "\n", "\n\n", "a", "a ", " a", "a\n", "\na", "a b", "a  b", "a\tb", "a. b", "b a", "a|b", "a\nb", "a\n\nb"]
    prints = _prints(spark, [*texts, *texts, None])
    assert prints[: len(texts)] == prints[len(texts) : -1] and prints[-1] == prints[0]
    assert len({p[:32] for p in prints}) == len(texts)


def test_an_edit_is_located(spark):
    paragraphs = [f"Paragraph {i} says this. And then that, number {i * 7}." for i in range(40)]
    other = list(paragraphs)
    other[13] = other[13].replace("then", "now")
    df = spark.createDataFrame([("\n".join(paragraphs), "\n".join(other))], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    row = df.select(merkle.differing_paragraphs(a, b), merkle.likeness(a, b), merkle.differing_paragraphs(a, a)).first()
    assert row[0] == [13] and 0.9 < row[1] < 1 and row[2] == []


def test_next_document_across_buckets(spark):
    rows = [(i * 3 - 50, f"text {i} " + "word. " * (i % 9)) for i in range(500)]
    df = spark.createDataFrame(rows + [(None, "lone"), (None, "lone")], "doc_id long, text string").repartition(7)
    got = {r.doc_id: r for r in merkle.with_next(df).collect()}
    order = sorted(dict(rows), reverse=True)
    text = dict(rows)
    for i, after in zip(order, order[1:] + order[:1]):
        assert got[i].next_text == text[after]
    assert got[None].next_text == ""


def test_single_and_equal_documents(spark):
    one = merkle.edited_fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    df = spark.createDataFrame([(1, "One two. Three four five six seven."), (2, "One two. Three four five six seven.")], "doc_id long, text string")
    rows = merkle.edited_fingerprints(df).collect()
    assert all(r.near_next == 1.0 and 0 < r.near_edited < 1 for r in rows)
