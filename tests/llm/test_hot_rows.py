"""One doc_id, or one repeated row, on a third of the table; very long texts."""

from collections import Counter

from pyspark.sql import functions as F

from foliospark.llm import line_dedup, lang_id, merkle, mixing, toxicity
from foliospark.operators.skew import with_range

RUN = "\n".join(f"line {i} of a passage that is said again and again in several words" for i in range(8))


def _table(spark):
    rows = [(7, f"text {i} of the hot id. " * (1 + i % 5), "s") for i in range(300)]
    rows += [(i + 100, f"other {i}", "t" if i % 2 else None) for i in range(300)]
    rows += [(None, "no id", "s")] * 20 + [(None, "no id", "t")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_next_document_within_a_hot_id(spark):
    df = _table(spark)
    got = merkle.with_next(df)
    keyed = got.select("doc_id", "text", "next_text", F.xxhash64("text").alias("h")).where("doc_id IS NOT NULL").collect()
    order = sorted(keyed, key=lambda r: (-r.doc_id, r.h))
    assert [r.next_text for r in order] == [r.text for r in order[1:] + order[:1]]
    assert got.count() == df.count()
    # the rows of the hot id lie in many ranges
    named = df.where("doc_id = 7").withColumns({"k": F.col("doc_id"), "h": F.xxhash64("text")})
    assert with_range(named, ["k", "h"], 32, "r").select("r").distinct().count() > 10


def test_copies_of_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 40)
    df = _table(spark).unionByName(spark.createDataFrame([(9, "the same row", "s")] * 400, "doc_id long, text string, source string"))
    key = lambda r: (r.doc_id, r.text, r.source)
    out = mixing.apply(df.withColumn("a.b", F.lit(1)))
    assert out.dtypes == df.withColumn("a.b", F.lit(1)).dtypes
    got = Counter(map(key, out.collect()))
    assert got == Counter(map(key, mixing.apply(df.repartition(3)).collect()))  # reruns agree
    # as many as the mix takes of each id and source
    named = df.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")))
    want = Counter()
    for r in mixing.mix(named.withColumn("h", F.xxhash64("source", "text")), along=["h"]).collect():
        want[r.doc_id, r.source] += r.copies
    made = Counter()
    for (i, _, source), n in got.items():
        made["?" if i is None else str(i), source] += n
    assert made == Counter({k: v for k, v in want.items() if v})
    rows = Counter(map(key, df.collect()))
    assert all(n <= 2 * rows[k] for k, n in got.items()) and got[9, "the same row", "s"] >= 400


def test_lines_of_a_hot_row(spark):
    rows = [(1, "first\n" + RUN)] * 200 + [(2, "second\n" + RUN)] * 200 + [(2, "unlike text of that id")] * 3
    out = line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert Counter(map(tuple, out.collect())) == {
        (1, "first\n" + RUN): 200, (2, "second"): 200, (2, "unlike text of that id"): 3,
    }


def test_long_and_repeated_rows_are_learned_from_once(spark):
    long = "word " * 100_000
    rows = [(i, f"the small text of {i}" if i % 3 else long, "en" if i % 2 else "de") for i in range(60)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = lang_id.sample(docs).collect()
    assert len(drawn) == len({(r.doc_id, r.lang) for r in drawn}) and all(r.text != long for r in drawn)
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    learned = toxicity.training_rows(docs, labels, F.lit(True)).collect()
    assert sorted(r.doc_id for r in learned) == [i for i in range(60) if i % 3]


def test_very_long_text(spark):
    text = "\n".join(f"paragraph {i} " + "of some words. " * 20 for i in range(15_000))  # 5 MB
    df = spark.createDataFrame([(1, text), (2, "short"), (3, text)], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in merkle.edited_fingerprints(df).collect()}
    assert prints[1] == prints[3] != prints[2]
    out = {r.doc_id: r.text for r in line_dedup.remove_repeats(df).collect()}
    assert out[1] == text and out[3] == "" and out[2] == "short"
