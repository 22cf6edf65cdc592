"""The sample of the language fit keeps every language, however unequal they are."""

from pyspark.sql import functions as F

from foliospark.llm import lang_id


def test_small_languages_are_drawn_whole(spark):
    large, small = [f"large{i}" for i in range(8)], [f"small{i}" for i in range(4)]
    names = F.array(*map(F.lit, large))
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"), F.get(names, (F.col("id") % 8).cast("int")).alias("lang")
    )
    rare = spark.range(24_000, 24_048).select(
        F.col("id").alias("doc_id"), F.get(F.array(*map(F.lit, small)), (F.col("id") % 4).cast("int")).alias("lang")
    )
    docs = docs.union(rare).withColumn("text", F.concat_ws(" ", F.lit("text of"), "lang"))
    learnable = {r.lang: r.n for r in docs.where(~lang_id.held_out()).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = {r.lang: r.n for r in lang_id.sample(docs, 70, 500).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert {x: drawn[x] for x in small} == {x: learnable[x] for x in small}
    assert len({drawn[x] for x in large}) == 1 and 490 < sum(drawn.values()) <= 500
    assert lang_id.train(docs, 70, 500).languages == large + small


def test_quota():
    assert lang_id.quota([], 700, 5000) == 700
    assert lang_id.quota([10**6] * 4, 700, 5000) == 700
    assert lang_id.quota([10**6] * 10 + [100] * 5, 700, 5000) == 450
    assert lang_id.quota([10**6] * 9000, 700, 5000) == 1
