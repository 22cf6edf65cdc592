"""Hot keys: right results, and work that is spread."""

from pyspark.sql import functions as F

from foliospark.operators import analyze as A
from foliospark.operators import ingest as G
from foliospark.operators.skew import (
    MIN_SALTS,
    lookup_join,
    salts_for,
    with_ordinal,
    with_range,
    with_running,
)


def hot_invoices(spark, n=9000):
    """A third of all records share one fingerprint and one name; the rest are mixed."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(hot, "copy").otherwise(F.concat(F.lit("d"), "id")).alias("document_name"),
        F.lit("invoice").alias("document_type"),
        F.lit("success_hybrid").alias("extraction_status"),
        F.when(hot, "ACME").otherwise(F.concat(F.lit("v"), (F.col("id") / 2).cast("int"))).alias("vendor_name"),
        F.when(hot, "X1").otherwise(F.concat(F.lit("n"), (F.col("id") / 2).cast("int"))).alias("invoice_number"),
        F.lit("5.00").alias("total_amount"),
    )


def brute_force_sizes(n):
    sizes = {}
    for i in range(n):
        key = "acme" if i % 3 == 0 else f"v{i // 2}"
        sizes[key] = sizes.get(key, 0) + 1
    return {k: v for k, v in sizes.items() if v > 1}


def test_duplicates_of_a_hot_key(spark):
    n = 9000
    members = A.duplicate_invoices(hot_invoices(spark, n))
    got = {r.vendor_name: (r.n, r.size) for r in members.groupBy("vendor_name").agg(
        F.count("*").alias("n"), F.max("document_count").alias("size")).collect()}
    want = brute_force_sizes(n)
    assert got == {k: (v, v) for k, v in want.items()}
    lists = A.duplicate_group_lists(hot_invoices(spark, n), list_rows=100)
    sizes = [len(r.documents) for r in lists.where("vendor_name = 'acme'").collect()]
    assert sum(sizes) == 3000 and max(sizes) < 200 and len(sizes) == 30


def test_hot_rows_are_spread(spark):
    docs = spark.range(3000).select(F.lit("k").alias("key"), F.col("id").alias("doc_id"))
    other = spark.createDataFrame([("k", 1), ("z", 2)], "key STRING, value INT")
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = lookup_join(docs, other, ["key"], ["doc_id"])
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in per_task) == 3000
    assert len(per_task) > 8 and max(r["count"] for r in per_task) < 1000


def test_lookup_join_kinds(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k STRING, id INT")
    right = spark.createDataFrame([("a", 10), ("c", 30)], "k STRING, v INT")
    for how in ("inner", "left", "left_semi", "left_anti"):
        for salts in (1, 7, None):
            want = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
            for wide in (False, True):
                joined = lookup_join(left, right, ["k"], ["id"], how, salts, wide)
                assert sorted(map(tuple, joined.collect()), key=str) == want, (how, salts, wide)


def test_salts_follow_the_cluster(spark):
    df = spark.range(1)
    assert salts_for(df) == MIN_SALTS
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        assert salts_for(df) == 20000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_document_limit_of_any_size(spark):
    docs = spark.range(500).select(
        (F.col("id") % 2).cast("int").alias("root_ord"), F.format_string("/d/%04d", "id").alias("path")
    )
    rows = sorted(tuple(r) for r in docs.collect())
    for n in (1, 300, 500, 10_000):
        assert [tuple(r) for r in G.limit_documents(docs, n).collect()] == rows[:n]
    assert G.limit_documents(docs, 0).count() == G.limit_documents(docs, None).count() == 500


def test_ordinal(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"))
    got = {r.x: r.n for r in with_ordinal(df.repartition(7), ["x"], "n").collect()}
    assert got == {x: i for i, x in enumerate(sorted(got), 1)} and len(got) == 5000
    assert with_ordinal(df.limit(0), ["x"], "n").count() == 0
    assert [r.x for r in with_ordinal(df, ["x"], "n", 7).orderBy("n").collect()] == sorted(got)[:7]


def test_running_sum_of_several_keys(spark):
    df = spark.range(700).select(
        (F.col("id") % 3).alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b"), (F.col("id") % 5 + 1).alias("v")
    ).withColumn("a", F.when(F.col("a") > 0, F.col("a")))
    rows = sorted(df.collect(), key=lambda r: (r.a is not None, r.a or 0, r.b))
    want, total = {}, 0
    for r in rows:
        total += r.v
        want[r.b] = total
    out = with_running(df.repartition(5), ["a", "b"], F.col("v"), "s")
    assert {r.b: r.s for r in out.collect()} == want
    few = with_running(df, ["a", "b"], F.col("v"), "s", 100)
    assert {r.b: r.s for r in few.collect()} == {b: s for b, s in want.items() if s <= 100}


def test_ordinals_start_no_job_while_they_are_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        out = with_ordinal(spark.range(100).withColumnRenamed("id", "x"), ["x"], "n")
        assert len(tracker.getJobIdsForGroup("building")) == 0
        assert out.count() == 100 and len(tracker.getJobIdsForGroup("building")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ranges_are_even(spark):
    df = spark.range(20_000).select(F.format_string("/a/long/common/prefix/%08d", F.col("id") * 7919 % 20011).alias("x"))
    sizes = [r["count"] for r in with_range(df, ["x"], 32, "r").groupBy("r").count().collect()]
    assert 28 <= len(sizes) <= 40 and max(sizes) < 4 * 20_000 / 32


def test_reused_text_with_a_popular_stem(spark):
    docs = spark.range(600).select(
        F.lit("/r").alias("root"), F.concat(F.lit("/r/"), "id", F.lit("/Invoice.pdf")).alias("path"),
        F.lit("own").alias("text"), F.lit("pdf").alias("method"),
    ).unionByName(spark.createDataFrame(
        [("/r", "/r/x/other.pdf", "own", "pdf"), ("/q", "/q/Invoice.pdf", "own", "pdf")],
        "root STRING, path STRING, text STRING, method STRING"))
    reuse = spark.createDataFrame(
        [
            ("/r", "/r/a/my_extracted_text/invoice.txt", "first"),
            ("/r", "/r/b/extracted_text/sub/INVOICE.txt", "last"),
            ("/r", "/r/c/notes/other.txt", "no"),
        ],
        "root STRING, path STRING, text STRING",
    )
    got = {(r.text, r.method): r["count"] for r in
           G.attach_reused_text(docs, reuse).groupBy("text", "method").count().collect()}
    assert got == {("last", "reused"): 600, ("own", "pdf"): 2}
