import os

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import classify as C
from foliospark.operators import ingest as G
from foliospark.operators import organize as O
from foliospark.operators import report as R
from foliospark.plans import ingestion as P
from foliospark.sinks import stages as K
from foliospark.sources import contents
from foliospark.sources import files as S
from foliospark.sources import records as SR
from foliospark.sources import runs as RUN


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    files = {
        "a.PDF": b"x" * 10, "sub/b.txt": "café �".encode() + b"\xff\xfe ok", "sub/c.xyz": b"1",
        "sub/big.docx": b"y" * 3000, "run_extracted_text/deep/A.txt": b"reused a", "d.txt": b"  ",
    }
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def test_listing(spark, folder):
    listed = S.list_files(spark, [folder, folder + "/missing"])
    assert listed.count() == 6
    found = G.discover_documents(listed, max_size_mb=0.002).orderBy("path")
    names = [os.path.relpath(r.path, folder) for r in found.collect()]
    assert names == ["a.PDF", "d.txt", "sub/b.txt"]
    pdf = S.list_files(spark, [folder], glob="*.PDF")
    assert [r.length for r in pdf.collect()] == [10]
    assert S.list_files(spark, [folder + "/missing"]).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "LessThanOrEqual(length," in plan
    assert [r.root_ord for r in G.limit_documents(listed, 2).collect()] == [0, 0]
    assert G.limit_documents(listed, 0).count() == 6


def test_decoding(spark, folder):
    texts = {os.path.relpath(r.path, folder): r.text for r in S.read_text_files(spark, folder).collect()}
    assert texts["sub/b.txt"] == "café � ok"
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        S.read_text_files(spark, folder, strict=True).collect()
    assert S.read_text_files(spark, folder + "/missing").count() == 0


def test_ingestion_flow(spark, folder, tmp_path):
    listed = G.discover_documents(S.list_files(spark, [folder]))
    docs = listed.withColumns({"text": F.lit("scan"), "method": F.lit("ocr"), "ocr_pages": F.lit(3)})
    reused = G.attach_reused_text(docs, S.read_text_files(spark, folder))
    outcome = G.ingestion_outcome(reused.drop("document_name", "document_name_stem", "extension", "source_folder"))
    got = {r.document_name: (r.method, r.success, r.text_length, r.ocr_pages, r.error) for r in outcome.collect()}
    assert got["a.PDF"] == ("reused", True, 8, 0, "")
    assert got["big.docx"] == ("ocr", True, 4, 3, "")
    summary = R.run_summary(outcome, "2024-01-01T00:00:00").first()
    assert summary.docs_total == 4 and summary.method_distribution == {"reused": 1, "ocr": 3}
    assert R.run_summary(outcome.limit(0), "x").first().success_rate_pct == 0.0
    for run in ("20240101_235959", "20240102_000001", "20240102_000001"):
        K.write_stage(G.ingestion_tracker(outcome), str(tmp_path / "tracker"), "01_Ingestion", run)
    tracker = spark.read.parquet(str(tmp_path / "tracker"))
    assert tracker.count() == 8
    latest = RUN.rows_of_run(tracker, "01_Ingestion")
    assert {r.run_ts for r in latest.collect()} == {"20240102_000001"}
    assert RUN.rows_of_run(tracker, "01_Ingestion", "20240101_235959").count() == 4
    K.write_lines(G.ingestion_log_lines(outcome), str(tmp_path / "log"))
    assert any("| reused | success=True | len=8" in r.value for r in spark.read.text(str(tmp_path / "log")).collect())


def _many(tmp_path, n=40):
    root = tmp_path / "many"
    for i in range(n):
        path = root / f"d{i % 3}" / f"doc{i:03}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"text {i}")
    (root / "old_extracted_text").mkdir()
    (root / "old_extracted_text" / "DOC003.txt").write_text("reused 3")
    (root / "d0" / "scan.pdf").write_bytes(b"%PDF")
    return root


def test_only_chosen_files_are_opened(spark, tmp_path):
    root = _many(tmp_path)
    paths = sorted(str(p) for p in root.glob("d*/*"))
    for n in (1, 5, 17, None):
        opened = spark.sparkContext.accumulator(0)
        out = P.ingest_files(spark, [str(root)], max_docs=n, opened=opened).collect()
        assert sorted(r.path for r in out) == paths[:n]
        # all but the scan, which has no text of its own
        assert opened.value == sum(p.endswith(".txt") for p in paths[:n])
        got = {r.document_name: (r.method, r.text, r.success) for r in out}
        assert got["doc000.txt"] == ("text", "text 0", True)
        if n is None:
            assert got["doc003.txt"] == ("reused", "reused 3", True) and got["scan.pdf"] == ("pdf", None, False)
    opened = spark.sparkContext.accumulator(0)
    plain = P.ingest_files(spark, [str(root)], max_docs=6, reuse=False, opened=opened)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("binaryFile")[1]  # the scan lists, it does not read
    assert {r.method for r in plain.collect()} == {"text"} and opened.value == 6


def test_files_that_cannot_be_read_are_data(spark, tmp_path):
    root = _many(tmp_path, 4)

    def failing(path):
        if path.endswith("doc001.txt"):
            raise OSError("gone")
        return contents.open_uri(path)

    out = {r.document_name: r for r in P.ingest_files(spark, [str(root)], opener=failing).collect()}
    assert (out["doc001.txt"].method, out["doc001.txt"].success, out["doc001.txt"].error) == ("failed", False, "OSError: gone")
    assert out["doc002.txt"].text == "text 2"


def test_contents_in_small_batches(spark, tmp_path, monkeypatch):
    root = _many(tmp_path, 30)
    listed = S.list_files(spark, [str(root)])
    monkeypatch.setattr(contents, "BATCH_BYTES", 10)
    read = contents.read_contents(listed).collect()
    assert {r.path: r.content for r in read} == {str(p): p.read_bytes() for p in root.rglob("*.*")}
    # shares of one file each go to different partitions
    dealt = contents.dealt_by_length(listed, share=contents.OPEN_COST).withColumn("p", F.spark_partition_id())
    counts = [r["count"] for r in dealt.groupBy("p").count().collect()]
    assert len(counts) == 32 and sum(counts) == 32
    assert contents.read_contents(listed.limit(0)).count() == 0


def test_extracted_texts_join_what_is_read(spark, tmp_path):
    root = _many(tmp_path, 2)
    made = spark.createDataFrame([(f"{root}/d0/scan.pdf", "from pdf", 2)], "path STRING, text STRING, ocr_pages INT")
    out = {r.document_name: (r.method, r.text, r.success) for r in P.ingest_files(spark, [str(root)], made).collect()}
    assert out["scan.pdf"] == ("pdf", "from pdf", True) and out["doc001.txt"] == ("text", "text 1", True)


def test_blank_text_and_failures(spark):
    docs = spark.createDataFrame(
        [("/a.txt", " ", "text", None), ("/b.txt", None, None, "broken"), ("/c.txt", "x", "text", None)],
        "path STRING, text STRING, method STRING, error STRING",
    )
    got = [(r.method, r.success, r.text_length, r.error) for r in G.ingestion_outcome(docs).orderBy("path").collect()]
    assert got == [
        ("text", False, 0, "No text extracted"), ("failed", False, 0, "broken"), ("text", True, 1, ""),
    ]


def test_choose_longer(spark):
    df = spark.createDataFrame(
        [("d" * 100, "o" * 400), ("d" * 150, "o" * 400), ("d" * 100, "o" * 50), ("d", None), (None, "o")],
        "a STRING, b STRING",
    )
    got = [r.c for r in df.select(T.choose_longer(F.col("a"), F.col("b"), 150).alias("c")).collect()]
    assert got == ["o" * 400, "d" * 150, "d" * 100, "d", "o"]


def test_classification_csv(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "inv-1.txt", 'say "hi",\nthen', "x"), (2, "b.txt", "b", "")],
        "doc_id LONG, file_name STRING, document_name STRING, text STRING",
    )
    K.write_csv(C.classification_metrics(C.classify_with_rules(docs)), str(tmp_path / "c"))
    back = SR.read_classification_csv(spark, str(tmp_path / "c")).orderBy("document_name").collect()
    assert [(r.document_name, r.predicted_type, r.confidence) for r in back] == [
        ("b", "ERROR", 0.0), ('say "hi",\nthen', "invoice", 0.98),
    ]


def test_organize(spark, tmp_path):
    ingestion = spark.createDataFrame(
        [("/a/Doc1.pdf", "Doc1.pdf"), ("/b/Doc1.pdf", "Doc1.pdf"), ("/b/x.pdf", "x.pdf")],
        "path STRING, document_name STRING",
    )
    typed = spark.createDataFrame(
        [("/a/Doc1.pdf", "Doc1", "invoice"), ("/b/Doc1.pdf", "Doc1", "a/b:c"), ("/t/3", "z", "other")],
        "path STRING, document_name STRING, predicted_type STRING",
    )
    # equal names keep their own types
    manifest = O.organize_manifest(ingestion, typed)
    assert sorted((r.path, r.folder) for r in manifest.collect()) == [("/a/Doc1.pdf", "invoice"), ("/b/Doc1.pdf", "a_b_c")]
    named = O.organize_manifest_by_name(ingestion, typed)
    assert {(r.path, r.predicted_type, r.conflict) for r in named.collect()} == {
        ("/a/Doc1.pdf", "a/b:c", True), ("/b/Doc1.pdf", "a/b:c", True)}
    there = spark.createDataFrame([("/a/Doc1.pdf",)], "path STRING")
    assert tuple(O.organize_summary(O.with_presence(manifest, there)).first()) == (1, 1)
    placed = str(tmp_path / "placed")
    K.write_by_type(manifest, placed, "r1")
    assert os.path.isdir(f"{placed}/run_ts=r1/folder=a_b_c")
    # a rerun leaves no document where it was
    K.write_by_type(manifest.withColumn("predicted_type", F.lit("invoice")), placed, "r1")
    assert os.listdir(f"{placed}/run_ts=r1").count("folder=invoice") == 1
    assert spark.read.parquet(placed).count() == 2 and not os.path.isdir(f"{placed}/run_ts=r1/folder=a_b_c")


def test_files_are_filled_by_bytes(spark, tmp_path):
    """Whatever the first column holds, and however unlike the lengths of texts are."""
    many = spark.range(3000).select(
        F.lit("same").alias("constant"), F.col("id").alias("path"),
        F.expr("repeat('x', CAST(CASE WHEN id % 300 = 0 THEN 50000 ELSE id % 400 END AS INT))").alias("text"),
        F.when(F.col("id") % 10 < 8, "big").when(F.col("id") % 10 < 9, "small").alias("predicted_type"),
    )
    limit = 100_000
    packed = K.packed_by_bytes(many, "predicted_type", limit).withColumn("bytes", K.row_bytes(many))
    files = packed.groupBy("predicted_type", "part").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("widest")).collect()
    assert all(f.bytes <= limit + f.widest for f in files)
    total = packed.agg(F.sum("bytes")).first()[0]
    assert total / limit <= len(files) <= total / limit + 4
    K.write_by_type(many, str(tmp_path / "placed"), "r1", bytes_per_file=limit)
    back = spark.read.parquet(str(tmp_path / "placed"))
    assert back.count() == 3000 and back.where("folder = 'big'").count() == 2400
    for f in files:  # one file for each part
        if f.predicted_type:
            folder = tmp_path / "placed" / "run_ts=r1" / f"folder={f.predicted_type}" / f"part={f.part}"
            assert len([x for x in os.listdir(folder) if x.endswith(".parquet")]) == 1


def test_stage_reruns(spark, tmp_path):
    at = str(tmp_path / "stages")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "document_name STRING, n INT")
    K.write_stage(rows, at, "s1", "r1")
    K.write_stage(rows, at, "s1", "r2")
    K.write_stage(rows.limit(1), at, "s1", "r1")
    read = lambda run: RUN.rows_of_run(spark.read.parquet(at), "s1", run).count()
    assert (read("r1"), read("r2"), read(None)) == (1, 2, 2)
    assert RUN.tracker_rows(RUN.read_tracker(spark, at), "s1", "r2").count() == 2
    K.write_stage(rows.limit(0), at, "s1", "r1")
    assert (read("r1"), read("r2")) == (0, 2)


def test_report_lists_what_has_rows(spark, tmp_path):
    some = spark.createDataFrame([("a", 1)], "x STRING, y INT")
    assert K.write_report({"some": some, "none": some.limit(0)}, str(tmp_path / "r")) == ["some"]


def test_root_and_paths_in_one_spelling(spark, tmp_path):
    folder = tmp_path / "x_extracted_text" / "in"
    folder.mkdir(parents=True)
    (folder / "a.pdf").write_bytes(b"x")
    for root in (str(folder), f"file:{folder}", f"file://{folder}/", os.path.relpath(folder)):
        listed = S.list_files(spark, [root])
        assert [r.path for r in G.discover_documents(listed).collect()] == [str(folder / "a.pdf")], root


def test_lenient_decoding_keeps_every_valid_character(spark):
    raw = "a\ufdd0b\ufdd00\ufdd01\ufffd\ufdd0\ufffdz".encode()
    df = spark.createDataFrame([(bytearray(raw),), (bytearray(raw[:5] + b"\xff\xc3" + raw[5:]),)], "c BINARY")
    got = [r[0] for r in df.select(S.decode_text(F.col("c"))).collect()]
    assert got == [raw.decode()] * 2


def test_run_history(spark):
    runs = spark.createDataFrame(
        [("s1", "20240101_235959", True), ("s1", "20240102_000001", True), ("s1", "20250101_000000", False), ("t", "2", True)],
        "stage STRING, run_ts STRING, ok BOOLEAN",
    )
    assert {tuple(r) for r in RUN.latest_runs(runs, "ok").collect()} == {("s1", "20240102_000001"), ("t", "2")}
    assert [tuple(r) for r in RUN.latest_run_with_prefix(runs, "s").collect()] == [("s1", "20250101_000000")]


def test_ingest_files(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for at, data in {
        a / "one.TXT": b"first", a / "big.txt": b"x" * 3000, a / "two.pdf": b"%", a / "note.xyz": b"n",
        a / "extracted_text" / "two.txt": b"text of two", b / "blank.txt": b" ", b / "img.png": b"p",
    }.items():
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)
    made = spark.createDataFrame([(str(b / "img.png"), "seen")], "path STRING, text STRING")
    roots = [str(a), f"file:{b}", str(tmp_path / "absent")]
    out = P.ingest_files(spark, roots, made, max_size_mb=0.002)
    got = {os.path.basename(r.path): (r.method, r.success, r.text) for r in out.collect()}
    assert got == {
        "one.TXT": ("text", True, "first"), "two.pdf": ("reused", True, "text of two"),
        "blank.txt": ("text", False, " "), "img.png": ("image", True, "seen"),
    }
    assert P.ingest_files(spark, roots, max_docs=2).count() == 2
