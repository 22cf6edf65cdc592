"""Published runs, and stage 1 that reads only what is new or changed."""

import os

import pytest
from pyspark.sql import functions as F

from foliospark.operators import ingest as G
from foliospark.plans import incremental as INC
from foliospark.sinks import stages as K
from foliospark.sources import contents
from foliospark.sources import runs as RUN


def _rows(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path STRING")


def test_unpublished_runs_are_invisible(spark, tmp_path):
    at = str(tmp_path / "tracker")
    assert RUN.read_published(spark, at).count() == 0
    assert K.write_run(_rows(spark, "a", "b"), at, "01_Ingestion", "20240101_000000") == 2
    # written, but it died before it was published
    K.write_stage(_rows(spark, "half"), at, "01_Ingestion", "20240102_000000")
    K.write_run(_rows(spark, "other"), at, "02_Classification", "20240103_000000")
    tracker, published = spark.read.parquet(at), RUN.read_published(spark, at)
    assert tracker.count() == 4  # the table of finished runs is not part of it
    latest = RUN.tracker_rows(tracker, "01_Ingestion", published=published)
    assert [r.path for r in latest.collect()] == ["a", "b"]
    assert {r.path for r in RUN.rows_of_run(tracker, "01_Ingestion").collect()} == {"half"}
    assert [r.path for r in RUN.rows_of_run(tracker, "01_Ingestion", "20240102_000000", published).collect()] == ["half"]
    assert {r.facts for r in published.collect()} == {'{"rows": 2}', '{"rows": 1}'}
    # the run is chosen by a filter on partition columns; what tells which one is the small table
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and plan.count("Relation [") == 2 and plan.count("Relation [facts") == 1
    # (plan strings cut long filters short, so the filter on run_ts is read off the logical plan)
    condition = next(line for line in plan.splitlines() if "Filter" in line and "scalar-subquery" in line)
    assert "run_ts#" in condition


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    for i in range(30):
        path = root / f"d{i % 3}" / f"doc{i:02}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"text {i}" if i != 7 else "  ")
    (root / "d0" / "scan.pdf").write_bytes(b"%PDF")
    return root


def _texts(spark, base):
    return {os.path.basename(r.path): r.text for r in INC.current_texts(spark, base, 4).collect()}


def test_only_changes_are_read(spark, tmp_path, folder):
    base, opened = str(tmp_path / "base"), None

    def run(ts, **how):
        nonlocal opened
        opened = spark.sparkContext.accumulator(0)
        return INC.ingest_changes(spark, base, [str(folder)], ts, buckets=4, opened=opened, **how)

    assert run("20240101_000000") == {"new": 31, "changed": 0, "unchanged": 0, "gone": 0} and opened.value == 30
    first = _texts(spark, base)
    assert first == {f"doc{i:02}.txt": f"text {i}" for i in range(30) if i != 7}
    # the scan has no text yet and is looked for again, no file is opened
    assert run("20240102_000000") == {"new": 0, "changed": 1, "unchanged": 30, "gone": 0} and opened.value == 0
    assert _texts(spark, base) == first

    (folder / "d0" / "doc03.txt").write_text("a longer text 3")
    (folder / "d1" / "doc04.txt").unlink()
    (folder / "d1" / "doc99.txt").write_text("text 99")
    scan = spark.createDataFrame([(f"{folder}/d0/scan.pdf", "from the scan")], "path STRING, text STRING")

    # an attempt that cannot read one file still ends; one that dies is as if it had never been
    def failing(path):
        if path.endswith("doc03.txt"):
            raise OSError("busy")
        return contents.open_uri(path)

    assert run("20240103_000000", opener=failing)["changed"] == 2 and opened.value == 2
    gone = {k: v for k, v in first.items() if k not in ("doc03.txt", "doc04.txt")}
    assert _texts(spark, base) == {**gone, "doc99.txt": "text 99"}
    K.write_stage(INC.last_manifest(spark, base).limit(1), f"{base}/manifest", INC.STAGE, "20240104_000000")
    assert _texts(spark, base) == {**gone, "doc99.txt": "text 99"}

    assert run("20240105_000000", extracted=scan) == {"new": 0, "changed": 2, "unchanged": 29, "gone": 0}
    assert opened.value == 1  # the one that failed
    want = {**gone, "doc99.txt": "text 99", "doc03.txt": "a longer text 3", "scan.pdf": "from the scan"}
    assert _texts(spark, base) == want
    by_run = {r.text_run: r["count"] for r in INC.last_manifest(spark, base).groupBy("text_run").count().collect()}
    assert by_run == {"20240101_000000": 28, "20240103_000000": 1, "20240105_000000": 2}


def test_texts_of_earlier_runs_are_not_moved(spark, tmp_path, folder):
    base = str(tmp_path / "base")
    INC.ingest_changes(spark, base, [str(folder)], "20240101_000000", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = INC.current_texts(spark, base, 4)
        assert texts.count() == 29
        plan = texts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(line for line in plan.splitlines() if "SelectedBucketsCount" in line)
    assert "text" in scan and "Bucketed: true" in scan
    # one side of the join is shuffled, the manifest
    assert len([line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in line]) == 1


def test_changes_of_a_listing(spark):
    shape = "path STRING, source STRING, length LONG, modified LONG"
    now = [("a", "a", 1, 1), ("b", None, 2, 1), ("c", "c", 3, 9), ("d", "x", 4, 1), ("e", "e", 5, None)]
    then = [("a", "a", 1, 1), ("b", None, 2, 1), ("c", "c", 3, 1), ("d", "d", 4, 1), ("z", "z", 1, 1)]
    previous = spark.createDataFrame(then, shape).withColumn("run", F.lit("r1"))
    got = {r.path: (r.change, r.run) for r in G.listing_changes(spark.createDataFrame(now, shape), previous).collect()}
    assert got == {"a": ("unchanged", "r1"), "b": ("unchanged", "r1"), "c": ("changed", None), "d": ("changed", None),
                   "e": ("new", None), "z": ("gone", None)}
