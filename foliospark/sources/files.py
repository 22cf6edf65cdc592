"""Listings and texts from files."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.operators.ingest import union_roots

log = logging.getLogger(__name__)
# Stands, with a digit behind it, for itself and for U+FFFD while undecodable bytes are removed.
_ESCAPE = "﷐"
_LOCAL = r"^file:/+"
_REPLACEMENT = "�"


def _scan(spark: SparkSession, root: str, glob: str | None) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("input folder does not exist, skipping: %s", root)
        return None


def _with_root(scan: DataFrame, root: str) -> DataFrame:
    # root and paths in one spelling, so that what is below the root can be told
    return scan.withColumn("root", F.lit(_spelled(root))).withColumn(
        "path", F.regexp_replace("path", _LOCAL, "/")
    )


def _spelled(root: str) -> str:
    """A root as the scan spells its paths: local ones absolute and without scheme."""
    plain = re.sub(_LOCAL, "/", root)
    if not re.match(r"[a-zA-Z][\w+.-]*:", plain):
        plain = os.path.abspath(plain)
    return plain.rstrip("/")


def list_files(spark: SparkSession, roots: Sequence[str], glob: str | None = None) -> DataFrame:
    """Listing (root, path, length, modified, root_ord) of all files below the roots; contents are not read.

    Missing roots are skipped. `glob="*.pdf"` restricts the listing to one kind of file.
    """
    found = [(r, _scan(spark, r, glob)) for r in roots]
    listings = [
        _with_root(scan, r).select("root", "path", "length", F.col("modificationTime").alias("modified")) for r, scan in found if scan is not None
    ]
    if not listings:
        return spark.createDataFrame([], schemas.LISTING + ", modified TIMESTAMP, root_ord INT")
    return union_roots(listings)


def decode_text(content: Column, strict: bool = False) -> Column:
    """UTF-8 text of file contents. Bad bytes fail a strict read and are dropped otherwise."""
    if strict:
        return F.decode(content, "UTF-8")
    steps = ((_ESCAPE, _ESCAPE + "0"), (_REPLACEMENT, _ESCAPE + "1"))
    out = content.cast("string")
    for plain, escaped in steps:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    out = F.replace(F.make_valid_utf8(out), F.lit(_REPLACEMENT), F.lit(""))
    for plain, escaped in reversed(steps):
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    return out


def read_text_files(
    spark: SparkSession, root: str, strict: bool = False, glob: str = "*.txt"
) -> DataFrame:
    """(root, path, text) of all text files below `root`, one row per file."""
    scan = _scan(spark, root, glob)
    if scan is None:
        return spark.createDataFrame([], "root STRING, path STRING, text STRING")
    return _with_root(scan, root).select("root", "path", decode_text(F.col("content"), strict).alias("text"))
