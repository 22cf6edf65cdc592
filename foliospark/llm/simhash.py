"""SimHash near-duplicates: 64-bit fingerprints, linked by a pigeonring search.

Two fingerprints within `k` differing bits, cut into m = 2k + 1 segments on a ring, have a
start from which every chain of l consecutive segments differs in at most l * k / m bits. The
chains short enough to allow no difference at all are the bucket key; the longer ones are
checked on each pair of a bucket before its full distance is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import components, cut_lineage, packed, ship_code, unpacked, with_group
from foliospark.operators.skew import lookup_join

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
BITS = 64
#: Above this many fingerprints in a bucket, sharing a one-bit variant is cheaper than pairing.
PAIRING_LIMIT = 64

_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE_AT = (np.arange(8, dtype=np.uint16) * 256)[None, :]
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text over its lower-cased word shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        shingles = iter([b" ".join(parts)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
        count = len(parts) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, count)
    ones = np.zeros((8, 8), np.int64)
    for at in range(0, count, _BLOCK):
        octets = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8) + _BYTE_AT
        ones += np.bincount(octets.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    return int.from_bytes(np.packbits((2 * ones > count).ravel(), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *extra: Column
) -> DataFrame:
    """(doc_id, *extra, fp): the fingerprint of every row as a signed long. `extra` are columns
    of `docs` or aliased expressions."""
    slim = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), *extra)
    names = slim.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_signed(fingerprint(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(made, pa.int64())], [*names, "fp"]
            )

    ship_code(docs)
    kinds = ", ".join(f"{name} {kind}" for name, kind in slim.dtypes[1:])
    return slim.mapInArrow(run, f"{kinds}, fp long")


def ring(k: int = MAX_DISTANCE) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """For each start: mask of the bits that must agree, [(mask, most differing bits)] of the
    longer chains, and the single bits outside the first mask."""
    m = 2 * k + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    segment = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(m)]
    out = []
    for start in range(m):
        mask, key, chains = 0, 0, []
        for length in range(1, m + 1):
            mask |= segment[(start + length - 1) % m]
            if length * k // m == 0:
                key = mask
            elif length < m:
                chains.append((_signed(mask), length * k // m))
        free = [_signed(1 << b) for b in range(BITS) if not key >> b & 1]
        out.append((_signed(key), chains, free))
    return out


def _by_start(starts: list, value) -> Column:
    """`value` of the row's start, as one expression."""
    out = None
    for i, s in enumerate(starts):
        test = F.col("start") == i
        out = F.when(test, value(s)) if out is None else out.when(test, value(s))
    return out


def links(fps: DataFrame, k: int = MAX_DISTANCE, pairing_limit: int = PAIRING_LIMIT) -> DataFrame:
    """Edges (a, b) of nodes whose distinct fingerprints differ in at most `k` bits, enough of
    them to connect every two that do. `fps`: (fp, node), one row per fingerprint.

    Rows of buckets up to `pairing_limit` are paired, with the chain test first. In a larger
    bucket each fingerprint lists its variants of up to k // 2 changed bits outside the key, and
    those that share a variant are joined in a star: they are at most `k` apart, and every two
    that close share one. That form is written for two bits, so other `k` are refused.
    """
    if k != 2:
        raise ValueError(f"links are made for 2 differing bits, not {k}")
    starts = ring(k)
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(key)).alias("key"))
            for i, (key, _, _) in enumerate(starts)
        )
    )
    rows = fps.select("fp", "node", F.inline(keys))
    shared = cut_lineage(
        with_group(
            rows,
            ["start", "key"],
            ["fp"],
            [F.count(F.lit(1)).alias("_p")],
            [F.sum("_p").alias("bucket_rows")],
            F.col("bucket_rows") > 1,
        )
    )
    few = shared.where(F.col("bucket_rows") <= pairing_limit)
    left = few.select("start", "key", F.col("fp").alias("fa"), F.col("node").alias("a"))
    right = few.select("start", "key", F.col("fp").alias("fb"), F.col("node").alias("b"))
    differing = F.col("fa").bitwiseXOR(F.col("fb"))
    chained = _by_start(
        starts,
        lambda s: F.expr("true")
        if not s[1]
        else _all(F.bit_count(differing.bitwiseAND(F.lit(mask))) <= most for mask, most in s[1]),
    )
    pairs = (
        left.join(right, ["start", "key"])
        .where(F.col("fa") < F.col("fb"))
        .where(chained)
        .where(F.bit_count(differing) <= k)
        .select("a", "b")
    )
    flips = _by_start(starts, lambda s: F.array(*(F.lit(bit) for bit in [0, *s[2]])))
    many = shared.where(F.col("bucket_rows") > pairing_limit)
    stars = (
        many.select("start", "fp", "node", F.explode(flips).alias("bit"))
        .groupBy("start", F.col("fp").bitwiseXOR(F.col("bit")).alias("variant"))
        # at most one node for each changed bit, so the list is short
        .agg(F.collect_list("node").alias("nodes"))
        .where(F.size("nodes") > 1)
        .select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b"))
        .where("a <> b")
    )
    return pairs.union(stars)


def _all(tests) -> Column:
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


def _grouped(hashed: DataFrame, k: int) -> DataFrame:
    """`hashed` (doc_id, fp, more) with `root`, one fingerprint of all those that links connect, and
    `component_id`, their smallest doc_id. Fingerprints are the nodes, so that rows which repeat a doc_id with
    unlike texts stay apart. Rows without doc_id link with nothing."""
    fps = cut_lineage(
        hashed.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("low"))
    )
    reached = components(links(fps.select("fp", F.col("fp").alias("node")), k))
    rooted = fps.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    per_fp = lookup_join(rooted, lowest, ["root"], ["fp"]).select("fp", "root", "component_id")
    return lookup_join(hashed, per_fp, ["fp"], ["doc_id"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = MAX_DISTANCE
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links of at most `k` differing bits reach. Null,
    empty and blank texts have fingerprint zero and are linked like any other. A row without
    doc_id gets its fingerprint, is linked with nothing and has a null component. Repeated rows
    stay repeated; unlike texts of one doc_id are not linked by it. Other columns are not read.
    An empty table gives no rows.
    """
    out = _grouped(cut_lineage(with_fingerprints(docs, id_col, text_col)), k)
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = MAX_DISTANCE) -> DataFrame:
    """`docs` without near-duplicates: of each component the row with the smallest doc_id stays,
    with all its columns; of rows that repeat that doc_id within the component the one whose text
    hashes lowest, once. Rows without doc_id stay, as do unlike texts of one doc_id.

    Texts are shuffled once: repeated rows are made one where they are read, and go by the key
    that those to be kept are looked up with.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    # a null text is an empty one here as in the fingerprint
    keyed = packed(docs, doc_id=F.col("doc_id").cast("long"), h=key)
    hashed = cut_lineage(
        with_fingerprints(docs.where("doc_id IS NOT NULL"), "doc_id", "text", key.alias("h"))
    )
    first = (
        _grouped(hashed, k)
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "h")).alias("first"))
        .select("first.doc_id", "first.h")
    )
    # the least of repeated rows; maps have no order
    pick = F.first if "map<" in docs.schema.simpleString() else F.min
    one = keyed.where("doc_id IS NOT NULL").groupBy("doc_id", "h").agg(pick("doc").alias("doc"))
    kept = one.join(first, ["doc_id", "h"], "left_semi")
    return unpacked(kept, docs.columns).unionByName(docs.where("doc_id IS NULL"))
