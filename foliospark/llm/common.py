"""Helpers that the operators share: group values for rows of hot keys, components, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.skew import salts_for
from foliospark.session import cut_lineage, ship_code

__all__ = ["components", "cut_lineage", "packed", "ship_code", "unpacked", "with_group"]

def with_group(
    df: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    partial: Sequence[Column],
    final: Sequence[Column],
    having: Column | None = None,
) -> DataFrame:
    """Attach values of its group to every row, whatever share of the rows one key holds.

    `partial` aggregates rows of a key and sub-key, `final` aggregates those results per key
    (both aliased; names must not occur in `df`). Rows with a null key, or whose group fails
    `having`, are left out. A hot key is spread over sub-keys by a hash of `spread_by`, and
    only one small row for each sub-key that occurs meets in one task.
    """
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.lit(salts_for(df))).cast("int"), F.lit(0))
    salted = df.withColumn("_salt", salt)
    parts = salted.groupBy(*keys, "_salt").agg(*partial)
    whole = parts.groupBy(*keys).agg(*final)
    if having is not None:
        whole = whole.where(having)
    copies = parts.select(*keys, "_salt").join(whole, list(keys))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """`docs` as one struct column `doc`, so that no name of its columns clashes with another."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    return docs.select(row, *(c.alias(name) for name, c in extra.items()))


def unpacked(df: DataFrame, columns: Sequence[str], **instead: Column) -> DataFrame:
    """The columns of a `packed` frame; those named in `instead` get that value."""
    return df.select(
        *(instead[c].alias(c) if c in instead else F.col("doc")[c].alias(c) for c in columns)
    )


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of undirected `edges` (a, b): one row (node, component) per node
    that has an edge to another, component being its smallest node.

    Alternates the large-star and small-star steps until every edge points at the smallest
    node of its component; the number of rounds grows with the logarithm of the longest path.
    Each round is written to the checkpoint folder. Neighbours are never gathered: only
    minima per node move. Edges with a null end and loops are ignored.
    """
    now = edges.select("a", "b").where("a <> b").distinct()
    now = cut_lineage(now)
    state = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        low = [F.min("b").alias("_p")]
        whole = [F.min("_p").alias("_m")]
        large = (
            with_group(both, ["a"], ["b"], low, whole)
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "_m").alias("b"))
        )
        down = large.where("a <> b").distinct()
        small = with_group(down, ["a"], ["b"], low, whole)
        now = cut_lineage(
            small.select("b", F.col("_m").alias("m"))
            .union(small.select("a", F.col("_m").alias("m")))
            .where("b <> m")
            .toDF("a", "b")
            .distinct()
        )
        # an edge set that a round leaves as it was is one star per component
        then, state = state, now.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(hash(b, a))")
        ).first()
        if then == state:
            return now.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.col("b").alias("component")
            ).union(now.select("b", "b").distinct())
    raise RuntimeError(f"components are not settled after {max_rounds} rounds")
