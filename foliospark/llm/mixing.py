"""Mix sources to target weights by systematic sampling.

Each document is expected `target / source size` times. Within a source the expected copies
are summed along an order by size, one random offset is added, and a document is emitted once
for each whole number its interval crosses. Along that order neighbours have like sizes, so
the words taken stay within about one document's size of the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import cut_lineage, packed, unpacked
from foliospark.operators.skew import lookup_join

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
SEED = 17
#: What a text is counted in: runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    # a word begins where a word character follows white space or the start
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = TOTAL_SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """(source, source_size) → (source, source_size, target): weights repeat along the sources'
    order by code point, null last; the total is `share` of all sizes; no target is above `most`
    times its source, and what a source cannot take goes to the rest by weight.

    With sources in the order of size / weight, those that are filled up form a prefix: a
    source is filled when the level that would spread the rest evenly reaches it. One row per
    source, so these windows are over few rows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    at = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    w = sizes.withColumn("_w", F.element_at(cycle, at + 1))
    room = (F.lit(float(most)) * F.col("source_size")).alias("_room")
    w = w.withColumn("_room", room)
    order = Window.orderBy(F.col("_room") / F.col("_w"), F.col("source").isNull(), "source")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("_room").over(ahead), F.lit(0.0))
    level = left / F.sum("_w").over(rest)
    w = w.withColumn("_full", F.col("_room") <= level * F.col("_w"))
    # the level of the first source that is not filled holds for all after it
    w = w.withColumn("_level", level)
    free = F.min(F.when(~F.col("_full"), F.struct(F.col("_room") / F.col("_w"), "_level"))).over(
        everything
    )
    even = free["_level"] * F.col("_w")
    return w.select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_room")).otherwise(even).alias("target"),
    )


def ranked(docs: DataFrame, along: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, *along) with `rank`, from 1 within each source, along size, then a hash
    of the id, then the columns `along`.

    Rows are sorted in range partitions; the rank within a partition is a running count, the
    offset of a (partition, source) comes from one count each. No task sees a whole source.
    The placement is fixed by a checkpoint.
    """
    order = [F.col("source").isNull(), F.col("source"), F.col("size").desc(), F.col("_h"), *map(F.col, along)]
    placed = cut_lineage(
        docs.withColumn("_h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "source", "size", *along, F.monotonically_increasing_id().alias("_at"))
    )
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part", "source").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # rows of a source are consecutive in a partition: one row per partition and source
    offsets = parts.select(
        "_part", F.col("source").alias("_s"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
    )
    joined = placed.alias("p").join(
        offsets.alias("o"),
        (F.col("p._part") == F.col("o._part")) & F.col("p.source").eqNullSafe(F.col("o._s")),
    )
    return joined.select(
        "doc_id", "source", "size", *along, (F.col("_base") + F.col("_at") - F.col("_first") + 1).alias("rank")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = TOTAL_SHARE,
    most: float = MOST_COPIES,
    seed: int = SEED,
    along: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken.

    Size is the number of words of the whole text (null: 0). Sources may be null. A source of
    size 0 has target 0 and no copies. Repeated rows each count. The offset of a source is a
    hash of its name and `seed`, so that reruns agree. Columns `along` are kept and tell rows of one
    doc_id apart; others are not read. An empty table gives no rows.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *along)
    rows = ranked(sized, along)
    # the sizes come from the checkpointed ranks: the texts are read once
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sums, weights, share, most).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_key"), "source_size", "target",
    )
    # every document of a source has the same key; the copies of its one row are spread
    keyed = rows.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    out = lookup_join(keyed, plan, ["_key"], ["doc_id", "rank"])
    offset = source_offset(F.col("_key"), seed)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = lambda rank: F.floor(rank * rate + offset)
    copies = (upto(F.col("rank")) - upto(F.col("rank") - 1)).cast("long")
    return out.select(
        "doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *along,
    )


def source_offset(key: Column, seed: int) -> Column:
    """The source's place in [0, 1): the leading 32 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


#: Copies of one document that one task writes.
COPIES_AT_ONCE = 1000


def apply(docs: DataFrame, **how) -> DataFrame:
    """`docs` with every row repeated as often as the mix takes it, columns unchanged.

    Rows are told apart by doc_id, source and text; rows that repeat all three take copies of any one
    of them together. Rows without doc_id are told apart by source and text.

    Whatever share of the rows one doc_id has, its texts go to different tasks; repeated rows are
    made one where they are read, and their copies are written by as many tasks as it takes.
    """
    told = {
        "id": F.coalesce(F.col("doc_id").cast("string"), F.lit("?")),
        "h": F.xxhash64("source", "text"),
    }
    slim = docs.select(told["id"].alias("doc_id"), "source", "text", told["h"].alias("h"))
    taken = mix(slim, along=["h"], **how)
    per_row = cut_lineage(
        taken.groupBy(F.col("doc_id").alias("id"), "h").agg(
            F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n_rows")
        )
    )
    rows = packed(docs, **told)
    wanted = per_row.where("copies > 0")
    single = rows.join(wanted.where("n_rows = 1"), ["id", "h"])
    out = single.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    repeated = wanted.where("n_rows > 1")
    if not repeated.isEmpty():
        pick = F.first if "map<" in docs.schema.simpleString() else F.min
        # made one before the shuffle, and only then looked up
        one = rows.groupBy("id", "h").agg(pick("doc").alias("doc")).join(repeated, ["id", "h"])
        lots = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE))
        dealt = one.withColumn("lot", F.explode(lots)).repartition("id", "h", "lot")
        left = F.least(F.col("copies") - F.col("lot") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE))
        many = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), left.cast("int"))))
        out = out.select("doc").unionByName(many.select("doc"))
    return unpacked(out, docs.columns)
