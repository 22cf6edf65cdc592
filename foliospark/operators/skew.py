"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.binding import let

MIN_SALTS = 32


def salts_for(df: DataFrame) -> int:
    """As many sub-keys as the session has shuffle partitions.

    A hot key is then spread over every task, however many there are; more sub-keys cost
    nothing for rare keys, which only ever use as many as they have rows.
    """
    conf = df.sparkSession.conf
    counts = (
        conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None),
        conf.get("spark.sql.shuffle.partitions", None),
    )
    return max([MIN_SALTS, *(int(n) for n in counts if n and n.isdigit())])


def _salt(spread_by: Sequence[str], salts: int) -> Column:
    # never NULL, and known to be so: the optimizer then adds no null tests to one use only
    return F.coalesce(F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"), F.lit(0))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    salts: int | None = None,
    wide: bool = False,
) -> DataFrame:
    """Join `left` with a table that has one row per key, whatever the key frequencies in `left`.

    Rows of `left` are spread over `salts` sub-keys by a hash of `spread_by` (columns that
    differ within a key). Each right row is copied only to the sub-keys that occur, so rare
    keys cost one copy and a hot key at most `salts` (see `salts_for`). `how` is inner, left,
    left_semi or left_anti. `wide` rows of `right` (whole texts) are copied in two steps, to groups
    of sub-keys and from there, so that one task writes about the root of `salts` copies.
    """
    salts = salts or salts_for(left)
    if salts <= 1:
        return left.join(right, list(on), how)
    salted = left.withColumn("_salt", _salt(spread_by, salts))
    occurring = salted.select(*on, "_salt").distinct()
    if wide:
        group = (F.col("_salt") / F.lit(int(salts**0.5) or 1)).cast("int")
        occurring = occurring.withColumn("_group", group)
        copies = occurring.select(*on, "_group").distinct().join(right, list(on), "inner")
        copies = occurring.join(copies, [*on, "_group"], "inner").drop("_group")
    else:
        copies = occurring.join(right, list(on), "inner")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def groups_of(df: DataFrame, keys: Sequence[str], min_rows: int = 2) -> DataFrame:
    """Key and row count of every group with at least `min_rows` rows.

    Counting is combined before the shuffle, so a hot key costs one row per task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_rows"))
        .where(F.col("group_rows") >= min_rows)
    )


def rows_of_groups(
    df: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    min_rows: int = 2,
    salts: int | None = None,
) -> DataFrame:
    """Rows whose key occurs at least `min_rows` times, with `group_rows`, the size of the group.

    Same balance as `lookup_join`, but sizes and sub-keys come from one shuffled count.
    """
    salted = df.withColumn("_salt", _salt(spread_by, salts or salts_for(df)))
    parts = salted.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    sizes = (
        parts.groupBy(*keys)
        .agg(F.sum("_n").alias("group_rows"))
        .where(F.col("group_rows") >= min_rows)
    )
    # the filter keeps both uses of `parts` identical, so that their shuffle is shared
    copies = parts.where(F.col("_n") > 0).join(sizes, list(keys)).drop("_n")
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


#: Keys that are drawn for each range, so that ranges hold about the same number of rows.
DRAWN_PER_RANGE = 20


def splitters(df: DataFrame, order_by: Sequence[str], ranges: int) -> Column:
    """A scalar subquery: the sorted keys, as structs, that cut `df` into about `ranges` ranges (`fine`),
    and about every root-th of them (`coarse`), for two short looks in place of a long one.

    Of each of `DRAWN_PER_RANGE * ranges` hash cells of the keys that of the lowest hash is drawn: a
    uniform draw of bounded size, the same one whenever it is computed.
    """
    cells = DRAWN_PER_RANGE * ranges
    key = F.struct(*order_by)
    cell = F.pmod(F.xxhash64(*order_by), F.lit(cells))
    drawn = df.groupBy(cell.alias("_cell")).agg(
        F.min(F.struct(F.xxhash64(F.lit(1), *order_by).alias("_h"), key.alias("_k")))["_k"].alias("_k")
    )
    listed = drawn.agg(F.collect_list("_k").alias("_l"))  # one for each cell at most
    # sorted once, and the step taken once: a lambda would do either again for each element
    every = lambda n: lambda k, i: i % n == 0
    step = lambda l: F.greatest(F.lit(1), F.floor(F.size(l) / F.lit(ranges)).cast("int"))
    fine = let(
        F.sort_array("_l"),
        lambda l: let(step(l), lambda n: F.slice(F.filter(l, every(n)), 2, F.greatest(F.size(l), F.lit(1)))),
    )
    both = let(fine, lambda f: F.struct(f.alias("fine"), F.filter(f, every(_width(ranges))).alias("coarse")))
    return listed.select(both).scalar()


def _width(ranges: int) -> int:
    return max(1, int(ranges**0.5))


def _range_of(key: Column, cuts: Column, ranges: int) -> Column:
    """How many of the sorted cuts are at or below the key."""
    width = _width(ranges)
    below = lambda some: F.size(F.filter(some, lambda c: c <= key))
    fine = lambda n: (n - 1) * width + below(F.slice(cuts["fine"], (n - 1) * width + 1, width))
    return let(below(cuts["coarse"]), lambda n: F.when(n == 0, 0).otherwise(fine(n)))


def with_range(df: DataFrame, order_by: Sequence[str], ranges: int, name: str) -> DataFrame:
    """Add the number of the key range that a row is in, from 0."""
    cuts = df.withColumn("_cuts", splitters(df, order_by, ranges))
    return cuts.withColumn(name, _range_of(F.struct(*order_by), F.col("_cuts"), ranges)).drop("_cuts")


def with_running(
    df: DataFrame, order_by: Sequence[str], value: Column, name: str, upto: int | None = None
) -> DataFrame:
    """Add the running sum of `value` (numbers above zero) in the order of unique keys, the row itself
    included, without one task seeing all rows.

    Rows are cut into key ranges; what lies before a range is the sum of one number for each range
    before it. Which range a row is in is a function of its key and of `splitters`, so all uses
    agree, nothing is computed while the frame is built, and a lost task can be run again. `upto`
    leaves out rows beyond that sum, and does not sort the ranges that hold only such.
    """
    ranges = salts_for(df)
    ranged = with_range(df, order_by, ranges, "_part")
    sizes = ranged.groupBy("_part").agg(F.sum(value).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range: bounded by the number of shuffle partitions
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = ranged.join(F.broadcast(offsets), "_part")
    if upto is not None:
        placed = placed.where(F.col("_base") < upto)
    within = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumn(name, F.col("_base") + F.sum(value).over(within)).drop("_part", "_base")
    return out if upto is None else out.where(F.col(name) <= upto)


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str, upto: int | None = None) -> DataFrame:
    """Number all rows from 1 in the order of unique keys; see `with_running`."""
    return with_running(df, order_by, F.lit(1), name, upto)
