"""Sums of doubles that do not depend on the order in which rows arrive.

A double is a whole number times a power of two. Cut into limbs of 32 bits at fixed powers of two, it
is a few whole numbers, which decimals add exactly; only the finished sums become a double again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.binding import let

LIMB_BITS = 32
#: A double's 53 bits touch three limbs; one more in case its power of two was taken one too high.
LIMBS = 4
LIMB = "struct<place:int,limb:decimal(38,0)>"


def _scaled(c: Column, limbs: Column) -> Column:
    """`c` times 2 ** (32 * limbs), in two steps, as the whole power may be beyond a double."""
    half = F.pow(F.lit(2.0), limbs * (LIMB_BITS // 2))
    return c * half * half


def limbs_of(c: Column) -> Column:
    """Array of (place, limb): `c` is the sum of limb * 2 ** (32 * place). Empty for zero, and NULL
    for NULL and for what is no finite number."""
    start = F.struct(c.alias("rest"), F.array().cast(f"array<{LIMB}>").alias("out"))

    def take(top: Column) -> Column:
        def one(state: Column, below: Column) -> Column:
            place = (top - below).cast("int")
            whole = _scaled(state["rest"], -place)
            whole = F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole))
            limb = F.struct(place.alias("place"), whole.cast("decimal(38,0)").alias("limb"))
            return F.struct(
                (state["rest"] - _scaled(whole.cast("double"), place)).alias("rest"),
                F.when(whole != 0, F.array_append(state["out"], limb)).otherwise(state["out"]).alias("out"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(LIMBS - 1)), start, one)["out"]

    top = F.floor(F.log2(F.abs(c)) / LIMB_BITS)
    finite = F.abs(c) < float("inf")
    return F.when(c == 0, F.array().cast(f"array<{LIMB}>")).when(finite, let(top, take))


def from_limbs(limbs: Column) -> Column:
    """The double that summed limbs stand for; places occur once. Added from the lowest place up."""
    ordered = F.array_sort(limbs)
    return F.aggregate(ordered, F.lit(0.0), lambda acc, x: acc + _scaled(x["limb"].cast("double"), x["place"]))


def exact_sums(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """One row per key with the sum of `value`: the same bits however rows are dealt out. NULL where a
    key has no finite value."""
    rows = df.select(*keys, F.explode(limbs_of(value)).alias("_l"))
    sums = rows.groupBy(*keys, F.col("_l.place").alias("place")).agg(F.sum("_l.limb").alias("limb"))
    # at most one limb for each power of two of 32 bits that doubles have
    return sums.groupBy(*keys).agg(from_limbs(F.collect_list(F.struct("place", "limb"))).alias(name))
