"""How document filters interact: survivors of every subset, from truth-table words.

A document that fails the filters of mask f survives the subset s if `s & f` is 0. Its word has
one bit for each of the subsets (32 for five filters). Added up by place, over all documents of a
part and a label, the words give how many documents each subset leaves, and every figure of every
order of the filters is a difference of two such counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import cut_lineage, ship_code, with_group
from foliospark.operators.skew import lookup_join

#: Names of the filters; the bit of a mask is the place of its letter. E, exact copies, is last.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 200
_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(128, 192))
_SIGNS = b"#$%&*|"

#: Whether a text fails, given its bytes, its words and the number of its code points.
Test = Callable[[bytes, list[bytes], int], bool]
TESTS: dict[str, Test] = {
    "A": lambda raw, words, size: len(words) < LEAST_WORDS,
    "B": lambda raw, words, size: 100 * len(set(words)) < 50 * len(words),
    "C": lambda raw, words, size: 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 2 * size,
    "D": lambda raw, words, size: len(raw.translate(None, _SIGNS)) < len(raw),
}


def failures(raw: bytes, tests: dict[str, Test] = TESTS) -> int:
    """Mask of the tests that a whole text, in UTF-8, fails."""
    # bytes are parted at exactly the six white-space characters of ASCII
    words, size = raw.split(), len(raw.translate(None, _CONTINUED))
    return sum(test(raw, words, size) << FILTERS.index(name) for name, test in tests.items())


def survival_words(masks: np.ndarray) -> np.ndarray:
    """Of each mask of failed filters the word whose bit s tells that subset s lets it pass."""
    subsets = np.arange(SUBSETS, dtype=np.uint32)
    table = [int(((subsets & m) == 0).astype(np.uint64) @ (np.uint64(1) << subsets.astype(np.uint64))) for m in range(SUBSETS)]
    return np.array(table, np.uint32)[masks]


def place_counts(words: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """How many of `words` have each bit set, each counted `times` (default once).

    Words wait in planes by their weight, a power of two. While a plane holds three or more,
    thirds of it go through a carry-save adder: the sums stay, the carries go to the next plane.
    """
    times = np.ones(len(words), np.int64) if times is None else times
    highest = int(times.max()).bit_length() if len(times) else 0
    planes = [words[(times >> k) & 1 == 1] for k in range(highest)]
    counts = np.zeros(SUBSETS, np.int64)
    k = 0
    while k < len(planes):
        plane = planes[k]
        while len(plane) >= 3:
            third = len(plane) // 3
            a, b, c = plane[:third], plane[third : 2 * third], plane[2 * third : 3 * third]
            odd = a ^ b
            if k + 1 == len(planes):
                planes.append(words[:0])
            planes[k + 1] = np.concatenate([planes[k + 1], (a & b) | (odd & c)])
            plane = np.concatenate([odd ^ c, plane[3 * third :]])
        for word in plane:
            counts += ((int(word) >> np.arange(SUBSETS)) & 1) << k
        k += 1
    return counts


def judged(docs: DataFrame, part: str = "source", tests: dict[str, Test] = TESTS) -> DataFrame:
    """(doc_id, part, failed, digest, n): distinct rows of the mask of the text's own failures and
    its 256-bit digest, with how often each occurs. Null texts and parts are empty ones."""
    slim = docs.select(
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(0):
                raw = value.as_py()
                masks.append(failures(raw, tests))
                digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                ["doc_id", "part", "failed", "digest"],
            )

    ship_code(docs)
    rows = slim.mapInArrow(run, "doc_id long, part string, failed int, digest binary")
    return rows.groupBy("doc_id", "part", "failed", "digest").agg(F.count(F.lit(1)).alias("n"))


def with_copies(rows: DataFrame) -> DataFrame:
    """`rows` with the bit of E set where a smaller doc_id has the same text. Rows without doc_id
    have no smaller one, and are none."""
    seen = with_group(
        cut_lineage(rows), ["digest"], ["doc_id"], [F.min("doc_id").alias("_p")], [F.min("_p").alias("_first")]
    )
    copy = F.coalesce(F.col("_first") < F.col("doc_id"), F.lit(False))
    bit = 1 << FILTERS.index("E")
    return seen.withColumn("failed", F.col("failed").bitwiseOR(F.when(copy, bit).otherwise(0))).drop("_first")


def survivors(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(part, kept_all, kept_<label>…): arrays of how many documents each subset leaves.
    `rows`: part, failed, n and a boolean column for each label."""
    names = ["all", *labels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, at = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            words = survival_words(batch.column(1).to_numpy())
            times = batch.column(2).to_numpy()
            held = [np.ones(len(words), bool)] + [c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]]
            order = np.argsort(at, kind="stable")
            made = []
            for rows_of in np.split(order, np.cumsum(np.bincount(at))[:-1]):
                made.append([place_counts(words[i], times[i]) for i in (rows_of[h[rows_of]] for h in held)])
            columns = [pa.array([str(p) for p in parts for _ in range(SUBSETS)]), pa.array(list(range(SUBSETS)) * len(parts), pa.int32())]
            columns += [pa.array(np.concatenate([m[k] for m in made]), pa.int64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "subset", *names])

    slim = rows.select("part", F.col("failed").cast("int"), "n", *labels)
    counted = slim.mapInArrow(run, "part string, subset int, " + ", ".join(f"{n} long" for n in names))
    whole = counted.groupBy("part", "subset").agg(*(F.sum(n).alias(n) for n in names))
    # one element for each subset
    listed = whole.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", *names))).alias("_s"))
    return listed.select("part", *(F.col(f"_s.{n}").alias(f"kept_{n}") for n in names))


def orders(filters: str = FILTERS) -> Column:
    """An array of (filter_order, step, letter, before, after): every step of every order, with the
    subsets that are in force before and after it."""
    steps = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            after = before | 1 << FILTERS.index(letter)
            values = {"filter_order": "".join(order), "step": step, "letter": FILTERS.index(letter), "before": before, "after": after}
            steps.append(F.struct(*(F.lit(v).alias(k) for k, v in values.items())))
            before = after
    return F.array(*steps)


def _shapley(letter: int) -> Column:
    """What the filter removes, added up over all orders: each subset without it comes before it in
    |s|! (others - |s|)! of them."""
    out = F.lit(0).cast("long")
    for s in range(SUBSETS):
        if not s >> letter & 1:
            size = s.bit_count()
            times = factorial(size) * factorial(len(FILTERS) - 1 - size)
            out = out + (F.col("kept_all")[s] - F.col("kept_all")[s | 1 << letter]) * F.lit(times)
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    Null texts are empty, a null `part` is an empty one, labels of several rows for a doc_id count
    if any row has them, documents without labels and labels without documents count as having
    none. Repeated rows count as often as they occur; a row is a copy only of a smaller doc_id, so
    rows that share one are not copies of each other, and rows without doc_id are no copies and
    have no labels. Other columns are not read. An empty table gives no rows.

    Hot texts, ids and parts are combined before they are shuffled, and spread over sub-keys where
    they are joined.
    """
    rows = with_copies(judged(docs, part))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    named = lookup_join(rows, known, ["doc_id"], ["digest"])
    named = named.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    counted = survivors(named, ["good", "toxic"])
    everything = SUBSETS - 1
    shapley = F.array(*(_shapley(i) for i in range(len(FILTERS))))
    last = F.array(*(F.col("kept_all")[everything ^ 1 << i] - F.col("kept_all")[everything] for i in range(len(FILTERS))))
    failing = F.array(*(F.col("kept_all")[0] - F.col("kept_all")[1 << i] for i in range(len(FILTERS))))
    each = counted.withColumns({"_shapley": shapley, "_unique": last, "_failing": failing}).select("*", F.inline(orders()))
    lost = lambda name: F.col(f"kept_{name}")[F.col("before")] - F.col(f"kept_{name}")[F.col("after")]
    return each.select(
        "part",
        "filter_order",
        "step",
        F.col("kept_all")[F.col("after")].alias("kept"),
        lost("all").alias("removed"),
        (F.col("_failing")[F.col("letter")] - lost("all")).alias("redundant"),
        F.col("_unique")[F.col("letter")].alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.col("_shapley")[F.col("letter")].alias("shapley"),
    )
