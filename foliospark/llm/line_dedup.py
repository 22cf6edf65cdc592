"""Delete runs of lines that repeat an earlier run of at least so many words.

Lines are compared trimmed; blank ones are not counted. From every line of a document a
window is drawn to the line at which it reaches `min_words` words, forwards and backwards. The
smallest line hash of each forward window is a fingerprint (winnowing): two documents that
share a run of `min_words` words share a whole window and so select the same line in it.
Windows at fingerprints that occur once are dropped. The rest are the two ways of extending a
matched position until it holds `min_words` words; those of equal content are joined to
their first occurrence, and lines covered by a later occurrence are deleted. Every line of a
repeated run of that length lies in one of its windows, so the deleted lines are the
union of all repeated runs, found without pairing the occurrences of a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.binding import bind, let
from foliospark.llm.common import cut_lineage, packed, unpacked, with_group

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"
_EDGES = "\t\x0b\x0c\r "


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


DOC = ("doc_id", "text_hash")


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, pos, words, h1, h2) of each line that is not blank: its position in
    the text, its number of words, and two 64-bit hashes of the trimmed line."""
    lines = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text")))
    )
    trimmed = lines.select(*DOC, "pos", F.btrim(F.col("col"), F.lit(_EDGES)).alias("line"))
    hashed = trimmed.where("line <> ''").select(
        *DOC,
        "pos",
        F.regexp_count("line", F.lit(_WORD)).cast("long").alias("words"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )
    # repeated rows are one document; their lines are made one before they are shuffled
    return hashed.dropDuplicates([*DOC, "pos"])


def windows(rows: DataFrame, min_words: int) -> DataFrame:
    """Both windows of each line that reach `min_words`, one row each: the document, start,
    stop, fp (the fingerprint line's hash), k1 and k2 (hashes of the content), and new: 1 if
    the window selects another position than the window before it."""
    by_doc = Window.partitionBy(*DOC)
    rows = rows.withColumn("upto", F.sum("words").over(by_doc.orderBy("pos")))
    rows = rows.withColumn("at", F.col("upto") - F.col("words"))
    # lines that begin within min_words words of this one's start, or end so near its end
    ahead = by_doc.orderBy("at").rangeBetween(0, min_words - 1)
    behind = by_doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    line = F.struct("h1", "h2")
    # of equal minima the rightmost
    least = F.min(F.struct(F.col("h1"), (-F.col("pos")).alias("left")))
    wide = rows.select(
        *DOC, "pos", "at", "upto",
        F.collect_list(line).over(ahead).alias("next_lines"),
        F.max("pos").over(ahead).alias("stop"),
        F.max("upto").over(ahead).alias("stop_upto"),
        least.over(ahead).alias("low"),
        F.collect_list(line).over(behind).alias("last_lines"),
        F.min("pos").over(behind).alias("start"),
        F.min("at").over(behind).alias("start_at"),
    )
    # a backward window holds the forward window of its first line, and so that fingerprint
    wide = wide.withColumn("back_low", F.first("low").over(behind))
    before = F.lag("low.left").over(by_doc.orderBy("at"))
    wide = wide.withColumn("moved", F.coalesce(before != F.col("low.left"), F.lit(True)))

    def window(start, stop, lines, low, new, held):
        return F.struct(
            F.col(start).alias("start"), F.col(stop).alias("stop"),
            F.col(f"{low}.h1").alias("fp"), new.cast("int").alias("new"), held.alias("held"),
            F.xxhash64(F.col(lines)["h1"]).alias("k1"), F.xxhash64(F.col(lines)["h2"]).alias("k2"),
        )

    both = F.array(
        window("pos", "stop", "next_lines", "low", F.col("moved"), F.col("stop_upto") - F.col("at")),
        window("start", "pos", "last_lines", "back_low", F.lit(0), F.col("upto") - F.col("start_at")),
    )
    return wide.select(*DOC, F.inline(both)).where(F.col("held") >= min_words).drop("held")


def repeated_ranges(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The document with start and stop: ranges of lines that repeat an earlier occurrence."""
    place = [*DOC, "start"]
    matched = with_group(
        windows(line_rows(docs), min_words), ["fp"], place,
        [F.sum("new").alias("_p")], [F.sum("_p").alias("_positions")], F.col("_positions") > 1,
    )
    matched = cut_lineage(matched.select(*place, "stop", "k1", "k2"))
    extended = with_group(
        matched, ["k1", "k2"], place,
        [F.min(F.struct(*place)).alias("_f")], [F.min("_f").alias("_first")],
    )
    return extended.where(F.struct(*place) > F.col("_first")).select(*place, "stop")


def remove_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, counted: bool = False
) -> DataFrame:
    """`docs` with `text` without its repeated runs of lines, and `n_lines_deleted` if `counted`.

    All rows and columns stay. Of equal runs the one in the smallest doc_id, and there the
    earliest, stays; a run that overlaps its own earlier occurrence within a document is deleted
    from where it repeats. Blank lines inside a deleted run go with it and are counted. Null and
    empty texts stay as they are; a text of which nothing is left becomes empty. Rows equal in
    doc_id and text are one document and change alike; rows that share only the doc_id are told
    apart by a hash of their text. Rows without doc_id are neither searched nor changed. An
    empty table gives no rows.
    """
    gone = (
        repeated_ranges(docs.select(F.col("doc_id"), F.col("text")), min_words)
        .distinct()
        .groupBy(*DOC)
        # at most two ranges for each line of one document
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    )
    joined = packed(docs, doc_id=F.col("doc_id"), text_hash=F.xxhash64("text")).join(
        gone, list(DOC), "left"
    )
    text = F.col("doc")["text"]

    def rebuilt(lines: Column) -> Column:
        deleted = F.flatten(F.transform("ranges", lambda r: F.sequence(r["start"], r["stop"])))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), deleted)
        return F.struct(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("text"),
            (F.size(lines) - F.size(kept)).cast("long").alias("n"),
        )

    new = F.when(F.col("ranges").isNotNull(), let(_lines(text), rebuilt))
    done = bind(joined.withColumn("new", new), ["new"])
    columns = list(docs.columns)
    if counted:
        columns = [c for c in columns if c != "n_lines_deleted"] + ["n_lines_deleted"]
    return unpacked(
        done, columns,
        text=F.when(F.col("new").isNotNull(), F.col("new")["text"]).otherwise(text),
        n_lines_deleted=F.coalesce(F.col("new")["n"], F.lit(0)),
    )
