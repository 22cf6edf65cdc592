"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line. Its leaves are pieces of up to four words, each ending early at the end
of a sentence, so that an edit shifts pieces only up to the next sentence. A section
ends after a paragraph whose digest says so (one in four), so that sections too find
together again after an edit. Every node's digest is made from those of its children; equal roots
mean equal texts, and unequal ones are followed down to the leaves that differ.

A fingerprint is a string of tokens parted by spaces: the root (32 hex digits), then in page order
`S` and `P` with eight digits for each section and paragraph, and six digits for each leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.binding import bind, let
from foliospark.operators.skew import salts_for, with_range

_S, _W = r"\x20\x09-\x0D", r"^\x20\x09-\x0D"
#: Up to three words that end no sentence and one more, with the white space around them.
LEAF = rf"[{_S}]*(?:[{_W}]*[{_W}.!?][{_S}]+){{0,3}}[{_W}]+[{_S}]*"
#: Ranges for each shuffle partition, so that partitions get even shares.
BUCKETS_PER_PARTITION = 4


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty."""

    def paragraph(p: Column) -> Column:
        pieces = F.regexp_extract_all(p, F.lit(LEAF), F.lit(0))
        # a line of white space only is its own single leaf
        whole = F.when(F.size(pieces) > 0, pieces).otherwise(F.array(p))
        return let(
            F.transform(whole, lambda x: F.md5(x)),
            lambda digests: F.struct(
                F.md5(F.array_join(digests, "")).alias("digest"),
                F.array_join(F.transform(digests, lambda d: F.substring(d, 1, 6)), " ").alias("leaves"),
            ),
        )

    def tree(paragraphs: Column) -> Column:
        # both lists are cut into sections at the same places
        ends = lambda p: F.when(F.substring(p["digest"], 1, 1) < "4", "|").otherwise(" ")
        digests = F.array_join(F.transform(paragraphs, lambda p: F.concat(p["digest"], ends(p))), "")
        tokens = F.array_join(
            F.transform(
                paragraphs,
                lambda p: F.concat(F.lit("P"), F.substring(p["digest"], 1, 8), F.lit(" "), p["leaves"], ends(p)),
            ),
            "",
        )
        sections = F.zip_with(
            _sections(digests),
            _sections(tokens),
            lambda d, t: F.struct(F.md5(d).alias("digest"), t.alias("tokens")),
        )
        return let(
            sections,
            lambda s: F.concat_ws(
                " ",
                F.md5(F.array_join(F.transform(s, lambda x: x["digest"]), "")),
                F.array_join(
                    F.transform(s, lambda x: F.concat(F.lit("S"), F.substring(x["digest"], 1, 8), F.lit(" "), x["tokens"])),
                    " ",
                ),
            ),
        )

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return let(F.transform(lines, paragraph), tree)


def _sections(joined: Column) -> Column:
    parts = F.split(joined, r"\|", -1)
    return F.filter(F.transform(parts, lambda x: F.btrim(x)), lambda x: x != "")


def root(fp: Column) -> Column:
    return F.substring(fp, 1, 32)


def leaves(fp: Column) -> Column:
    return F.filter(F.split(fp, " "), lambda t: F.length(t) == 6)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the Dice coefficient of the sets of leaves, from 0 to 1."""

    def dice(both: Column) -> Column:
        x, y = both["x"], both["y"]
        shared = F.size(F.array_intersect(x, y)).cast("double")
        return 2 * shared / (F.size(x) + F.size(y))

    sets = F.struct(F.array_distinct(leaves(a)).alias("x"), F.array_distinct(leaves(b)).alias("y"))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(let(sets, dice))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Positions, from 0, of the paragraphs of `a` that lie in sections `b` lacks and that `b`
    lacks themselves; none if the roots are equal."""
    section_of = lambda fp: F.split(F.concat(F.lit(" "), F.substring(fp, 34, F.length(fp))), " S")

    def below(other: Column) -> Column:
        known = F.filter(F.split(other, " "), lambda t: F.length(t) >= 9)
        mine = F.flatten(
            F.transform(
                F.filter(section_of(a), lambda s: s != ""),
                lambda s: F.transform(
                    F.filter(F.split(s, " "), lambda t: F.substring(t, 1, 1) == "P"),
                    lambda p: F.struct(
                        p.alias("p"),
                        F.array_contains(known, F.concat(F.lit("S"), F.substring(s, 1, 8))).alias("same"),
                    ),
                ),
            )
        )
        marked = F.transform(
            mine,
            lambda x, i: F.struct(i.alias("i"), (~x["same"] & ~F.array_contains(known, x["p"])).alias("off")),
        )
        return F.transform(F.filter(marked, lambda x: x["off"]), lambda x: x["i"])

    empty = F.array().cast("array<int>")
    return F.when(root(a) == root(b), empty).otherwise(let(b, below))


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; null texts count as empty. No shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), fingerprint(text).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint): the row and the one after it in
    descending doc_id, rows of one doc_id in the order of a hash of their texts; after the last
    comes the first. Rows without doc_id have an empty next text.

    Rows are cut into ranges of doc_id and that hash; each range also gets the first row of the one
    that follows as a guest. So the texts move once, and no task sees more than a range, whatever
    share of the rows one doc_id has (rows that repeat id and text are in one range).
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # ids in descending order, without the overflow of a minus sign
    key = {"_k": F.bitwise_not("doc_id"), "_h": F.xxhash64("text")}
    named = slim.where("doc_id IS NOT NULL").withColumns(key)
    placed = with_range(named, list(key), BUCKETS_PER_PARTITION * salts_for(docs), "bucket")
    # one row for each range
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(*key)).alias("first"))
    order = Window.orderBy("bucket")
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = firsts.select(
        "bucket", F.coalesce(F.lead("first").over(order), F.first("first").over(around)).alias("guest")
    ).select("bucket", "guest.*")
    visiting = named.join(F.broadcast(guests), list(key)).dropDuplicates(["bucket"])
    rows = placed.withColumn("guest", F.lit(False)).unionByName(visiting.withColumn("guest", F.lit(True)))
    # fingerprints are made after the move, once for each row
    made = bind(
        rows.repartition("bucket").withColumn("fingerprint", fingerprint(F.col("text"))), ["fingerprint"]
    )
    after = Window.partitionBy("bucket").orderBy("guest", *key)
    led = made.withColumns(
        {"next_text": F.lead("text").over(after), "next_fingerprint": F.lead("fingerprint").over(after)}
    )
    own = led.where(~F.col("guest")).select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    lone = bind(slim.where("doc_id IS NULL").withColumn("fingerprint", fingerprint(F.col("text"))), ["fingerprint"])
    return own.unionByName(
        lone.withColumns({"next_text": F.lit(""), "next_fingerprint": fingerprint(F.lit(""))})
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, in which the last half of the
    characters is replaced by as many of the next document's first (all, if it has fewer).

    One row per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited text and to the next document). Null
    texts count as empty. Repeated rows stay; other columns are not read; an empty table gives
    no rows. A row without doc_id is edited with an empty text.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = bind(rows.withColumn("edited", edited).withColumn("n_chars", n.cast("long")).drop("text", "next_text"), ["edited"])
    rows = bind(rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"))), ["edited_fingerprint"])
    fp = F.col("fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(fp, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(fp, F.col("next_fingerprint")).alias("near_next"),
    )
