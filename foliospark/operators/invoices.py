"""Invoice texts to header fields and line items.

Everything about one document is computed in its own row (an invoice's lines are bounded by
its text), so parsing a corpus needs no shuffle at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import dates as D
from foliospark.functions import money as M
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.functions.patterns import SEARCH_LINES, tame_spaces, with_ranked_search
from foliospark.operators.classify import ordered_keyword_class

HEADER_PATTERNS = {
    "invoice_number": rules.INVOICE_NUMBER_PATTERNS,
    "invoice_date": rules.INVOICE_DATE_PATTERNS,
    "total_amount": rules.INVOICE_TOTAL_PATTERNS,
    "vendor_name": rules.VENDOR_PATTERNS,
}
# What any match of the line patterns contains; cheap to test on texts without line items.
_COLUMNS_MARK = r"\s\s\d+(?:\.\d+)?\s\s"
_AT_MARK = r"\d\s+@\s"


def _rank_confidence(rank: Column, depth: int) -> Column:
    chosen = F.when(rank == 0, 1.0)
    for i in range(1, depth):
        chosen = chosen.when(rank == i, 1.0 - i * rules.RANK_STEP)
    return chosen


def header_fields(df: DataFrame, text: str = "text", this_year: int = 2024) -> DataFrame:
    """Add invoice_number, invoice_date, total_amount, vendor_name and `<field>_confidence`.

    A confidence is present only where the value could be read. `this_year` places two-digit
    years.
    """
    raw = {f"_{f}_text": p for f, p in HEADER_PATTERNS.items()}
    found = with_ranked_search(df, text, raw)
    values = {
        "invoice_number": T.strip(F.col("_invoice_number_text")),
        "invoice_date": D.loose_date(F.col("_date_clean"), this_year),
        "total_amount": M.parse_number(F.replace("_total_amount_text", F.lit(","), F.lit(""))),
        "vendor_name": T.title_case(T.strip(F.col("_vendor_name_text"))),
    }
    found = found.withColumn("_date_clean", T.strip(F.col("_invoice_date_text"))).withColumns(values)
    return found.withColumns(
        {
            f"{f}_confidence": F.when(
                F.col(f).isNotNull(), _rank_confidence(F.col(f"_{f}_text_rank"), len(patterns))
            )
            for f, patterns in HEADER_PATTERNS.items()
        }
    ).drop("_date_clean", *raw, *(f"{r}_rank" for r in raw))


# Between the groups of a match: characters that the pattern's own groups cannot contain. No group is
# empty, so two of them end a match.
_SEPARATORS = ("\x01", "\n")
_MARKS = (_COLUMNS_MARK, _AT_MARK)


def _without_groups(pattern: str) -> str:
    return re.sub(r"(?<!\\)\((?!\?)", "(?:", pattern)


def _skip(rank: int, pattern: str) -> str:
    """Alternatives that pass over what starts no match.

    Layout 0: a run of the description's characters ends where the quantity must begin, two spaces
    after the last word; if no digit is there, no letter of the run starts a match. Layout 1: if the
    first letter of a line starts no match, no later letter of the line does.
    """
    if rank == 0:
        run = r"[A-Za-z][A-Za-z\s\-&\(\)]*+"
        return rf"[^A-Za-z]++|{run}(?!(?<=\s\s)\d)|(?!{_without_groups(pattern)})[A-Za-z]"
    return rf"[^A-Za-z\n]++|\n++|(?!{_without_groups(pattern)})[A-Za-z][^\n]*+"


def _matches(text: Column, rank: int) -> Column:
    """ARRAY of the matches of a layout, each as its four groups; all are found in one pass.

    The text is replaced by the groups of its matches. Every search skips to the next match or to the
    end, so that no part of the text is searched twice; empty elements may stand for no match.
    """
    pattern, sep = tame_spaces(rules.LINE_ITEM_PATTERNS[rank]), _SEPARATORS[rank]
    search = rf"{SEARCH_LINES}(?:{_skip(rank, pattern)})*+(?:{pattern}|\z)"
    groups = sep.join(f"${i}" for i in range(1, 5)) + 2 * sep
    every = F.split(F.rtrim(F.regexp_replace(text, search, groups), F.lit(sep)), 2 * sep)
    return F.when(text.rlike(SEARCH_LINES + _MARKS[rank]), F.transform(every, lambda m: F.split(m, sep)))


def _item_of(rank: int) -> Callable[[Column], Column]:
    confidence = rules.LINE_BASE_CONFIDENCE - rank * rules.RANK_STEP

    def number(text: Column) -> Column:
        return F.replace(text, F.lit(","), F.lit("")).try_cast("double")

    return lambda g: F.struct(
        T.strip(T.title_case(F.get(g, F.lit(0)))).alias("description"),
        number(F.get(g, F.lit(1))).alias("quantity"),
        number(F.get(g, F.lit(2))).alias("unit_price"),
        number(F.get(g, F.lit(3))).alias("total_price"),
        F.lit(confidence).alias("confidence"),
        F.lit(False).alias("price_corrected"),
    )


def line_items(text: Column) -> Column:
    """ARRAY of line items: all matches of both layouts with positive numbers."""
    empty = F.array().cast("array<array<string>>")
    per_layout = [
        F.transform(F.coalesce(_matches(text, rank), empty), _item_of(rank))
        for rank in range(len(rules.LINE_ITEM_PATTERNS))
    ]
    return F.filter(
        F.concat(*per_layout),
        lambda i: (i["quantity"] > 0) & (i["unit_price"] > 0) & (i["total_price"] > 0),
    )


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def overall_confidence(header: Column, lines: Column) -> Column:
    """Weighted blend of two mean confidences; the larger one where the other is 0."""
    blend = header * rules.HEADER_WEIGHT + lines * rules.LINE_WEIGHT
    return F.when((header > 0) & (lines > 0), blend).otherwise(F.greatest(header, lines))


def parse_invoices(df: DataFrame, text: str = "text", this_year: int = 2024) -> DataFrame:
    """Add basic_fields (with its confidence map), line_items and overall_confidence."""
    parsed = header_fields(df, text, this_year).withColumn("line_items", line_items(F.col(text)))
    parsed = bind(parsed, ["line_items"])
    confs = {f: F.col(f"{f}_confidence") for f in HEADER_PATTERNS}
    scores = F.map_from_entries(
        F.array_compact(
            F.array(
                *(F.when(c.isNotNull(), F.struct(F.lit(f).alias("key"), c.alias("value"))) for f, c in confs.items())
            )
        )
    )
    parsed = parsed.withColumns(
        {
            "_header": _mean(F.array_compact(F.array(*confs.values()))),
            "_lines": _mean(F.transform("line_items", lambda i: i["confidence"])),
        }
    )
    basic = F.struct(
        "invoice_number", "invoice_date", "total_amount", "vendor_name",
        scores.alias("confidence_scores"),
    )
    done = parsed.select(
        *df.columns,
        overall_confidence(F.col("_header"), F.col("_lines")).alias("overall_confidence"),
        basic.alias("basic_fields"),
        "line_items",
    )
    return bind(done, ["overall_confidence", "basic_fields"])


def tax_amount(df: DataFrame, text: str = "text") -> DataFrame:
    """Add tax_amount and its confidence (an opt-in field of the parser)."""
    found = with_ranked_search(df, text, {"_tax_text": rules.TAX_PATTERNS})
    value = M.parse_number(F.replace("_tax_text", F.lit(","), F.lit("")))
    return found.withColumn("tax_amount", value).withColumn(
        "tax_confidence",
        F.when(
            F.col("tax_amount").isNotNull(),
            _rank_confidence(F.col("_tax_text_rank"), len(rules.TAX_PATTERNS)),
        ),
    ).drop("_tax_text", "_tax_text_rank")


def select_invoices(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents with text that the ordered classifier takes for invoices."""
    return df.where(F.length(text) > 0).where(ordered_keyword_class(F.col(text)) == "invoice")


def confident(parsed: DataFrame, floor: float = rules.MIN_INVOICE_CONFIDENCE) -> DataFrame:
    return parsed.where(F.col("overall_confidence") >= floor)
