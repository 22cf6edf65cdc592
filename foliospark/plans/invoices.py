"""From invoice texts to consolidated tables, in one pass per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import invoices as I
from foliospark.operators import validate as V
from foliospark.operators.classify import ordered_keyword_class


def validated_invoices(texts: DataFrame, this_year: int = 2024, strict: bool = True) -> DataFrame:
    """Invoices among `texts` (source_file, text) that were read with enough confidence.

    The type test comes first, so the parser's patterns only see invoices.
    """
    parsed = I.parse_invoices(I.select_invoices(texts), "text", this_year)
    return V.validate_invoices(I.confident(parsed), strict)


def invoice_outcomes(texts: DataFrame, this_year: int = 2024, strict: bool = True) -> DataFrame:
    """What became of every document: no_text, other_type, low_confidence, invalid or valid."""
    blank = F.coalesce(F.length("text"), F.lit(0)) == 0
    typed = texts.withColumn("_class", F.when(~blank, ordered_keyword_class(F.col("text"))))
    invoice = F.coalesce(F.col("_class") == "invoice", F.lit(False))
    masked = typed.withColumn("text", F.when(invoice, F.col("text")))
    checked = V.validate_invoices(I.parse_invoices(masked, "text", this_year), strict)
    return checked.select(
        "source_file",
        F.when(F.col("_class").isNull(), "no_text")
        .when(~invoice, "other_type")
        .when(F.col("overall_confidence") < rules.MIN_INVOICE_CONFIDENCE, "low_confidence")
        .when(F.col("validation.passed"), "valid")
        .otherwise("invalid")
        .alias("outcome"),
    )
