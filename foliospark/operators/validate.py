"""Checks and corrections of parsed invoices and of line-item tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import text as T
from foliospark.functions.binding import bind


def quantity_ok(quantity: Column) -> Column:
    return F.coalesce(quantity, F.lit(0.0)).between(rules.MIN_QUANTITY, rules.MAX_QUANTITY)


def unit_price_ok(price: Column) -> Column:
    return F.coalesce(price, F.lit(0.0)).between(rules.MIN_UNIT_PRICE, rules.MAX_UNIT_PRICE)


def needs_correction(quantity: Column, price: Column, total: Column) -> Column:
    return F.abs(total - quantity * price) > rules.TOTAL_TOLERANCE


def corrected_total(quantity: Column, price: Column, total: Column) -> Column:
    """Quantity times price, where the stated total differs from it noticeably."""
    return F.when(
        needs_correction(quantity, price, total), F.round(quantity * price, 2)
    ).otherwise(total)


def check_line_items(
    lines: DataFrame,
    description: str = "description",
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    total_price: str = "total_price",
) -> DataFrame:
    """For a table of lines: corrected total and flag, clean description, `valid` and warnings."""
    q, p, t, d = (F.col(c) for c in (quantity, unit_price, total_price, description))
    return lines.withColumns(
        {
            "_fix": F.coalesce(needs_correction(q, p, t), F.lit(False)),
            "_total": corrected_total(q, p, t),
            "warnings": _item_warnings(d, q, p),
            "valid": quantity_ok(q) & unit_price_ok(p),
            description: T.collapse_whitespace(d),
        }
    ).withColumns({total_price: F.col("_total"), "price_corrected": F.col("_fix")}).drop("_fix", "_total")


def dedup_line_items(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct lines within an invoice (an opt-in step); combined before the shuffle."""
    return lines.dropDuplicates(list(keys))


def _item_warnings(description: Column, quantity: Column, price: Column) -> Column:
    def message(what: str) -> Column:
        return F.concat(F.lit(f"Invalid {what} for item '"), description, F.lit("'"))

    return F.array_compact(
        F.array(
            F.when(~quantity_ok(quantity), message("quantity")),
            F.when(~unit_price_ok(price), message("unit price")),
        )
    )


def _clean_item(i: Column) -> Column:
    q, p, t = i["quantity"], i["unit_price"], i["total_price"]
    return F.struct(
        T.collapse_whitespace(i["description"]).alias("description"),
        q.alias("quantity"),
        p.alias("unit_price"),
        corrected_total(q, p, t).alias("total_price"),
        i["confidence"].alias("confidence"),
        needs_correction(q, p, t).alias("price_corrected"),
    )


def _item_ok(i: Column) -> Column:
    return quantity_ok(i["quantity"]) & unit_price_ok(i["unit_price"])


def validate_invoices(parsed: DataFrame, strict: bool = True) -> DataFrame:
    """Add `validation` (passed, errors, warnings) and `dropped_items`; clean `line_items`.

    Lines out of range are dropped with a warning; warnings do not fail an invoice.
    """
    number, date = F.col("basic_fields.invoice_number"), F.col("basic_fields.invoice_date")
    total = F.col("basic_fields.total_amount")
    checks = [F.when(total < 0, rules.ERROR_NEGATIVE_TOTAL)]
    if strict:
        checks = [
            F.when(F.coalesce(number, F.lit("")) == "", rules.ERROR_NO_NUMBER),
            F.when(F.coalesce(date, F.lit("")) == "", rules.ERROR_NO_DATE),
            *checks,
        ]
    checked = parsed.withColumns(
        {
            "_errors": F.array_compact(F.array(*checks)),
            "_warnings": F.flatten(
                F.transform(
                    "line_items",
                    lambda i: _item_warnings(i["description"], i["quantity"], i["unit_price"]),
                )
            ),
            "dropped_items": F.filter("line_items", lambda i: ~_item_ok(i)),
            "line_items": F.transform(F.filter("line_items", _item_ok), _clean_item),
        }
    )
    done = checked.withColumn(
        "validation",
        F.struct(
            (F.size("_errors") == 0).alias("passed"),
            F.col("_errors").alias("errors"),
            F.col("_warnings").alias("warnings"),
        ),
    ).drop("_errors", "_warnings")
    # only the lines are costly; unbound, warnings and dropped lines are left out where nobody asks
    return bind(done, ["line_items"])


def consolidated_invoices(validated: DataFrame) -> DataFrame:
    """One row per invoice that passed."""
    return validated.where("validation.passed").select(
        "source_file",
        "basic_fields.invoice_number", "basic_fields.invoice_date",
        "basic_fields.vendor_name", "basic_fields.total_amount",
        F.size("line_items").alias("line_items_count"),
    )


def consolidated_line_items(validated: DataFrame) -> DataFrame:
    """One row per valid line of the invoices that passed."""
    return (
        validated.where("validation.passed")
        .select(
            F.coalesce("basic_fields.invoice_number", F.lit("N/A")).alias("invoice_number"),
            F.explode("line_items").alias("_i"),
        )
        .select(
            "_i.description", "_i.quantity", "_i.unit_price", "_i.total_price", "_i.confidence",
            "_i.price_corrected", "invoice_number",
        )
    )
