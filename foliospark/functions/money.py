"""Money and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.text import strip

# What counts as a plain number: digits, in which underscores may stand between two digits. The
# guard matters: a bare cast would also take '12d' or 'NaN'. Only single characters repeat, so
# that a text of any length is tested in constant stack space.
_NUMBER = r"^[+-]?(?:[0-9][0-9_]*\.?[0-9_]*|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9][0-9_]*)?$"
_MISPLACED = r"__|_[.eE]|[.eE+-]_|_$"

MONEY = "decimal(24,6)"  # exact sums; a total over any number of rows stays within 38 digits


def _numeric_text(c: Column) -> Column:
    text = strip(c.cast("string"))
    number = text.rlike(_NUMBER) & ~text.rlike(_MISPLACED)
    return F.when(number, F.replace(text, F.lit("_"), F.lit("")))


def parse_number(c: Column) -> Column:
    """Number, or NULL when the text is not one."""
    return _numeric_text(c).try_cast("double")


def _without_symbols(c: Column) -> Column:
    return F.translate(c.cast("string"), "$,", "")


def parse_money(c: Column) -> Column:
    """Amount after dropping `$` and `,`; NULL when the rest is not a number."""
    return parse_number(_without_symbols(c))


def parse_money_exact(c: Column) -> Column:
    """Like `parse_money`, as a decimal; NULL also where the decimal would not hold the amount."""
    exact = _numeric_text(_without_symbols(c)).try_cast(MONEY)
    return F.when(exact.cast("double") == parse_money(c), exact)


def money_or_zero(c: Column) -> Column:
    return F.coalesce(parse_money(c), F.lit(0.0))
