"""JSON answers and records, read through the variant type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def outermost_object(text: Column) -> Column:
    """Text from the first `{` to the last `}`; an empty object when there is none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found == "", F.lit("{}")).otherwise(found)


def parse_object(text: Column) -> Column:
    """Variant, or NULL when the text is not JSON."""
    return F.try_parse_json(text)


def has_key(v: Column, key: str) -> Column:
    """Present, even if its value is null."""
    return F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


def get_string(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "string")


def get_strings(v: Column, key: str) -> Column:
    """Array of strings; a single string becomes an array of one."""
    many = F.try_variant_get(v, f"$.{key}", "array<string>")
    one = F.try_variant_get(v, f"$.{key}", "string")
    is_array = F.startswith(F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant")), F.lit("ARRAY"))
    return F.when(is_array, many).when(one.isNotNull(), F.array(one))
