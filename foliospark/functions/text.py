"""Text functions: Column → Column, JVM-side only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.rules import TRUNCATION_MARK

# Characters that Python's str.strip removes (the Unicode White_Space set and FS, GS, RS, US).
WHITESPACE = "".join(
    chr(c)
    for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
_SPACE_CLASS = r"(?U)[\s\x1c-\x1f]"
_NON_SPACE = r"(?U)[^\s\x1c-\x1f]"
_PLAIN_WORDS = "^[A-Za-z ]*$"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True when nothing but white space is left; stops at the first other character."""
    return ~c.rlike(_NON_SPACE)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse_whitespace(c: Column) -> Column:
    return strip(F.regexp_replace(c, _SPACE_CLASS + "+", " "))


def title_case(c: Column) -> Column:
    """Capital after every uncased character (`initcap` only looks at spaces)."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.when(c.rlike(_PLAIN_WORDS), F.initcap(c)).otherwise(
        F.array_join(F.transform(runs, _capital), "")
    )


def _capital(run: Column) -> Column:
    """Capital first letter of a lower-case run; `initcap` knows special letters, but is slow."""
    plain = F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, 2, 1 << 30))
    return F.when(F.left(run, F.lit(1)) < "\x7f", plain).otherwise(F.initcap(run))


def truncate_head_tail(c: Column, limit: tuple[int, float, float]) -> Column:
    """Keep the head and the tail of a long text around a marker."""
    chars, head, tail = limit
    short = F.concat(
        F.left(c, F.lit(int(chars * head))),
        F.lit(TRUNCATION_MARK),
        F.right(c, F.lit(int(chars * tail))),
    )
    return F.when(F.length(c) <= chars, c).otherwise(short)


def choose_longer(direct: Column, ocr: Column, short_chars: int) -> Column:
    """Directly extracted text, unless it is short and the recognised text is longer."""
    direct_ = F.coalesce(direct, F.lit(""))
    take_ocr = (F.length(strip(direct_)) < short_chars) & (F.length(ocr) > F.length(direct_))
    return F.when(take_ocr, ocr).otherwise(direct_)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """Name without its last suffix; a leading or trailing dot belongs to the name."""
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]+$", "$1")


def suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"(?s)/[^/]*$", "")


def folder_safe(name: Column) -> Column:
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")
