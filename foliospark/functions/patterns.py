"""Regular-expression helpers with the semantics the field patterns were written for.

The flags make Java's engine treat case, digits, white space and line ends as those patterns
expect: `i` ignore case, `u` and `U` Unicode case and classes, `d` only `\\n` ends a line,
`m` anchors at every line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from re import _constants as K
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.binding import bind
from foliospark.functions.guards import LOOKED_AT, guarded, with_folded

SEARCH = "(?iduU)"
SEARCH_LINES = "(?imduU)"
GAP = r"[\s\S]*?"


def search(text: Column, pattern: str, flags: str = SEARCH) -> Column:
    """First group of the first match; empty when there is none."""
    return F.regexp_extract(text, flags + pattern, 1)


def commit_to_first_lead(pattern: str) -> str:
    """Make `LEAD <any gap> TAIL` linear in the length of the text.

    A plain search retries the rest of the text for every LEAD. But if no TAIL follows the
    first LEAD, none follows a later one, so the search may stop there: skip once, without
    backtracking, to the first place where LEAD matches. Valid when no LEAD can start inside
    the shortest form of another one, as in keyword leads.
    """
    lead, gap, tail = pattern.partition(GAP)
    if not gap:
        return pattern
    return rf"\A(?>{GAP}(?={lead})){lead}{GAP}{tail}"


def tame_spaces(pattern: str) -> str:
    """The same matches without retrying long runs of white space in every possible split.

    `\\s*`, `\\s+` and `\\s{2,}` become possessive: in these patterns what follows never starts
    with white space, so giving some back cannot help. At a line anchor they need not cross
    lines either: `^` holds again on the line of the first other character, and `$` already
    before the first line end.
    """
    inner = r"[^\S\n]*+"
    pattern = re.sub(r"\^\\s\*", lambda _: "^" + inner, pattern)
    pattern = re.sub(r"\\s\*\$$", lambda _: inner + "$", pattern)
    return re.sub(r"\\s(?:\*|\+|\{2,\})(?![+?])", lambda m: m.group(0) + "+", pattern)


def _first_letters(tree) -> set[str] | None:
    """What a match of a parsed pattern may begin with; None where that is no letter."""
    letters: set[str] = set()
    for kind, value in tree:
        if kind is K.LITERAL:
            first = {chr(value)}
        elif kind is K.SUBPATTERN:
            first = _first_letters(value[3])
        elif kind is K.BRANCH:
            each = [_first_letters(b) for b in value[1]]
            first = None if None in each else set().union(*each)
        elif kind is K.MAX_REPEAT:
            first = _first_letters(value[2])
        else:
            return None
        if first is None or not all(c.isascii() and c.isalpha() for c in first):
            return None
        letters |= first
        if kind is not K.MAX_REPEAT or value[0] > 0:
            return letters
    return None


def look_at_first_letter(pattern: str) -> str:
    """The same matches of a pattern with a choice of first words, whose alternatives are tried one by
    one only at letters that begin one of them."""
    letters = _first_letters(P.parse(pattern, re.MULTILINE))
    return f"(?=[{''.join(sorted(letters))}]){pattern}" if letters and len(letters) > 1 else pattern


def with_ranked_search(
    df: DataFrame, text: str, fields: dict[str, Sequence[str]], flags: str = SEARCH_LINES
) -> DataFrame:
    """Add `<field>` (first group of the best-ranked pattern) and `<field>_rank` (from 0).

    A text is only searched for patterns whose literals it holds (see `guards`). Each rank is a projection of its own that only looks at rows the ranks before it left
    open, so a text is searched once per pattern at most and not at all after a hit.
    """
    def tmp(field: str, rank: int) -> str:
        return f"_{field}_{rank}"

    depth = max(len(p) for p in fields.values())
    df = with_folded(df, text)
    for rank in range(depth):
        found = {}
        for field, patterns in fields.items():
            if rank >= len(patterns):
                continue
            hit = guarded(patterns[rank], search(F.col(text), tame_spaces(look_at_first_letter(patterns[rank])), flags))
            for earlier in range(rank):
                hit = F.when(F.col(tmp(field, earlier)) == "", hit).otherwise(F.lit(""))
            found[tmp(field, rank)] = hit
        df = df.withColumns(found)
    merged = {}
    for field, patterns in fields.items():
        value, order = F.lit(None).cast("string"), F.lit(None).cast("int")
        for rank in reversed(range(len(patterns))):
            name = tmp(field, rank)
            value = F.when(F.col(name) != "", F.col(name)).otherwise(value)
            order = F.when(F.col(name) != "", F.lit(rank)).otherwise(order)
        merged[field], merged[f"{field}_rank"] = value, order
    drop = [tmp(f, r) for f, ps in fields.items() for r in range(len(ps))]
    return bind(df.withColumns(merged).drop(*drop, *LOOKED_AT), list(merged))
