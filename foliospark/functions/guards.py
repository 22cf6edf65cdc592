"""Literal guards: what every match of a pattern holds, tested before the pattern is searched.

The literals are read off the pattern's parse tree. They are looked up in a copy of the text that
is folded once for all patterns, by a plain substring test, so that a text without them is not
scanned again for each pattern. A guard may pass a text without a match, never stop one with.
"""

from __future__ import annotations

import re
from re import _constants as K
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.binding import bind

LOOKED_AT = ("_folded", "_digit")
#: Shorter literals occur nearly everywhere; more alternatives cost more than the search.
LEAST_LETTERS, MOST_ALTERNATIVES = 3, 4
#: Characters that a case-blind pattern takes for an ASCII letter and lower-casing does not fold to it.
FOLDED_APART = {"İ": "i", "ı": "i", "ſ": "s", "K": "k"}

Needs = list[frozenset[str]]
#: Stands for "some digit" among the needs.
DIGIT = "\\d"


def _is_digits(item: tuple) -> bool:
    kind, value = item
    if kind is not K.IN:
        return False
    digits = [(K.CATEGORY, K.CATEGORY_DIGIT)]
    return value == digits or value == [(K.RANGE, (48, 57))]


def _literal(tree) -> str | None:
    """The text of a tree that matches one literal only."""
    out = ""
    for kind, value in tree:
        if kind is K.LITERAL:
            out += chr(value)
        elif kind is K.SUBPATTERN and (inner := _literal(value[3])) is not None:
            out += inner
        else:
            return None
    return out


def _alternatives(branches: list) -> frozenset[str] | None:
    """One need of each branch, if every branch has one."""
    out: set[str] = set()
    for branch in branches:
        needs = needs_of(branch, 1)
        if not needs:
            return None
        # the need with the longest shortest literal
        out |= max(needs, key=lambda n: (n != {DIGIT}, min(map(len, n))))
    return frozenset(out)


def needs_of(tree, least: int = LEAST_LETTERS) -> Needs:
    """Sets of lower-case literals, of each of which every match holds one."""
    needs: Needs = []
    run = ""

    def end_run() -> None:
        nonlocal run
        if len(run) >= least and run.isascii():
            needs.append(frozenset([run.lower()]))
        run = ""

    for item in tree:
        kind, value = item
        if kind is K.LITERAL:
            run += chr(value)
            continue
        if kind is K.SUBPATTERN and (text := _literal(value[3])) is not None:
            run += text
            continue
        end_run()
        if kind is K.SUBPATTERN:
            needs += needs_of(value[3], least)
        elif kind is K.ATOMIC_GROUP:
            needs += needs_of(value, least)
        elif kind is K.BRANCH:
            some = _alternatives(value[1])
            if some:
                needs.append(some)
        elif kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT) and value[0] > 0:
            needs += needs_of(value[2], least)
        elif _is_digits(item):
            needs.append(frozenset([DIGIT]))
    end_run()
    return list(dict.fromkeys(needs))


def guards_of(pattern: str) -> Needs:
    """The needs of a pattern that are worth testing: literals long enough, few alternatives, and
    whether there is a digit at all. Patterns that only Java's engine reads have no guards."""
    kept = []
    try:
        needs = needs_of(P.parse(pattern, re.MULTILINE))
    except re.error:
        return []
    for need in needs:
        if need == {DIGIT}:
            kept.append(need)
        elif DIGIT not in need and len(need) <= MOST_ALTERNATIVES and min(map(len, need)) >= LEAST_LETTERS:
            # an alternative that holds another one says no more than that one
            kept.append(frozenset(a for a in need if not any(b != a and b in a for b in need)))
    return kept


def folded(text: Column) -> Column:
    """The text in which literals are looked up."""
    apart = text
    for char, letter in FOLDED_APART.items():
        apart = F.replace(apart, F.lit(char), F.lit(letter))
    # none of those is ASCII: a text of one byte for each character is not looked through for them
    return F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(apart))


def has_digit(text: Column) -> Column:
    return text.rlike(r"(?U)\d")


def with_folded(df: DataFrame, text: str) -> DataFrame:
    """Add what guards look at, `_folded` and `_digit`, computed once for each row."""
    return bind(df.withColumns({"_folded": folded(F.col(text)), "_digit": has_digit(F.col(text))}), list(LOOKED_AT))


def guarded(pattern: str, search: Column) -> Column:
    """`search` where the text of a `with_folded` frame may hold a match; '' elsewhere, and NULL for
    a NULL text as ever."""
    test = passes(pattern, F.col("_folded"), F.col("_digit"))
    return search if test is None else F.when(~test, "").otherwise(search)


def passes(pattern: str, folded_text: Column, digit: Column) -> Column | None:
    """Whether a text may hold a match, from its folded form and from whether it has a digit; None
    where the pattern needs nothing that is worth testing."""
    out = None
    for need in guards_of(pattern):
        some = None
        for literal in sorted(need):
            one = digit if literal == DIGIT else folded_text.contains(literal)
            some = one if some is None else some | one
        out = some if out is None else out & some
    return out
