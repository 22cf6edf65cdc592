"""Large keyword rule sets: all keywords of a text in one pass, however many there are.

A few dozen keywords are best as substring tests inside one expression (`operators.classify`).
From some hundreds on, each text is read once by an automaton of all keywords. A keyword occurs
where the text contains it, as ever, inside a longer word as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.binding import bind
from foliospark.rules import Keywords
from foliospark.session import ship_code

#: Keywords of a set that are still tested one by one.
EXPRESSION_KEYWORDS = 400
#: A rule set is configuration that every worker holds; a larger one is refused.
MOST_CHARACTERS = 1 << 28

_AUTOMATA: dict[str, tuple] = {}


def keyword_count(keywords: Keywords) -> int:
    return sum(map(len, keywords.values()))


def keywords_of(table: DataFrame, type_col: str = "type", keyword_col: str = "keyword") -> Keywords:
    """A rule set from a table (type, keyword); types in the order of their names. A keyword that a
    type lists twice counts once; rows with a NULL are left out."""
    rows = (
        table.select(F.col(type_col).alias("t"), F.col(keyword_col).alias("k"))
        .where("t IS NOT NULL AND k IS NOT NULL")
        .distinct()
    )
    size = rows.agg(F.coalesce(F.sum(F.length("k") + 8), F.lit(0))).first()[0]
    if size > MOST_CHARACTERS:
        raise ValueError(f"{size} characters of keywords; at most {MOST_CHARACTERS} can be held by each worker")
    out: dict[str, list[str]] = {}
    for r in sorted(rows.toLocalIterator()):
        out.setdefault(r.t, []).append(r.k)
    return {t: tuple(ks) for t, ks in out.items()}


def _automaton(key: str, shared: Broadcast) -> tuple:
    """The automaton of this process, the types of each keyword, and those of the empty keyword."""
    import ahocorasick

    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        listed: dict[str, list[int]] = {}
        for place, words in enumerate(shared.value):
            for word in words:
                listed.setdefault(word, []).append(place)
        always = listed.pop("", [])  # every text contains it
        machine = ahocorasick.Automaton()
        types = list(listed.values())
        for i, word in enumerate(listed):
            machine.add_word(word, i)
        machine.make_automaton()
        _AUTOMATA[key] = machine, types, always
    return _AUTOMATA[key]


def _scores(text: str, found: tuple) -> dict[int, int]:
    machine, types, always = found
    scores: dict[int, int] = {}
    hits = {i for _, i in machine.iter(text)} if types else set()
    for places in (always, *(types[i] for i in hits)):
        for place in places:
            scores[place] = scores.get(place, 0) + 1
    return scores


def with_hits(df: DataFrame, text_lower: str, keywords: Keywords, name: str = "_hits") -> DataFrame:
    """Add an array of (type, score): places of the types, in declared order, of which the text has
    keywords, and how many of those listed. NULL for a NULL text."""
    key = uuid.uuid4().hex
    shared = df.sparkSession.sparkContext.broadcast(list(keywords.values()))  # bounded, see `keywords_of`

    @F.arrow_udf("array<struct<type:int,score:int>>")
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("type", pa.int32()), ("score", pa.int32())]))
        found = _automaton(key, shared)
        for texts in batches:
            rows = [
                None if t is None else [{"type": k, "score": v} for k, v in sorted(_scores(t, found).items())]
                for t in texts.to_pylist()
            ]
            yield pa.array(rows, kind)

    ship_code(df)
    return bind(df.withColumn(name, hits(F.col(text_lower))), [name])


def _names(keywords: Keywords) -> Column:
    return F.array(*(F.lit(t) for t in keywords))


def best_hit(hits: Column, keywords: Keywords) -> Column:
    """STRUCT(score, neg_ord, type) of the highest score; the first declared type wins ties. As with
    one test for each keyword, the first type wins with score 0 where nothing was found."""
    nothing = F.struct(F.lit(0).alias("score"), F.lit(0).alias("neg_ord"), F.lit(next(iter(keywords))).alias("type"))
    ranked = F.transform(
        hits, lambda h: F.struct(h["score"].alias("score"), (-h["type"]).alias("neg_ord"), F.get(_names(keywords), h["type"]).alias("type"))
    )
    return F.when(hits.isNotNull(), F.coalesce(F.array_max(ranked), nothing))


def first_hit(hits: Column, keywords: Keywords) -> Column:
    """The first type, in declared order, that has a hit; NULL when none has."""
    return F.get(_names(keywords), F.get(hits, F.lit(0))["type"])
