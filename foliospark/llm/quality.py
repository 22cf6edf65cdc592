"""Quality by nearest neighbours: labelled documents vote in a latent-semantic space.

A document is a bag of terms: its words, their shapes, pairs of neighbouring shapes, and words that
repeat the one before. Weighted by how rare they are among the labelled rows and projected on
the leading singular vectors of those, documents become short vectors. The labelled ones go to
every task; each document's cosine with all of them is computed in blocks, exactly, and the
labels of the nearest are weighted by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import ship_code

TERMS = 1 << 12
DIMENSIONS, NEIGHBOURS = 48, 15
#: The vote of a neighbour is its cosine to this power.
SHARPNESS = 4
#: Labelled rows the fit may use of each class; those with the smallest hash are taken.
SAMPLE_EACH = 1500
SEED = 23
THRESHOLD = 0.5
#: Documents that are compared with the labelled ones at once, and words read at once.
BLOCK_DOCS, BLOCK_WORDS = 512, 1 << 18
#: Distinct words a worker remembers.
CACHE_WORDS = 200_000
_REPEATED = 1
_SHAPES = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_SHAPE_BYTES = 24


def shape(word: bytes) -> bytes:
    """Kinds of characters in a word, each run as one: `THE!!` is `A!`. A long shape keeps both ends."""
    kinds = word.translate(_SHAPES)
    runs = kinds[:1] + bytes(b for a, b in zip(kinds, kinds[1:]) if a != b)
    return runs if len(runs) <= _SHAPE_BYTES else runs[: _SHAPE_BYTES // 2] + runs[-_SHAPE_BYTES // 2 :]


class Terms:
    """Counts of hashed terms of whole texts, remembering the words it has seen."""

    def __init__(self, cache_words: int = CACHE_WORDS):
        self.limit = cache_words
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.word = np.zeros(0, np.int64)
        self.shape = np.zeros(0, np.int64)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        got = list(map(self.index.get, words))
        if None in got:
            new = list({w for w, i in zip(words, got) if i is None})
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.word = np.concatenate([self.word, np.array([zlib.crc32(w.lower()) for w in new], np.int64)])
            self.shape = np.concatenate([self.shape, np.array([zlib.crc32(shape(w), 1) for w in new], np.int64)])
            got = list(map(self.index.get, words))
        return np.array(got, np.int64)

    def counts(self, text: str | None) -> np.ndarray:
        """How often each hashed term occurs."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        out = np.zeros(TERMS, np.int64)
        for at in range(0, len(words), BLOCK_WORDS):
            if len(self.index) > self.limit:
                self._clear()
            # a block begins with the last word of the one before, for the pairs
            n = self._numbers(words[max(at - 1, 0) : at + BLOCK_WORDS])
            own = n[1:] if at else n
            shapes = self.shape[n]
            pairs = (shapes[:-1] * 31 + shapes[1:]) * 0x9E3779B1 >> 7
            for terms in (self.word[own], self.shape[own], pairs):
                out += np.bincount(terms % (TERMS - 2) + 2, minlength=TERMS)
            out[_REPEATED] += int((n[1:] == n[:-1]).sum())
        return out


def weighted(counts: np.ndarray) -> np.ndarray:
    """Terms of a text by the root of their share, so that long texts are like short ones."""
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    """Weights of terms, the projection, and the labelled vectors with their labels."""

    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float
    #: What a text without words gets.
    empty: float
    neighbours: int = NEIGHBOURS

    def project(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of `weighted` counts; a zero row stays zero."""
        x = (terms * self.rarity) @ self.basis
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(size > 0, size, 1)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of unit vectors from their cosines with all labelled ones."""
        if not len(self.labels):
            return np.full(len(x), self.share)
        cosine = x @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < len(self.labels) else np.tile(np.arange(k), (len(x), 1))
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        voted = (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1)
        return np.where(total > 0, voted, self.share)

    def scores(self, texts: Iterable[str | None], terms: Terms | None = None) -> Iterator[float]:
        terms, held = terms or Terms(), []
        for text in texts:
            held.append(terms.counts(text))
            if len(held) == BLOCK_DOCS:
                yield from self._block(held)
                held = []
        if held:
            yield from self._block(held)

    def _block(self, held: list[np.ndarray]) -> Iterator[float]:
        made = self.votes(self.project(np.stack([weighted(c) for c in held])))
        for counts, score in zip(held, made):
            yield min(max(float(score), 0.0), 1.0) if counts.any() else self.empty


def fit(counts: list[np.ndarray], labels: list[int], dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS, seed: int = SEED) -> Model:
    """From counts of terms and labels 0 or 1. Without labelled rows all scores are 1/2."""
    y = np.array(labels, np.float64)
    share = float(y.mean()) if len(y) else 0.5
    with_words = [i for i, c in enumerate(counts) if c.any()]
    blank = y[[i for i in range(len(counts)) if not counts[i].any()]]
    empty = float(blank.mean()) if len(blank) else share
    if not with_words:
        nothing = np.zeros((0, dimensions), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, dimensions), np.float32), nothing, y[:0], share, empty, neighbours)
    x = np.stack([weighted(counts[i]) for i in with_words])
    rarity = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.1).astype(np.float32)
    x *= rarity
    # leading singular vectors, by iteration from a random start
    size = min(dimensions + 8, len(x))
    q = np.linalg.qr(x.T @ np.random.default_rng(seed).standard_normal((len(x), size)).astype(np.float32))[0]
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ turn.T)[:, :dimensions].astype(np.float32)
    model = Model(rarity, basis, np.zeros((0, basis.shape[1]), np.float32), y[with_words], share, empty, neighbours)
    model.vectors = model.project(x / rarity)
    return model


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from; null ids among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def training_counts(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> DataFrame:
    """(doc_id, quality, terms, counts) of at most `each` learnable labelled rows of each class.
    Texts are counted where they are read; what is gathered does not grow with them."""
    known = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("quality"))
    )
    pick = lambda q: known.where(F.col("quality") == q).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(each)
    chosen = F.broadcast(pick(0).union(pick(1)))  # bounded by twice `each`

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Terms()
        for batch in batches:
            rows = [made.counts(t.as_py()) for t in batch.column(2)]
            places = [np.flatnonzero(c) for c in rows]
            lists = [pa.array(places, pa.list_(pa.int64())), pa.array([c[p] for c, p in zip(rows, places)], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], ["doc_id", "quality", "terms", "counts"])

    ship_code(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("doc_id", "quality", "text")
    counted = rows.mapInArrow(run, "doc_id long, quality int, terms array<long>, counts array<long>")
    # one row for each id, whatever rows repeat it
    return counted.groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "quality")).alias("row")).select("doc_id", "row.*")


def train(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH, **how) -> Model:
    rows = sorted(training_counts(docs, labels, each).collect(), key=lambda r: r.doc_id)
    counts = []
    for r in rows:
        counts.append(np.zeros(TERMS, np.int64))
        counts[-1][r.terms] = r.counts
    return fit(counts, [int(r.quality) for r in rows], **how)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, from its whole text; 1 is good.

    Null and blank texts get the mean label of the blank labelled ones, or where there are none the
    share of good rows among the learned ones, as does a text unlike all labelled ones. Repeated
    rows stay; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            made = list(model.scores((t.as_py() for t in batch.column(1)), terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], ["doc_id", "score"])

    ship_code(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
