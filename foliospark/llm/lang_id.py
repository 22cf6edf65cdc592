"""Language identification with error-correcting output codes.

Each language gets a codeword; for each bit a binary classifier over hashed character n-grams
tells the languages with a 1 from those with a 0. A text gets the language whose codeword
has the smallest total loss against the margins of all bits, so that several bits may err. Two
codewords almost equally near make the answer ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import ship_code

UNDETERMINED = "und"
SIZES = (1, 2, 3, 4)
ROWS = 1 << 12
SEED = 11
#: Labelled rows of each language, and of all, that the fit may use: a hash decides.
SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL = 700, 5000
#: Longer texts, in bytes, are not learned from, so that the sample is bounded in bytes as well.
LONGEST_LEARNED = 40_000
AMBIGUOUS_GAP = 0.3
#: Typical margin of a bit after the fit, which sets how sure scores are.
MARGIN = 1.5
_BLOCK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
# letters in lower case and all bytes of other characters; the rest is one kind of gap
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_GAPS = re.compile(rb"  +")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed n-grams of bytes, of the whole text."""
    if not text.isascii():
        text = text.lower()
    raw = b" " + text.encode("utf-8", "surrogatepass").translate(_LETTERS) + b" "
    raw = _GAPS.sub(b" ", raw)
    counts = np.zeros(ROWS, np.int64)
    longest = max(SIZES)
    for at in range(0, len(raw), _BLOCK):
        # a block reads on by what an n-gram that starts in it needs
        chars = np.frombuffer(raw, np.uint8, min(_BLOCK + longest - 1, len(raw) - at), at).astype(np.uint32)
        starts = min(_BLOCK, len(chars))
        gram = np.zeros(len(chars), np.uint32)
        for n in range(1, longest + 1):
            gram = (gram[: len(chars) - n + 1] << np.uint32(8)) | chars[n - 1 :]
            if n in SIZES:
                mixed = (gram[:starts] + np.uint32(n)) * np.uint32(2654435761)
                counts += np.bincount(mixed >> np.uint32(20), minlength=ROWS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(languages: int, seed: int = SEED) -> np.ndarray:
    """Rows of +1 and -1. Up to five languages: every way to part them, each once. More:
    random words, of which the draw with the widest smallest distance is taken."""
    if languages <= 5:
        half = 1 << max(languages - 1, 0)
        bits = np.array([[1] + [1 - 2 * (c >> i & 1) for i in range(languages - 1)] for c in range(1, half)])
        return bits.reshape(-1, max(languages, 1)).T.astype(np.float32)
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages)))
    top, kept = -1, None
    for _ in range(200):
        drawn = rng.choice(np.array([-1, 1], np.float32), (languages, width))
        apart = (width - drawn @ drawn.T) / 2 + width * np.eye(languages)
        split = np.abs(drawn.sum(0)).max() < languages  # every bit has both kinds
        if split and apart.min() > top:
            top, kept = apart.min(), drawn
    return kept if kept is not None else drawn


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    bit_weight: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool, str | None]:
        """Language, score from 0 to 1, whether it is ambiguous, and the second language."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, False, None
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False, None
        margin = features(text) @ self.weights + self.bias
        loss = (np.logaddexp(0, -self.codes * margin) * self.bit_weight).sum(1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        first, second = np.argsort(loss, kind="stable")[:2]
        ambiguous = bool(share[first] - share[second] < AMBIGUOUS_GAP)
        return self.languages[first], float(share[first]), ambiguous, self.languages[second]


def fit(texts: list[str], langs: list[str], steps: int = 120, seed: int = SEED) -> Model:
    """Fit the classifiers of all bits together: logistic loss, each language weighing alike."""
    languages = sorted(set(langs))
    codes = codewords(len(languages), seed)
    bits = codes.shape[1] if languages else 0
    empty = Model(languages, codes, np.zeros((ROWS, bits), np.float32), np.zeros(bits, np.float32), np.ones(bits))
    if len(languages) < 2:
        return empty
    at = np.array([languages.index(x) for x in langs])
    x = np.stack([features(t) for t in texts])
    y = codes[at]
    weight = (1 / np.bincount(at)[at] / len(languages)).astype(np.float32)[:, None]
    # the gradients see four fifths; the rest tells how far each bit can be trusted
    rng = np.random.default_rng(seed)
    check = rng.random(len(at)) < 0.2
    if check.all() or len(set(at[~check])) < len(languages):
        check[:] = False
    w, b = np.zeros_like(empty.weights), np.zeros_like(empty.bias)
    m, v = np.zeros_like(w), np.zeros_like(w)
    xs, ys, ws = x[~check], y[~check], weight[~check]
    for step in range(1, steps + 1):
        pull = -ys * ws / (1 + np.exp(np.clip(ys * (xs @ w + b), -30, 30)))
        g = xs.T @ pull + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        b -= 2.0 * pull.sum(0)
    held = check if check.any() else np.ones(len(at), bool)
    size = MARGIN / max(float(np.median(np.abs(x[held] @ w + b))), 1e-6)
    w, b = w * np.float32(size), b * np.float32(size)
    wrong = ((x[held] @ w + b) * y[held] <= 0).mean(0)
    trust = np.log((1 - wrong + 0.01) / (wrong + 0.01))
    trust = np.maximum(trust, 0.05)
    return Model(languages, codes, w, b, trust / trust.mean())


def held_out(id_col: str = "doc_id"):
    """Rows never learned from; null ids among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def quota(sizes: list[int], per_language: int, total: int) -> int:
    """The most rows a language may have, up to `per_language`, so that all have `total` at most.
    Every language may have one."""
    low, high = 1, max(1, per_language)
    while low < high:
        middle = (low + high + 1) // 2
        if sum(min(n, middle) for n in sizes) <= total:
            low = middle
        else:
            high = middle - 1
    return low


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_TOTAL) -> DataFrame:
    """(doc_id, lang, text) of the learnable rows that the fit may use: of each language as many
    as its `quota`, those whose id hashes lowest. However unequal the languages are, none is left
    without a row, and the small ones give all they have before a large one gives more. Texts of
    more than `LONGEST_LEARNED` bytes are left out, rows that repeat id and language are made one."""
    known = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") <= LONGEST_LEARNED)).where(~held_out())
    # the draw sees ids only, the texts of those drawn are fetched last
    spread = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40))
    placed = known.select("doc_id", "lang", spread.alias("spread"))
    sizes = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("spread").alias("least")).collect()
    most = quota([r.n for r in sizes], per_language, total)
    # more than `most` rows pass, lest chance leave a language fewer; the lowest always does
    passing = most + 5 * most**0.5 + 10
    bounds = [(r.lang, max(r.least, int(min(1.0, passing / r.n) * (1 << 40)))) for r in sizes]
    # one row for each language
    bound = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound long"))
    few = placed.join(bound, "lang").where("spread <= bound").select("doc_id", "lang", "spread").distinct()
    order = Window.partitionBy("lang").orderBy("spread", "doc_id")
    ids = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    # bounded by `total`, or by the number of languages
    drawn = F.broadcast(ids.select("doc_id", "lang"))
    rows = known.select("doc_id", "lang", "text").join(drawn, ["doc_id", "lang"])
    return rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def train(
    docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_TOTAL
) -> Model:
    """Fit on at most `per_language` learnable rows of each language and `total` of all."""
    chosen = sample(docs, per_language, total)
    rows = sorted({(r.doc_id, r.lang, r.text) for r in chosen.collect() if has_letter(r.text)})
    return fit([r[2] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score, ambiguous, second.

    A null text, or one without a letter, is `und` with score 0; so is every text if there was
    nothing to learn. Repeated rows stay, other columns are not read, an empty table gives no
    rows. Whole texts count, in blocks of bounded memory.
    """
    ship_code(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.float64(), pa.bool_(), pa.string())
        for b in batches:
            made = [model.predict(t.as_py()) for t in b.column(1)]
            columns = zip(*made) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "lang_pred", "score", "ambiguous", "second"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean, second string"
    )
