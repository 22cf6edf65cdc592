"""Toxicity: a small bidirectional gated recurrent network with attention pooling.

Each word enters as the embedding of its hash and the mean embedding of its hashed character
n-grams. The network reads overlapping windows of `WINDOW` words over the whole text;
a document's score is that of its highest window. Training (numpy, on the driver, from a bounded
sample of labelled rows) takes the gradient through that window.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import ship_code

WINDOW, STRIDE = 64, 32
OVERLAP = WINDOW - STRIDE
HIDDEN, EMBED, ATTEND = 8, 8, 8
WORD_ROWS = NGRAM_ROWS = 1 << 15
NGRAMS = (3, 4)
WORD_BYTES, PREFIX_BYTES = 20, 11
#: Longer words enter as pieces of at most so many bytes; two neighbours share at least `SHARED`.
PIECE_BYTES, SHARED = WORD_BYTES - 2, 6
EPOCHS, BATCH, SEED = 9, 64, 6
#: A small sample is passed over again until so many batches have been taken.
LEAST_STEPS = 260
#: Share of inputs left out while training.
DROP_WORD, DROP_NGRAM = 0.8, 0.5
#: Labelled rows the fit may use of each class; those with the smallest hash are taken.
SAMPLE_TOXIC, SAMPLE_CLEAN = 900, 1600
THRESHOLD = 0.7
#: Longer texts, in bytes, are not learned from, so that the sample is bounded in bytes as well.
LONGEST_LEARNED = 40_000
#: Distinct words whose inputs a worker remembers.
CACHE_WORDS = 120_000
#: Words that are scored at once: a whole number of strides.
_BLOCK_WORDS = 1024 * STRIDE

# lower-case ASCII letters, digits and all bytes of other characters stay, the rest parts words
_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
#: What joins the letters around it: soft hyphen, zero-width joiner and non-joiner.
_JOINS = "\xad\u200c\u200d"


@lru_cache(1 << 16)
def _parts(char: str) -> bool:
    """Whether a character beyond ASCII parts words: all do but letters, marks, digits and joins."""
    if char < "\x80" or char in _JOINS:
        return False
    kind = unicodedata.category(char)
    return kind[0] not in "LM" and kind != "Nd"


def _parted(text: str) -> str:
    """The text with a blank for each character beyond ASCII that parts words."""
    odd = [c for c in set(text) if _parts(c)]
    if len(odd) > 24:
        return text.translate({ord(c): " " for c in odd})
    for c in odd:
        text = text.replace(c, " ")
    return text


def _pieces(word: bytes) -> Iterator[bytes]:
    """A word as overlapping pieces of whole characters that together hold all of it."""
    at = 0
    while len(word) - at > PIECE_BYTES:
        end = at + PIECE_BYTES
        while word[end] & 0xC0 == 0x80:
            end -= 1
        yield word[at:end]
        at = end - SHARED
        while word[at] & 0xC0 == 0x80:
            at -= 1
    yield word[at:]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of letters and digits of any script. Long ones, as of scripts without spaces,
    are given as consecutive pieces."""
    if not text:
        return []
    if not text.isascii():
        text = _parted(text.lower())
    words = text.encode("utf-8", "surrogatepass").translate(_SPLIT).split()
    if max(map(len, words), default=0) <= PIECE_BYTES:
        return words
    return [piece for w in words for piece in ((w,) if len(w) <= PIECE_BYTES else _pieces(w))]


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the word table, rows of the n-gram table, and which of the latter count."""
    marked = np.array([b"\x02" + w[:PIECE_BYTES] + b"\x03" for w in words], f"S{WORD_BYTES}")
    chars = marked.view(np.uint8).reshape(len(words), WORD_BYTES).astype(np.uint32)
    mixed = np.zeros(len(words), np.uint32)
    for i in range(WORD_BYTES):
        mixed = (mixed ^ chars[:, i]) * np.uint32(16777619)
    word = (mixed ^ mixed >> np.uint32(15)) % np.uint32(WORD_ROWS)
    rows, real = [], []
    # beginnings of the word, the whole word among them if it is short
    mixed = np.full(len(words), 2166136261, np.uint32)
    for i in range(PREFIX_BYTES):
        mixed = (mixed ^ chars[:, i]) * np.uint32(16777619)
        if i >= 3:
            rows.append(((mixed ^ mixed >> np.uint32(15)) % np.uint32(NGRAM_ROWS))[:, None])
            real.append(chars[:, i : i + 1] > 0)
    for n in NGRAMS:
        width = WORD_BYTES - n + 1
        mixed = np.full((len(words), width), 2166136261 + n, np.uint32)
        for i in range(n):
            mixed = (mixed ^ chars[:, i : i + width]) * np.uint32(16777619)
        rows.append((mixed ^ mixed >> np.uint32(15)) % np.uint32(NGRAM_ROWS))
        real.append(chars[:, n - 1 :] > 0)
    return word.astype(np.int64), np.hstack(rows).astype(np.int64), np.hstack(real).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, forward pass and gradients. Scores are logits until `calibrated`."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        h = HIDDEN
        self.p = {
            "word": draw(WORD_ROWS, EMBED, by=0.05),
            "ngram": draw(NGRAM_ROWS, EMBED, by=0.05),
            "wx": draw(2 * EMBED, 6 * h, by=0.35),
            "bx": np.zeros(6 * h, np.float32),
            "u0": draw(h, 3 * h, by=0.25),
            "u1": draw(h, 3 * h, by=0.25),
            "wa": draw(2 * h, ATTEND, by=0.3),
            "va": draw(ATTEND, by=0.3),
            "wo": draw(2 * h, by=0.3),
            "bo": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0
        self.prior = 0.0

    def embed(self, inputs: tuple) -> tuple[np.ndarray, np.ndarray]:
        word, grams, real = inputs
        share = real / np.sqrt(np.maximum(real.sum(1, keepdims=True), 1))
        mean = np.einsum("wk,wkd->wd", share, self.p["ngram"][grams])
        return np.hstack([self.p["word"][word], mean]), share

    def projected(self, words: list[bytes]) -> np.ndarray:
        """What a word adds to the gates of both directions."""
        x, _ = self.embed(word_inputs(words))
        return (x @ self.p["wx"] + self.p["bx"]).astype(np.float32)

    def _direction(self, g, mask, u, order, kept=None):
        h, size = np.zeros((g.shape[0], HIDDEN), np.float32), HIDDEN
        out = np.empty((g.shape[0], g.shape[1], HIDDEN), np.float32)
        for t in order:
            a, gt = h @ u, g[:, t]
            rz = gt[:, : 2 * size] + a[:, : 2 * size]
            np.negative(rz, out=rz)
            np.minimum(rz, 60, out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            r, z = rz[:, :size], rz[:, size:]
            n = np.tanh(gt[:, 2 * size :] + r * a[:, 2 * size :])
            if kept is not None:
                kept[t] = (h, r, z, n, a[:, 2 * size :])
            h = h + (1 - z) * mask[:, t, None] * (n - h)
            out[:, t] = h
        return out

    def forward(self, g: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows: `g` (windows, words, 6 * HIDDEN), `mask` 1 where a word is."""
        steps = range(g.shape[1])
        kept = ([None] * g.shape[1], [None] * g.shape[1]) if keep else (None, None)
        states = np.concatenate(
            [
                self._direction(g[:, :, : 3 * HIDDEN], mask, self.p["u0"], steps, kept[0]),
                self._direction(g[:, :, 3 * HIDDEN :], mask, self.p["u1"], reversed(steps), kept[1]),
            ],
            axis=2,
        )
        seen = np.tanh(states @ self.p["wa"])
        e = np.where(mask > 0, seen @ self.p["va"], -1e9)
        alpha = np.exp(e - e.max(1, keepdims=True)) * mask
        alpha /= np.maximum(alpha.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", alpha, states)
        logit = pooled @ self.p["wo"] + self.p["bo"][0]
        return (logit, states, seen, alpha, pooled, kept) if keep else logit

    def infer(self, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """The logits of `forward` for rows of word numbers (-1: none), laid out for speed:
        windows run along the last axis and results are written in place."""
        size, (count, steps) = HIDDEN, windows.shape
        g = np.ascontiguousarray(table[windows].transpose(1, 2, 0))
        full = bool((windows >= 0).all())
        mask = np.ascontiguousarray((windows >= 0).T.astype(np.float32))
        states = np.empty((steps, 2 * size, count), np.float32)
        a = np.empty((3 * size, count), np.float32)
        for d, (u, order) in enumerate((("u0", range(steps)), ("u1", reversed(range(steps))))):
            ut, h = np.ascontiguousarray(self.p[u].T), np.zeros((size, count), np.float32)
            for t in order:
                gt = g[t, 3 * size * d : 3 * size * (d + 1)]
                np.matmul(ut, h, out=a)
                rz, n = a[: 2 * size], a[2 * size :]
                rz += gt[: 2 * size]
                np.negative(rz, out=rz)
                np.minimum(rz, 60, out=rz)
                np.exp(rz, out=rz)
                rz += 1
                np.reciprocal(rz, out=rz)
                n *= rz[:size]
                n += gt[2 * size :]
                np.tanh(n, out=n)
                n -= h
                np.subtract(1, rz[size:], out=rz[size:])
                n *= rz[size:]
                if not full:
                    n *= mask[t]
                h = np.add(h, n, out=states[t, size * d : size * (d + 1)])
        seen = np.tanh(np.matmul(self.p["wa"].T, states))
        e = np.where(mask > 0, np.einsum("a,tab->tb", self.p["va"], seen), -1e9)
        alpha = np.exp(e - e.max(0)) * mask
        alpha /= np.maximum(alpha.sum(0), 1e-9)
        each = np.einsum("h,thb->tb", self.p["wo"], states)
        return (alpha * each).sum(0) + self.p["bo"][0]

    def gradients(self, g, mask, label):
        p, h = self.p, HIDDEN
        logit, states, seen, alpha, pooled, kept = self.forward(g, mask, keep=True)
        dl = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        grad = {"wo": pooled.T @ dl, "bo": np.array([dl.sum()], np.float32)}
        dc = dl[:, None] * p["wo"]
        ds = alpha[:, :, None] * dc[:, None, :]
        da = np.einsum("bth,bh->bt", states, dc)
        de = alpha * (da - (alpha * da).sum(1, keepdims=True))
        grad["va"] = np.einsum("bt,bta->a", de, seen)
        dseen = de[:, :, None] * p["va"] * (1 - seen**2)
        grad["wa"] = np.einsum("bth,bta->ha", states, dseen)
        ds += dseen @ p["wa"].T
        dg = np.zeros_like(g)
        for d, (u, order) in enumerate((("u0", reversed(range(g.shape[1]))), ("u1", range(g.shape[1])))):
            du, dh = np.zeros_like(p[u]), np.zeros((len(label), h), np.float32)
            for t in order:
                was, r, z, n, an = kept[d][t]
                dh = dh + ds[:, t, d * h : (d + 1) * h]
                m = mask[:, t, None]
                dn = dh * (1 - z) * m * (1 - n**2)
                dz = -dh * m * (n - was) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                dgates = np.hstack([dr, dz, dn * r])
                du += was.T @ dgates
                dg[:, t, 3 * h * d : 3 * h * (d + 1)] = np.hstack([dr, dz, dn])
                dh = dh * (1 - (1 - z) * m) + dgates @ p[u].T
            grad[u] = du
        return grad, dg

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * np.asarray(logit, np.float64) + self.shift)


def window_starts(count: int) -> range:
    """First words of the windows that cover `count` words."""
    return range(0, max(count - OVERLAP, 1), STRIDE)


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All overlapping windows of one text, as rows of word numbers, -1 beyond its end."""
    starts = window_starts(len(ids))
    padded = np.full(starts[-1] + WINDOW, -1, np.int64)
    padded[: len(ids)] = ids[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


class Scorer:
    """Scores texts, many windows at a time, remembering the inputs of words."""

    def __init__(self, network: Network, cache_words: int = CACHE_WORDS):
        self.net, self.limit = network, cache_words
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.table = np.zeros((4096, 6 * HIDDEN), np.float32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        known = self.index.get
        got = list(map(known, words))
        if None in got:
            new = list({w for w, i in zip(words, got) if i is None})
            have, total = len(self.index), len(self.index) + len(new)
            if total > len(self.table):
                # doubled up to the limit, which the words of one block may pass
                size = max(total, min(2 * len(self.table), self.limit))
                grown = np.zeros((size, 6 * HIDDEN), np.float32)
                grown[:have] = self.table[:have]
                self.table = grown
            for at in range(0, len(new), 8192):
                part = new[at : at + 8192]
                self.table[have + at : have + at + len(part)] = self.net.projected(part)
            self.index.update(zip(new, range(have, total)))
            got = list(map(known, words))
        return np.array(got, np.int64)

    def logits(self, windows: np.ndarray, at_once: int = 512) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        for i in range(0, len(windows), at_once):
            out[i : i + at_once] = self.net.infer(self.table, windows[i : i + at_once])
        return out

    def tops(self, docs: list[list[bytes]]) -> list[float | None]:
        """The highest logit of each list of words, None for an empty one."""
        if len(self.index) > self.limit:
            self._clear()
        ends = np.cumsum([len(d) for d in docs])
        ids = self.numbers([w for d in docs for w in d])
        windows = [windows_of(ids[end - len(d) : end]) for d, end in zip(docs, ends) if d]
        logit = self.logits(np.concatenate(windows)) if windows else None
        out: list[float | None] = []
        at, sizes = 0, iter(windows)
        for d in docs:
            if not d:
                out.append(None)
                continue
            size = len(next(sizes))
            out.append(float(logit[at : at + size].max()))
            at += size
        return out

    def scores(self, texts: Iterable[str | None]) -> Iterator[float]:
        """The score of each text, in order."""
        held: list[list[bytes]] = []  # stretches of words
        of_text: list[int] = []  # how many stretches each text has
        size = 0

        def flush() -> Iterator[float]:
            tops = iter(self.tops(held))
            for count in of_text:
                best = max((t for t in (next(tops) for _ in range(count)) if t is not None), default=None)
                yield self.net.prior if best is None else float(self.net.probability(best))

        for text in texts:
            words = words_of(text)
            # stretches overlap, so that every window of the text lies in one of them
            parts = [
                words[at : at + _BLOCK_WORDS + OVERLAP] for at in range(0, max(1, len(words) - OVERLAP), _BLOCK_WORDS)
            ]
            held += parts
            of_text.append(len(parts))
            size += len(words)
            if size >= _BLOCK_WORDS:
                yield from flush()
                held, of_text, size = [], [], 0
        yield from flush()


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Train on whole texts with labels 0 or 1. With one class only, all scores are its share."""
    net = Network(seed)
    y = np.array(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.0
    net.prior = share
    if len(y) == 0 or share in (0.0, 1.0):
        net.scale, net.shift = 0.0, 30.0 if share == 1.0 else -30.0
        return net
    rng = np.random.default_rng(seed)
    index: dict[bytes, int] = {}
    docs = []
    for text in texts:
        words = words_of(text)
        docs.append(windows_of(np.array([index.setdefault(w, len(index)) for w in words], np.int64)) if words else None)
    real = [i for i, d in enumerate(docs) if d is not None]
    if len({labels[i] for i in real}) < 2:
        net.scale, net.shift = 0.0, float(np.log(share / (1 - share)))
        return net
    word, grams, mask = word_inputs(list(index))
    check = set(real[::5])  # for the calibration, not for the gradients
    owner = np.concatenate([np.full(len(docs[i]), i) for i in real])
    stacked = np.concatenate([docs[i] for i in real])
    first = {i: int(np.searchsorted(owner, i)) for i in real}
    moment = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    steps = 0

    def all_logits() -> np.ndarray:
        table = np.empty((len(index), 6 * HIDDEN), np.float32)
        for at in range(0, len(index), 8192):
            part = slice(at, at + 8192)
            x, _ = net.embed((word[part], grams[part], mask[part]))
            table[part] = x @ net.p["wx"] + net.p["bx"]
        out = np.empty(len(stacked), np.float32)
        for i in range(0, len(stacked), 512):
            out[i : i + 512] = net.infer(table, stacked[i : i + 512])
        return out

    def highest(logit: np.ndarray) -> dict[int, int]:
        return {i: first[i] + int(np.argmax(logit[first[i] : first[i] + len(docs[i])])) for i in real}

    trained = [i for i in real if i not in check]
    toxic = [i for i in trained if y[i] > 0.5]
    # toxic texts as often as clean ones, so that the rarer class counts alike
    again = max(1, (len(trained) - len(toxic)) // max(1, len(toxic)))
    pool = np.array(trained + toxic * (again - 1))
    batches = -(-len(pool) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // batches))
    for epoch in range(epochs):
        # at first any window stands for its text, lest the first guesses be learned by heart
        logit = rng.standard_normal(len(stacked)) if epoch < -(-epochs // 3) else all_logits()
        top = highest(logit)
        order = rng.permutation(pool)
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            w = stacked[[top[i] for i in part]]
            m = (w >= 0).astype(np.float32)
            used, back = np.unique(np.where(w >= 0, w, w[:, :1]), return_inverse=True)
            # inputs are left out at random, so that no word is learned by heart
            heard = mask[used] * (rng.random(mask[used].shape) > DROP_NGRAM)
            x, counted = net.embed((word[used], grams[used], heard))
            spoken = (rng.random((len(used), 1)) > DROP_WORD).astype(np.float32)
            x[:, :EMBED] *= spoken
            g = (x @ net.p["wx"] + net.p["bx"])[back.reshape(w.shape)].astype(np.float32)
            grad, dg = net.gradients(g, m, y[part])
            dgw = np.zeros((len(used), 6 * HIDDEN), np.float32)
            np.add.at(dgw, back.ravel(), dg.reshape(-1, 6 * HIDDEN))
            grad["wx"], grad["bx"] = x.T @ dgw, dgw.sum(0)
            dx = dgw @ net.p["wx"].T
            rows, at_row = np.unique(word[used], return_inverse=True)
            dw = np.zeros((len(rows), EMBED), np.float32)
            np.add.at(dw, at_row, dx[:, :EMBED] * spoken)
            gram_rows, at_gram = np.unique(grams[used], return_inverse=True)
            dn = np.zeros((len(gram_rows), EMBED), np.float32)
            spread = counted[:, :, None] * dx[:, None, EMBED:]
            np.add.at(dn, at_gram.ravel(), spread.reshape(-1, EMBED))
            steps += 1
            for name, d in grad.items():
                moment[name] = 0.9 * moment[name] + 0.1 * d
                square[name] = 0.99 * square[name] + 0.01 * d * d
                size = moment[name] / (1 - 0.9**steps) / (np.sqrt(square[name] / (1 - 0.99**steps)) + 1e-8)
                net.p[name] -= (0.01 * size).astype(np.float32)
            for name, at_rows, d in (("word", rows, dw), ("ngram", gram_rows, dn)):
                square[name][at_rows] += d * d
                net.p[name][at_rows] -= 0.1 * d / (np.sqrt(square[name][at_rows]) + 1e-6)
    logit = all_logits()
    top = highest(logit)
    tops = {i: float(logit[top[i]]) for i in real}
    _calibrate(net, [tops[i] for i in real if i in check], [y[i] for i in real if i in check])
    empty = float(net.probability(net.p["bo"][0]))
    net.prior = min(share, empty)
    return net


def _calibrate(net: Network, logits: list[float], labels: list[float]) -> None:
    """Logistic fit of scale and shift on texts that gave no gradients, moved so that the
    threshold lies between the classes where they part."""
    x, y = np.array(logits), np.array(labels)
    if len(set(labels)) < 2:
        return
    weight = np.where(y > 0.5, 0.5 / (y > 0.5).sum(), 0.5 / (y <= 0.5).sum())
    a, b = 1.0, 0.0
    for _ in range(300):
        p = _sigmoid(a * x + b)
        a -= 0.5 * (((p - y) * x * weight).sum() + 0.001 * a)
        b -= 0.5 * ((p - y) * weight).sum()
    net.scale = max(float(a), 0.05)
    # the place of the threshold: midway between a high clean and a low toxic text
    cut = 0.5 * (np.quantile(x[y <= 0.5], 0.999) + np.quantile(x[y > 0.5], 0.02))
    net.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - net.scale * cut)


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    learnable,
    most_toxic: int = SAMPLE_TOXIC,
    most_clean: int = SAMPLE_CLEAN,
    longest: int = LONGEST_LEARNED,
) -> DataFrame:
    """(doc_id, text, toxic) of at most so many labelled rows of each class whose doc_id is
    `learnable`: those with the smallest hash, whatever the size of the tables. One row for each
    doc_id, however often it occurs; texts of more than `longest` bytes are left out."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(learnable)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("h", F.xxhash64(F.lit(SEED), "doc_id"))
    )
    pick = lambda toxic, n: known.where(F.col("toxic") == toxic).orderBy("h", "doc_id").limit(n)
    chosen = pick(1, most_toxic).union(pick(0, most_clean)).select("doc_id", "toxic")
    short = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    # bounded by the two sizes; rows that repeat an id are made one before they are gathered
    drawn = short.join(F.broadcast(chosen), "doc_id")
    return drawn.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from; null ids among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, **how) -> Network:
    rows = training_rows(docs, labels, ~held_out(), **how).collect()
    # the order in which rows arrive must not matter
    rows = sorted({(r.doc_id, r.text or "", int(r.toxic)) for r in rows})
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(rows))
    return fit([rows[i][1] for i in order], [rows[i][2] for i in order])


def score(docs: DataFrame, network: Network, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, score) of every row, from its whole text.

    Null and empty texts, and texts without letters, get the network's prior, at most the share of
    toxic rows it learned from. Repeated rows stay; other columns are not read; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network, cache_words)  # its memory ends with the task
        for b in batches:
            made = list(scorer.scores(t.as_py() for t in b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.float64())], ["doc_id", "score"])

    ship_code(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double"
    )


def reject(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows whose score reaches `threshold`: all columns, no shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for b in batches:
            made = list(scorer.scores(t.as_py() for t in b.column(at)))
            yield b.filter(pa.array([s < threshold for s in made], pa.bool_()))

    ship_code(docs)
    return docs.mapInArrow(run, docs.schema)
