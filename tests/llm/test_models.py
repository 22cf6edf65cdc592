"""Toxicity and language: gradients, fast form, held-out accuracy, contracts."""

import math
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from foliospark.llm import lang_id, toxicity

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network(1)
    for k, v in net.p.items():
        if k not in ("word", "ngram"):
            net.p[k] = v.astype(np.float64)
    g = rng.standard_normal((3, 5, 6 * toxicity.HIDDEN))
    mask = np.ones((3, 5))
    mask[1, 3:] = 0
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = toxicity._sigmoid(net.forward(g, mask))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grad, dg = net.gradients(g, mask, y)
    for name, at in [("u0", (2, 5)), ("u1", (1, 20)), ("wa", (3, 2)), ("va", (1,)), ("wo", (9,)), ("bo", (0,))]:
        kept, step = net.p[name][at], 1e-3
        net.p[name][at] = kept + step
        up = loss()
        net.p[name][at] = kept - step
        down = loss()
        net.p[name][at] = kept
        assert (up - down) / (2 * step) == pytest.approx(grad[name][at], abs=2e-4), name
    g[0, 2, 7] += 1e-3
    up = loss()
    g[0, 2, 7] -= 2e-3
    assert (up - loss()) / 2e-3 == pytest.approx(dg[0, 2, 7], abs=2e-4)


def test_fast_form_and_windows():
    net = toxicity.Network(2)
    rng = np.random.default_rng(1)
    table = rng.standard_normal((50, 6 * toxicity.HIDDEN)).astype(np.float32)
    w = rng.integers(0, 50, (40, toxicity.WINDOW))
    w[5, 9:] = -1
    slow = net.forward(table[w], (w >= 0).astype(np.float32))
    assert np.allclose(net.infer(table, w), slow, atol=1e-4)
    for n in (1, 15, 16, 17, 63, 64, 65, 112, 113, 500):
        rows = toxicity.windows_of(np.arange(n))
        assert set(rows[rows >= 0]) == set(range(n))
        assert all(r[0] == toxicity.STRIDE * i for i, r in enumerate(rows))


def test_long_texts_score_as_the_highest_of_their_windows(monkeypatch):
    net = toxicity.fit(["you idiot"] * 10 + ["fine words"] * 10, [1] * 10 + [0] * 10)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(5000)) + " idiot end"
    whole = list(toxicity.Scorer(net).scores([text, "", None, "idiot"]))
    monkeypatch.setattr(toxicity, "_BLOCK_WORDS", 4 * toxicity.STRIDE)
    assert list(toxicity.Scorer(net, 100).scores([text, "", None, "idiot"])) == pytest.approx(whole)
    assert whole[1] == whole[2] == net.prior <= 0.5


def test_one_class_or_nothing_to_learn():
    assert list(toxicity.Scorer(toxicity.fit([], [])).scores(["x", None])) == pytest.approx([0, 0])
    assert list(toxicity.Scorer(toxicity.fit(["a"], [1])).scores(["x"])) == pytest.approx([1])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    net = toxicity.train(docs, labels)
    rows = (
        toxicity.score(docs, net).join(labels, "doc_id").where(toxicity.held_out()).select("score", "toxic").collect()
    )
    bad = [r.score for r in rows if r.toxic == 1]
    fine = [r.score for r in rows if r.toxic == 0]
    # some toxic rows hold no sign of it
    assert sum(s >= 0.7 for s in bad) >= 0.7 * len(bad)
    assert sum(s >= 0.7 for s in fine) <= 0.03 * len(fine)
    # rejecting drops exactly those
    kept = toxicity.reject(docs, net).count()
    assert kept == toxicity.score(docs, net).where("score < 0.7").count()


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 40):
        c = lang_id.codewords(n)
        assert c.shape[0] == n and (np.abs(c.sum(0)) < n).all()
        apart = [(c[i] != c[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2 if n == 3 else 4 if n <= 5 else 5)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = lang_id.identify(docs, lang_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = out.where(lang_id.held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.96 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_undetermined_and_unlearned(spark):
    model = lang_id.fit(["the cat and the dog"] * 3 + ["le chat et le chien"] * 3, ["en"] * 3 + ["fr"] * 3)
    assert model.predict(None)[0] == model.predict(" 12 ²_!")[0] == lang_id.UNDETERMINED
    assert model.predict("the dog and the cat")[0] == "en" and model.predict("LE CHIEN ET LE CHAT")[0] == "fr"
    assert lang_id.fit([], []).predict("abc")[0] == lang_id.UNDETERMINED
    assert lang_id.fit(["a"], ["en"]).predict("abc")[:2] == ("en", 1.0)
    # a text between the two is ambiguous
    assert model.predict("xyz qqq")[2] or model.predict("xyz qqq")[1] < 0.9


def test_blocks_of_a_long_text_count_alike(monkeypatch):
    text = pq.read_table(f"{SF}/documents.parquet").column("text")[0].as_py()
    whole = lang_id.features(text)
    monkeypatch.setattr(lang_id, "_BLOCK", 64)
    assert np.allclose(lang_id.features(text), whole)


def test_decoding_equals_plain():
    """Every bit's classifier over plainly counted n-grams, and the codeword of the least loss."""
    rng = random.Random(4)
    words = {"en": "the cat and dog of house".split(), "fr": "le chat et chien de maison".split(), "de": "die katze und der hund".split(),
             "es": "el gato y perro de casa".split(), "it": "il gatto e cane di casa".split(), "pt": "o gato e cachorro da casa".split()}
    texts = [(" ".join(rng.choices(ws, k=12)), lang) for lang, ws in words.items() for _ in range(20)]
    model = lang_id.fit([t for t, _ in texts], [x for _, x in texts])
    right = 0
    for text, lang in texts[::3] + [("Ça, c'est 12 LE chat!", "fr")]:
        raw = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        data, counts = " ".join(raw.split(" ")).encode(), {}
        data = re.sub(rb"  +", b" ", data)
        for n in lang_id.SIZES:
            for i in range(len(data) - n + 1):
                gram = int.from_bytes(data[i : i + n], "big")
                at = ((gram + n) * 2654435761 & 0xFFFFFFFF) >> 20
                counts[at] = counts.get(at, 0) + 1
        total = sum(counts.values())
        losses = []
        for code in model.codes:
            loss = 0.0
            for bit in range(model.codes.shape[1]):
                margin = model.bias[bit] + sum(math.sqrt(k / total) * model.weights[at, bit] for at, k in counts.items())
                loss += model.bit_weight[bit] * math.log1p(math.exp(-code[bit] * margin))
            losses.append(loss)
        shares = [math.exp(min(losses) - x) for x in losses]
        got = model.predict(text)
        assert got[0] == model.languages[losses.index(min(losses))]
        assert got[1] == pytest.approx(max(shares) / sum(shares), abs=1e-3)
        right += got[0] == lang
    assert right >= 38
