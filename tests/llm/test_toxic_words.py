"""Every part of a text reaches the network, whatever parts its words."""

import math
import random

import numpy as np
import pytest

from foliospark.llm import toxicity

PARTS = ["—", "…", "”", "“", "\u00a0", "、", "。", "·", "²"]


@pytest.mark.parametrize("mark", PARTS)
def test_marks_beyond_ascii_part_words(mark):
    assert toxicity.words_of(f"something{mark}Idiot") == [b"something", b"idiot"]


def test_many_kinds_of_marks_part_words():
    marks = [chr(c) for c in range(0x2190, 0x2400)]
    assert toxicity.words_of("a" + "b".join(marks)) == [b"a"] + [b"b"] * (len(marks) - 1)


def test_digits_are_part_of_words():
    assert toxicity.words_of("1d10t 5tup1d, you 4re") == [b"1d10t", b"5tup1d", b"you", b"4re"]


def test_scores_equal_plain_windows():
    """Each window alone through the network's plain forward pass, the highest one counts."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["you", "Idiot!", "river", "für", "4re", "—"]) for _ in range(n)) for n in (1, 5, 63, 64, 65, 96, 97, 500)]
    net = toxicity.fit(texts * 4, [int("Idiot" in t and i % 3 > 0) for i, t in enumerate(texts * 4)])
    for text, score in zip(texts, toxicity.Scorer(net).scores(texts)):
        words, logits, at = toxicity.words_of(text), [], 0
        while words:
            window = words[at : at + 64]
            rows = np.zeros((1, 64, 6 * toxicity.HIDDEN), np.float32)
            rows[0, : len(window)] = net.projected(window)
            mask = np.array([[float(i < len(window)) for i in range(64)]], np.float32)
            logits.append(float(net.forward(rows, mask)[0]))
            if at + 64 >= len(words):
                break
            at += 32
        want = net.prior if not words else 1 / (1 + math.exp(-(net.scale * max(logits) + net.shift)))
        assert score == pytest.approx(want, abs=1e-4)


def test_letters_and_marks_stay_together():
    for word in ("für", "हिन्दी", "cafe\u0301", "١٢٣"):
        assert toxicity.words_of(word) == [word.encode()]


def test_long_runs_are_read_to_their_end():
    rng = random.Random(1)
    for letters in ("abcdefgh", "的一是不了人我在", "éèüabc", "กขคงจ", "𐐨𐐩a"):
        for n in range(1, 80):
            run = "".join(rng.choice(letters) for _ in range(n))
            pieces, at = toxicity.words_of(run), 0
            for p in pieces:
                assert len(p) <= toxicity.PIECE_BYTES and p.decode()
                found = run.encode().find(p, max(0, at - toxicity.SHARED - 3))
                assert 0 <= found <= at
                at = max(at, found + len(p))
            assert at == len(run.encode())


def test_ngrams_of_the_whole_word():
    one, two = (toxicity.word_inputs([w]) for w in (b"understandable", b"understandably"))
    assert set(one[1][one[2] > 0]) - set(two[1][two[2] > 0])
    assert one[2].sum() == 14 + 13 + 8


def test_toxic_words_after_a_dash_and_in_an_unspaced_run():
    rng = random.Random(2)
    filler = "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长"
    clean = lambda n: "".join(rng.choice(filler) for _ in range(n))
    plain = "the day was fine and we went along river to see green hills near old town".split()
    say = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    texts, labels = [], []
    for _ in range(60):
        texts += [clean(rng.randint(0, 60)) + "笨蛋" + clean(rng.randint(0, 60)), clean(80)]
        texts += [f"{say(9)} idiot {say(9)}", say(20)]
        labels += [1, 0, 1, 0]
    scorer = toxicity.Scorer(toxicity.fit(texts, labels))
    bad = [clean(300) + "笨蛋" + clean(40), f"{say(8)} something—idiot"]
    good = [clean(342), f"{say(8)} something—river"]
    scores = list(scorer.scores(bad + good))
    assert min(scores[:2]) > max(scores[2:]), scores
