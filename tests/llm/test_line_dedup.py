import random

import brute
import pytest

from foliospark.llm import line_dedup


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(12)] + ["", "  "]
    texts = {}
    for i in range(60):
        own = [rng.choice(lines) for _ in range(rng.randint(0, 8))]
        if texts and rng.random() < 0.6:  # a passage of another text
            other = texts[rng.randrange(i)].split("\n")
            at = rng.randrange(len(other))
            own[rng.randint(0, len(own)) : 0] = other[at : at + rng.randint(1, 6)]
        texts[i] = "\n".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = line_dedup.remove_repeats(df, 8, counted=True)
    got = {r.doc_id: (r.text, r.n_lines_deleted) for r in out.collect()}
    gone = brute.repeated_lines(texts, 8)
    assert got == {i: (t, len(gone[i])) for i, t in brute.without_repeats(texts, 8).items()}
    assert sum(map(bool, gone.values())) > 10


def test_a_shared_line_of_a_third_of_all_rows(spark):
    common = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"own line {i}\n{common}" if i % 3 == 0 else f"own line {i}") for i in range(600)]
    out = line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0].endswith(common) and not any(common in got[i] for i in range(1, 600))
    assert all(got[i].startswith(f"own line {i}") for i in range(600))
