import numpy as np
import pytest

from foliospark.llm import near_vectors as V

SMALL = V.Settings(sample=500, shard_size=60, part_size=70, query_block=50)
TWO_LEVELS = V.Settings(sample=500, shard_size=40, part_size=50, query_block=45, most_cells=5)


def _table(seed, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((400, dim))
    groups = [c + rng.standard_normal((n, dim)) * 0.02 for c, n in zip(rng.standard_normal((4, dim)), (2, 5, 60, 150))]
    x = np.vstack([x, *groups, x[:10], -x[:3]]) * rng.uniform(0.01, 100, (630, 1))
    # and a chain whose ends are far apart
    turn = np.linspace(0, np.pi, 30)
    chain = np.zeros((30, dim))
    chain[:, 0], chain[:, 1] = np.cos(turn), np.sin(turn)
    return np.vstack([x, chain])


@pytest.mark.parametrize("seed, settings", [(1, SMALL), (2, SMALL), (2, TWO_LEVELS)])
def test_links_and_components(spark, seed, settings):
    x = _table(seed)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = V.near_duplicates(df, settings=settings).toPandas().sort_values("vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(unit @ unit.T >= V.THRESHOLD)
    degree = np.bincount(a, minlength=len(x)) - 1
    assert (got["n_links"].to_numpy() <= degree).all()  # none that is not one
    assert got["n_links"].sum() >= 0.98 * degree.sum()
    label = np.arange(len(x))
    u, v = V.forest(a, b)
    label[u] = v
    assert (got["component_id"].to_numpy() == label).mean() >= 0.99
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_audit(spark):
    x = _table(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = V.near_duplicates(df, settings=SMALL)
    assert V.audit_recall(df, out, every=7) >= 0.98
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {i: int((unit[i] @ unit.T >= V.THRESHOLD).sum()) - 1 for i in range(0, len(x), 50)}
    assert {r.vec_id: r.n for r in V.exact_links(df, block=100).collect()} == want


def test_forest_connects_the_same_nodes():
    a, b = np.array([5, 9, 3, 7, 7]), np.array([9, 2, 4, 7, 8])
    u, v = V.forest(a, b)
    assert dict(zip(u, v)) == {5: 2, 9: 2, 4: 3, 8: 7}


def test_tiny_shards():
    for n in (1, 2, 3, 40):
        x = V.normalized(np.random.default_rng(n).standard_normal((n, 5)))
        pairs = {p for a, b in V.search(x, V.pruned_graph(x, V.Settings()), x, V.Settings()) for p in zip(a, b)}
        assert pairs >= {(i, i) for i in range(n)}


@pytest.mark.parametrize("dim", [3, 8, 16, 64])
def test_partners_are_in_an_entered_cell(dim):
    """Vectors at the threshold: one of the partner's two cells is entered."""
    rng = np.random.default_rng(dim)
    s = V.Settings()
    x = V.normalized(rng.standard_normal((4000, dim)))
    c = V.centroids(x, 30)
    away = rng.standard_normal(x.shape)
    away = V.normalized(away - (away * x).sum(1, keepdims=True) * x)
    partner = s.threshold * x + np.sqrt(1 - s.threshold**2) * away
    enters, near = V.entered(x, c, s), V._nearest(partner, c, s.overlap)
    rows = np.arange(len(x))
    home = enters[rows, near[:, 0]].mean()
    either = np.mean([enters[rows, near[:, k]] for k in range(s.overlap)], axis=0) > 0
    assert home >= 0.96 and either.mean() >= 0.99
    assert (enters[rows, V._nearest(x, c, 1)[:, 0]]).all()


def test_recall_with_the_settings_of_the_query(spark):
    """Several shards, few dimensions, pairs planted just above the threshold."""
    rng = np.random.default_rng(3)
    x = V.normalized(rng.standard_normal((9000, 16)))
    away = rng.standard_normal((1500, 16))
    away = V.normalized(away - (away * x[:1500]).sum(1, keepdims=True) * x[:1500])
    x = np.vstack([x, 0.952 * x[:1500] + np.sqrt(1 - 0.952**2) * away])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = V.near_duplicates(df.repartition(4)).toPandas().sort_values("vec_id")["n_links"].to_numpy()
    true = np.array([(x[i : i + 500] @ x.T >= V.THRESHOLD).sum(1) - 1 for i in range(0, len(x), 500)]).ravel()
    assert (got <= true).all() and got.sum() >= 0.98 * true.sum()
