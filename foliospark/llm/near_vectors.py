"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards. In each shard a graph is built whose lists are
pruned robustly (a neighbour is left out if one kept before is nearer to it by a factor); the lists
a vector has from its shards are united. Every vector then searches the shards it may have
neighbours in: greedily from their medoids, and from each hit on through all that are in range.
Links are verified in double precision, counted, and joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import components, cut_lineage, ship_code
from foliospark.operators.skew import lookup_join

THRESHOLD = 0.95
SEED = 29


@dataclass(frozen=True)
class Settings:
    threshold: float = THRESHOLD
    #: Vectors the centroids are fitted on: those with the smallest hash. All are indexed.
    sample: int = 20_000
    shard_size: int = 2_000
    #: More shards than this are made in two levels: cells, and shards within each cell.
    most_cells: int = 1_024
    #: A shard above this is split by a hash; queries go to all its parts.
    part_size: int = 4_096
    query_block: int = 4_096
    overlap: int = 2
    #: How far beyond a border a query looks: a partner lies off in a direction that is random, so
    #: many standard deviations of it count; in few dimensions that is all directions.
    reach: float = 1.5
    #: Of how many of its nearest centroids a query looks at the borders.
    borders: int = 4
    degree: int = 24
    candidates: int = 64
    alpha: float = 1.2
    medoids: int = 16
    beam: int = 16


def normalized(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def centroids(x: np.ndarray, count: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """Spherical k-means."""
    count = max(1, min(count, len(x)))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), count, replace=False)]
    for _ in range(rounds if count > 1 else 0):
        at = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def pruned_graph(x: np.ndarray, s: Settings) -> np.ndarray:
    """Adjacency lists (rows of positions, -1 beyond the end) of one shard.

    Candidates are the nearest vectors and a few random ones; among them the nearest is kept
    and those it covers are dropped, until `degree` are kept. Reverse edges fill free places.
    """
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1, np.int64)
    x = x.astype(np.float32)
    take = min(s.candidates, n - 1)
    rng = np.random.default_rng(SEED)
    out = np.full((n, 2 * s.degree), -1, np.int64)
    for at in range(0, n, 512):
        rows = np.arange(at, min(at + 512, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sim, take - 1, axis=1)[:, :take]
        cand = np.hstack([near, rng.integers(0, n, (len(rows), min(8, n - 1)))])
        sims = np.take_along_axis(sim, cand, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        alive = sims > -2
        alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
        vectors = x[cand]
        gap = np.sqrt(np.maximum(2 - 2 * sims, 0))
        for slot in range(s.degree):
            pick = alive.argmax(1)
            some = alive[np.arange(len(rows)), pick]
            if not some.any():
                break
            kept = cand[np.arange(len(rows)), pick]
            out[rows[some], slot] = kept[some]
            between = np.einsum("rcd,rd->rc", vectors, x[kept])
            covered = s.alpha * np.sqrt(np.maximum(2 - 2 * between, 0)) <= gap
            alive &= ~(covered & some[:, None])
            alive[np.arange(len(rows)), pick] = False
    # reverse edges, as far as there is room
    src, slot = np.nonzero(out[:, : s.degree] >= 0)
    dst = out[src, slot]
    order = np.lexsort((slot, dst))
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    room = rank < s.degree
    out[dst[room], s.degree + rank[room]] = src[room]
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """Positions of the vectors nearest to the shard's mean and to those of its clusters."""
    mean = x.mean(0, keepdims=True)
    middle = np.vstack([mean, centroids(x, count - 1, rounds=3)]) if len(x) > 1 else mean
    return np.unique((middle @ x.T).argmax(1))


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of queries, (query position, member position) of all found in range."""
    starts = medoids(x, s.medoids)
    x32, n = x.astype(np.float32), len(x)
    # single precision on the way; in range with room for its rounding, then exactly
    near = np.float32(s.threshold - 1e-4)
    beam = min(s.beam, n)
    for at in range(0, len(queries), 512):
        q64 = queries[at : at + 512]
        q, rows = q64.astype(np.float32), np.arange(len(q64))
        sims = np.full((len(q), n), -2, np.float32)  # -2: not seen
        sims[:, starts] = q @ x32[starts].T
        expanded = np.zeros((len(q), n), bool)
        # greedy: the beam holds the best seen, and its best not yet expanded goes next
        top = np.full((len(q), beam), -1, np.int64)
        top_sim = np.full((len(q), beam), -2, np.float32)
        first = starts[np.argsort(-sims[:, starts], axis=1)[:, :beam]]
        top[:, : first.shape[1]], top_sim[:, : first.shape[1]] = first, np.take_along_axis(sims, first, 1)
        live = rows
        while len(live):
            t, ts = top[live], top_sim[live]
            open_ = (t >= 0) & ~expanded[live[:, None], np.maximum(t, 0)]
            going = open_.any(1)
            live, t, ts, open_ = live[going], t[going], ts[going], open_[going]
            if not len(live):
                break
            pick = np.where(open_, ts, -3).argmax(1)
            node = t[np.arange(len(live)), pick]
            expanded[live, node] = True
            new = _visit(x32, graph[node], q, live, sims)
            both = np.hstack([t, np.where(new[1] > -2, new[0], -1)])
            both_sim = np.hstack([ts, new[1]])
            keep = np.argpartition(-both_sim, beam - 1, axis=1)[:, :beam]
            top[live], top_sim[live] = np.take_along_axis(both, keep, 1), np.take_along_axis(both_sim, keep, 1)
        # range expansion: every vector in range is expanded, and what it shows in range
        while True:
            todo = (sims >= near) & ~expanded
            live = np.nonzero(todo.any(1))[0]
            if not len(live):
                break
            node = todo[live].argmax(1)
            expanded[live, node] = True
            _visit(x32, graph[node], q, live, sims)
        a, b = np.nonzero(sims >= near)
        exact = np.einsum("pd,pd->p", q64[a], x[b]) >= s.threshold if len(a) else np.zeros(0, bool)
        yield a[exact] + at, b[exact]


def _visit(x32, neighbours, q, live, sims):
    """Note the similarity of neighbours not seen before; (positions, similarities or -2)."""
    known = sims[live[:, None], np.maximum(neighbours, 0)] > -2
    fresh = (neighbours >= 0) & ~known
    r, c = np.nonzero(fresh)
    found = np.full(neighbours.shape, -2, np.float32)
    if len(r):
        nodes = neighbours[r, c]
        found[r, c] = np.einsum("pd,pd->p", q[live[r]], x32[nodes])
        # a neighbour that a list names twice counts once
        sims[live[r], nodes] = found[r, c]
        pair = r.astype(np.int64) * len(x32) + nodes
        _, once = np.unique(pair, return_index=True)
        again = np.ones(len(r), bool)
        again[once] = False
        found[r[again], c[again]] = -2
    return neighbours, found


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same nodes as the pairs (a, b): each node with its smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _content(embedding: Column) -> list[Column]:
    return [
        F.size(embedding).alias("dim"),
        F.xxhash64(embedding).alias("k1"),
        F.xxhash64(F.lit(1), embedding).alias("k2"),
    ]


def _usable(embedding: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(dim, k1, k2, node, copies, vector): one row per distinct vector of `rows` (vec_id,
    embedding as doubles), node being its smallest vec_id."""
    keyed = rows.select("vec_id", "embedding", *_content(F.col("embedding")))
    return (
        keyed.groupBy("dim", "k1", "k2")
        .agg(F.min(F.struct("vec_id", "embedding")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("dim", "k1", "k2", F.col("first.vec_id").alias("node"), "copies", F.col("first.embedding").alias("vector"))
    )


def entered(x: np.ndarray, c: np.ndarray, s: Settings) -> np.ndarray:
    """Which cells each unit vector has to look into (rows by cells, its own among them).

    A partner at the threshold's angle t belongs to cell c rather than to a nearer one b only if it
    lies beyond the border between them. The border is the sine of an angle away, (x.b - x.c) / |b - c|,
    and a partner gets sin(t) towards it at most; or tan(t) / sqrt(dimensions - 1) times a standard
    normal number, if its direction is random.
    """
    sine = np.sqrt(max(0.0, 1 - s.threshold**2))
    limit = min(sine, sine / s.threshold * s.reach / np.sqrt(max(x.shape[1] - 1, 1)))
    sim = x @ c.T
    out = np.ones(sim.shape, bool)
    few = min(s.borders, len(c))
    best = np.argpartition(-sim, few - 1, axis=1)[:, :few]
    apart = np.sqrt(np.maximum(((c[:, None] - c[None, :]) ** 2).sum(2) if len(c) <= 64 else 2 * (1 - c @ c.T), 1e-12))
    for i in range(few):
        b = best[:, i]
        out &= sim[np.arange(len(x)), b][:, None] - sim <= limit * apart[b] + 1e-9
    return out


def _nearest(x: np.ndarray, c: np.ndarray, count: int) -> np.ndarray:
    return np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :count]


_PLACED = "node long, copies long, unit array<double>, shards array<long>, enters array<long>"


def _assign(vectors: DataFrame, count: int, s: Settings) -> DataFrame:
    """(node, copies, unit, shards, enters): with the unit vector, the shards that index it and those
    it searches. Shards grow in number with the table, not in size."""
    shards = -(-count // s.shard_size)
    cells = shards if shards <= s.most_cells else int(np.ceil(np.sqrt(shards)))
    sample = vectors.orderBy(F.xxhash64(F.lit(SEED), "node"), "node").limit(s.sample).select("vector")
    c = centroids(normalized(np.array([r.vector for r in sample.collect()], np.float64)), cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                x = normalized(np.array(part.column(2).to_pylist(), np.float64))
                enters = [np.flatnonzero(e) for e in entered(x, c, s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(list(x), pa.list_(pa.float64())),
                        pa.array(list(_nearest(x, c, s.overlap)), pa.list_(pa.int64())),
                        pa.array(enters, pa.list_(pa.int64())),
                    ],
                    ["node", "copies", "unit", "shards", "enters"],
                )

    placed = cut_lineage(vectors.select("node", "copies", "vector").mapInArrow(run, _PLACED))
    return placed if shards <= s.most_cells else _within_cells(placed, len(c), -(-shards // len(c)), s)


def _sizes(df: DataFrame, column: str) -> dict[int, int]:
    """How many rows name each element of an array column."""
    each = df.select(F.explode(column).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return {r.k: r.n for r in each.collect()}


def _within_cells(placed: DataFrame, cells: int, leaves: int, s: Settings) -> DataFrame:
    """The second level: each cell's own centroids, fitted on a bounded draw of its vectors, and for
    each vector its nearest of them in each of its cells, and those it looks into in each it enters."""
    home = F.col("shards")[0].alias("cell")
    sizes = {r.cell: r["count"] for r in placed.groupBy(home).count().collect()}  # one number for each cell
    wanted = min(s.sample, 40 * leaves)
    rate = F.get(F.array(*(F.lit(min(1.0, wanted / max(sizes.get(i, 0), 1))) for i in range(cells))), F.col("cell"))
    drawn = placed.select(home, "node", "unit").where(
        F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(1 << 20)) < F.greatest(rate * (1 << 20), F.lit(1))
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        own = centroids(np.stack(pdf.sort_values("node")["unit"].to_numpy()), leaves)
        return pd.DataFrame({"cell": pdf["cell"].iloc[0], "leaf": np.arange(len(own)), "centre": list(own)})

    fitted = cut_lineage(drawn.groupBy("cell").applyInPandas(fit, "cell long, leaf long, centre array<double>"))
    # a cell without a draw has one leaf, its whole
    looked = placed.select("node", "unit", "shards", F.explode(F.array_union("enters", "shards")).alias("cell"))
    many = {r.cell: r["count"] for r in looked.groupBy("cell").count().collect()}
    blocks = F.get(F.array(*(F.lit(max(1, -(-many.get(i, 0) // s.query_block))) for i in range(cells))), F.col("cell"))
    rows = looked.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    centres = fitted.withColumn("block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))

    def place(key: tuple, q: pd.DataFrame, leaf: pd.DataFrame) -> pd.DataFrame:
        if not len(q):
            return pd.DataFrame({"node": [], "own": [], "looks": []})
        base = key[0] * (leaves + 1)
        x = np.stack(q["unit"].to_numpy())
        if len(leaf):
            c = np.stack(leaf.sort_values("leaf")["centre"].to_numpy())
            nearest, looks = _nearest(x, c, 1)[:, 0], [np.flatnonzero(e) + base for e in entered(x, c, s)]
        else:
            nearest, looks = np.zeros(len(x), np.int64), [np.array([base])] * len(x)
        own = [[base + int(n)] if key[0] in cells_ else [] for n, cells_ in zip(nearest, q["shards"])]
        return pd.DataFrame({"node": q["node"], "own": own, "looks": looks})

    each = rows.groupBy("cell", "block").cogroup(centres.groupBy("cell", "block"))
    # as many rows for a vector as it has cells
    lists = each.applyInPandas(place, "node long, own array<long>, looks array<long>").groupBy("node").agg(
        F.flatten(F.collect_list("own")).alias("shards"), F.flatten(F.collect_list("looks")).alias("enters")
    )
    return cut_lineage(placed.select("node", "copies", "unit").join(lists, "node").select("node", "copies", "unit", "shards", "enters"))


def _grouped(df: DataFrame, column: str, most: int) -> DataFrame:
    """(shard, groups): how many groups of about `most` rows each shard of an array column is cut into."""
    each = df.select(F.explode(column).alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    return each.select("shard", F.ceil(F.col("n") / most).cast("int").alias("groups"))


def _linked(vectors: DataFrame, s: Settings) -> DataFrame:
    """(a, b, n): rows with b name an edge, rows without it n found copies near a. For vectors of
    one dimension."""
    placed = _assign(vectors, vectors.count(), s)
    # one small row for each shard
    parts = _grouped(placed, "shards", s.part_size).withColumnRenamed("groups", "parts")
    blocks = _grouped(placed, "enters", s.query_block).withColumnRenamed("groups", "blocks")
    cut = cut_lineage(parts.join(blocks, "shard", "left").select("shard", "parts", F.coalesce("blocks", F.lit(1)).alias("blocks")))
    members = lookup_join(
        placed.select("node", "copies", "unit", "shards", F.explode("shards").alias("shard")), cut, ["shard"], ["node"], "inner"
    ).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        graph = pruned_graph(np.stack(pdf["unit"].to_numpy()), s)
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"node": node, "near": [node[g[g >= 0]] for g in graph]})

    lists = (
        members.groupBy("shard", "part")
        .applyInPandas(build, "node long, near array<long>")
        .groupBy("node")
        # one list from each of the few shards that hold the vector
        .agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    )
    indexed = members.join(lists, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    looking = placed.select(
        F.col("node").alias("asked"), F.col("unit").alias("look"), "enters", F.explode("enters").alias("shard")
    )
    # a shard that is entered and holds nothing has no parts
    queries = (
        lookup_join(looking, cut, ["shard"], ["asked"], "inner")
        .withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "asked"), F.col("blocks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )

    def find(key: tuple, m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
        if not len(m) or not len(q):
            return none
        m = m.sort_values("node")
        node, shard = m["node"].to_numpy(), key[0]
        # the lowest other shard that has the member, if it is below this one
        lower = np.array([min((k for k in ks if k < shard), default=-1) for ks in m["shards"]], np.int64)
        several = np.array([sum(k < shard for k in ks) > 1 for ks in m["shards"]], bool)
        copies, x = m["copies"].to_numpy(), np.stack(m["unit"].to_numpy())
        width = max(map(len, m["near"]), default=1) or 1
        graph = np.full((len(m), width), -1, np.int64)
        for i, near in enumerate(m["near"]):
            # a united list also names vectors of other shards
            at = np.searchsorted(node, near)
            at = at[(at < len(node)) & (node[np.minimum(at, len(node) - 1)] == near)]
            graph[i, : len(at)] = at
        asked, enters = q["asked"].to_numpy(), q["enters"].to_numpy()
        found = np.zeros(len(q), np.int64)

        # (query, shard) of all shards that the queries look into
        wide = 1 + max([int(shard), *(int(max(e, default=0)) for e in enters)])
        at = np.repeat(np.arange(len(q)), [len(e) for e in enters])
        looked = np.sort(at * wide + np.concatenate([*enters, np.zeros(0, np.int64)]).astype(np.int64))

        def looks(a: np.ndarray, k: np.ndarray) -> np.ndarray:
            at = np.searchsorted(looked, a * wide + k)
            return (at < len(looked)) & (looked[np.minimum(at, len(looked) - 1)] == a * wide + k)

        def counted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether this is the lowest of the shards that have the member and are searched."""
            out = np.ones(len(a), bool)
            one = np.flatnonzero((lower[b] >= 0) & ~several[b])
            out[one] = ~looks(a[one], lower[b[one]])
            for i in np.flatnonzero(several[b]):
                below = np.array([k for k in m["shards"].iloc[b[i]] if k < shard])
                out[i] = not looks(np.full(len(below), a[i]), below).any()
            return out

        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in search(x, graph, np.stack(q["look"].to_numpy()), s):
            other = asked[a] != node[b]
            a, b = a[other], b[other]
            once = counted(a, b)  # no link counts twice
            np.add.at(found, a[once], copies[b[once]])
            ends.append(forest(asked[a], node[b]))
        u, v = forest(np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]))
        some = found > 0
        return pd.concat(
            [
                pd.DataFrame({"a": asked[some], "b": pd.NA, "n": found[some]}),
                pd.DataFrame({"a": u, "b": v, "n": pd.NA}),
            ]
        ).astype("Int64")

    keys = ["shard", "part", "block"]
    indexed = indexed.select(*keys, "node", "copies", "unit", "shards", "near")
    queries = queries.select(*keys, "asked", "look", "enters")
    return indexed.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(find, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, reaches the threshold; equal
    vectors are collapsed before the search and counted as linked to each other. Vectors that
    are null, zero, or hold null or non-finite components, vectors of another length, and rows
    without vec_id link with nothing (a null vec_id gives a null component and is kept). Rows that
    repeat a vec_id are vectors of their own in the counts and share a component. Other columns
    are not read; an empty table gives no rows. Search is approximate: what is found is
    verified, and `audit_recall` measures what is missed.
    """
    s = settings or Settings()
    ship_code(vectors)
    kind = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), kind.alias("embedding"))
    usable = F.col("vec_id").isNotNull() & _usable(F.col("embedding"))
    known = cut_lineage(distinct_vectors(rows.where(usable)))
    found: DataFrame | None = None
    # lengths of vectors: one in a sound table
    for (dim,) in known.select("dim").distinct().orderBy("dim").collect():
        part = _linked(known.where(F.col("dim") == dim), s)
        found = part if found is None else found.unionByName(part)
    keyed = rows.select(
        "vec_id",
        *(F.when(usable, c).alias(n) for c, n in zip(_content(F.col("embedding")), ("dim", "k1", "k2"))),
    )
    if found is None:
        per_vector = known.select("dim", "k1", "k2", F.lit(0).alias("n_links"), F.col("node").alias("component_id"))
    else:
        found = cut_lineage(found)
        linked = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        reached = components(found.where("b IS NOT NULL").select("a", "b"))
        per_vector = (
            known.select("dim", "k1", "k2", "node", "copies")
            .join(linked, "node", "left")
            .join(reached, "node", "left")
            .select(
                "dim", "k1", "k2",
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component_id"),
            )
        )
    out = lookup_join(keyed, per_vector, ["dim", "k1", "k2"], ["vec_id"])
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def exact_links(vectors: DataFrame, every: int = 50, threshold: float = THRESHOLD, block: int = 2048) -> DataFrame:
    """(vec_id, n): links of the vectors whose id `every` divides, counted by comparing them with
    all rows in blocks of bounded size: the truth that `audit_recall` holds results against."""
    ship_code(vectors)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    queries = rows.where(F.col("vec_id") % every == 0)
    q_blocks = max(1, -(-queries.count() // block))
    m_blocks = max(1, -(-rows.count() // block))
    q = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks))).withColumn(
        "mb", F.explode(F.sequence(F.lit(0), F.lit(m_blocks - 1)))
    )
    m = rows.withColumn("mb", F.pmod(F.xxhash64("vec_id"), F.lit(m_blocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>"))
    )

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"vec_id": [], "n": []}).astype("int64")
        sim = normalized(np.stack(a["v"])) @ normalized(np.stack(b["v"])).T >= threshold
        same = a["vec_id"].to_numpy()[:, None] == b["vec_id"].to_numpy()[None, :]
        return pd.DataFrame({"vec_id": a["vec_id"], "n": (sim & ~same).sum(1)})

    each = q.groupBy("qb", "mb").cogroup(m.groupBy("qb", "mb")).applyInPandas(compare, "vec_id long, n long")
    return each.groupBy("vec_id").agg(F.sum("n").alias("n"))


def audit_recall(vectors: DataFrame, result: DataFrame, every: int = 50, threshold: float = THRESHOLD) -> float:
    """Share of the true links of the audited vectors that `result` counts; 1 if there are none."""
    true = exact_links(vectors, every, threshold)
    both = true.join(result.groupBy("vec_id").agg(F.max("n_links").alias("got")), "vec_id")
    n, got = both.agg(F.sum("n"), F.sum(F.least("n", "got"))).first()
    return got / n if n else 1.0
