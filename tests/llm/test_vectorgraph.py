"""Embedding near-duplicates against brute force."""

import numpy as np

from pitchmetrics.llm import queries, vectorgraph


def _vectors(seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(1500, 64))
    for g in range(40):
        size = (2, 3, 5, 120)[g % 4]
        rows = rng.choice(1500, size, replace=False)
        x[rows] = x[rows[0]] + rng.normal(size=(size, 64)) * (0.05 + 0.25 * rng.random())
    x[100:140] = x[99]
    return x.astype(np.float32)


def _brute(x, least=0.9):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = u @ u.T >= least
    np.fill_diagonal(links, False)
    low = np.arange(len(x))
    while True:
        new = np.minimum(low, np.where(links, low[None], len(x)).min(1))
        new = new[new]
        if (new == low).all():
            return links.sum(1), low
        low = new


def test_recall_and_components(spark):
    x = _vectors()
    links, low = _brute(x)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, component_id int").repartition(3)
    got = {r.vec_id: r for r in vectorgraph.near_duplicates(df).collect()}
    assert len(got) == len(x)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()
    assert np.mean([got[i].component_id == low[i] for i in range(len(x))]) >= 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_blocks_and_chunks(spark, monkeypatch):
    """A shard dealt into several blocks finds the same."""
    x = _vectors(2)[:600]
    links, _ = _brute(x)
    monkeypatch.setattr(vectorgraph, "BLOCK", 100)
    monkeypatch.setattr(vectorgraph, "CHUNK", 30)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r.n_links for r in vectorgraph.near_duplicates(df).collect()}
    total = np.array([found[i] for i in range(len(x))])
    assert (total <= links).all() and total.sum() >= 0.95 * links.sum()


def test_edge_cases(spark):
    a, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [(1, a), (1, a), (None, a), (7, [2.0, 4.0]), (8, None), (9, [0.0, 0.0]), (10, [nan, 1.0]), (11, [None, 1.0]), (12, [inf, 1.0]),
            (13, [1.0, 2.0, 3.0]), (14, [-1.0, -2.0]), (15, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in vectorgraph.near_duplicates(df).collect())
    assert got == [(-1, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (7, 3, 1, False)] + [(k, 0, k, True) for k in range(8, 16)]
    assert vectorgraph.near_duplicates(df.limit(0)).collect() == []
    assert [r.n_links for r in vectorgraph.near_duplicates(df.filter("vec_id = 9")).collect()] == [0]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], np.float32)
    links, _ = _brute(x)
    got = {r.vec_id: r.n_links for r in queries.op6_embedding_dedup(spark, sf).collect()}
    assert got == {r.vec_id: n for r, n in zip(rows, links, strict=True)}


def _frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)


def test_large_group_of_near_copies_is_one_shard(spark, monkeypatch):
    """A third of the vectors are distinct near copies; the first search finds their links."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2400, 64)).astype(np.float32)
    x[:800] = x[0] + rng.normal(size=(800, 64)) * 0.3
    links, _ = _brute(x)
    monkeypatch.setattr(vectorgraph, "MEMBERS", 60)
    monkeypatch.setattr(vectorgraph, "recall", lambda *_: 1.0)
    found = {r.vec_id: r.n_links for r in vectorgraph.near_duplicates(_frame(spark, x)).collect()}
    share = np.array([found[i] for i in range(800)]) / links[:800]
    assert share.min() >= 0.97 and share.max() <= 1


def _pairs(seed, n, many, cos=0.905):
    """n vectors, the first 2 x many of them pairs at the cosine."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a = x[:many]
    w = rng.normal(size=a.shape)
    w -= (w * a).sum(1, keepdims=True) * a
    x[many:2 * many] = cos * a + np.sqrt(1 - cos ** 2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    return x.astype(np.float32)


def test_a_link_counts_for_both_ends(spark, monkeypatch):
    x = _pairs(4, 2400, 400)
    monkeypatch.setattr(vectorgraph, "MEMBERS", 100)
    monkeypatch.setattr(vectorgraph, "recall", lambda *_: 1.0)
    got = {r.vec_id: r for r in vectorgraph.near_duplicates(_frame(spark, x)).collect()}
    joined = [i for i in range(400) if got[i].component_id == got[400 + i].component_id]
    assert len(joined) > 300
    assert all(got[i].n_links == got[400 + i].n_links == 1 for i in joined)


def test_the_last_search_is_audited(spark, monkeypatch):
    """Pairs near the limit, which overlap alone does not find, are found in the end."""
    x = _pairs(5, 2400, 400)
    links, low = _brute(x)
    monkeypatch.setattr(vectorgraph, "MEMBERS", 30)
    monkeypatch.setattr(vectorgraph, "OVERLAP", 1)
    monkeypatch.setattr(vectorgraph, "MOST_OVERLAP", 1)
    got = {r.vec_id: r for r in vectorgraph.near_duplicates(_frame(spark, x)).collect()}
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == low.tolist()


def test_audit_is_per_node_with_links(spark):
    """A large group that was found does not hide pairs that were not, nor does their rarity."""
    rng = np.random.default_rng(6)
    x = _pairs(6, 3000, 20)
    x[2900:] = x[2900] + rng.normal(size=(100, 64)) * 0.01
    nodes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "node long, weight long, vector array<float>")
    links, _ = _brute(x)
    found = spark.createDataFrame([(i, int(links[i]) if i >= 2900 else 0) for i in range(3000)], "node long, found long")
    assert vectorgraph.recall(nodes, found, 0.9) < 0.9
    assert vectorgraph.recall(nodes.filter("node < 2900"), found, 0.9) == 0.0
    exact = spark.createDataFrame([(i, int(links[i])) for i in range(3000)], "node long, found long")
    assert vectorgraph.recall(nodes, exact, 0.9) == 1.0


def test_each_length_is_searched(spark):
    """Vectors of three lengths, the rarest with a pair, and equal rows, link among themselves."""
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(_pairs(8, 60, 10, 0.99))]
    short = rng.normal(size=(6, 5))
    short[1] = short[0] * 3 + 0.001
    rows += [(100 + i, v.tolist()) for i, v in enumerate(short)] + [(200, [1.0, 2.0]), (201, [1.0, 2.0]), (202, None), (203, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           vectorgraph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i] for i in (100, 101, 200, 201, 202, 203)] == [(1, 100), (1, 100), (1, 200), (1, 200), (0, 202), (0, 203)]
    assert all(got[i] == (1, i) and got[10 + i] == (1, i) for i in range(10))
    assert len(got) == len(rows)
