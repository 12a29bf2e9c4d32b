"""Links, components and recall against brute force."""

import numpy as np
import pytest

from ledgerloom.llm import embeddings, queries


def brute(ids, vectors, least=0.95):
    x = np.array(vectors, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(np.triu(near))):
        u, v = sorted((find(a), find(b)), key=lambda i: ids[i])
        root[v] = u
    return {k: (int(near[i].sum()), ids[find(i)]) for i, k in enumerate(ids)}, near


def rotated(x, cosine, rnd):
    y = rnd.normal(size=x.shape)
    y -= (y @ x) * x / (x @ x)
    return cosine * x / np.linalg.norm(x) + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want, _ = brute(table.vec_id.tolist(), table.embedding.tolist())
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op6_embeddings(spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("chunk", [embeddings.CHUNK, 40])
def test_recall_and_groups(spark, chunk, monkeypatch):
    """Pairs just above the limit, a large group of near copies, copies: links
    are never wrong, and at least nine in ten are found."""
    monkeypatch.setattr(embeddings.near_copies, "__defaults__", (0.95, chunk))
    rnd = np.random.default_rng(1)
    v = [*rnd.normal(size=(1500, 64))]
    v += [rotated(x, c, rnd) for x, c in zip(v[:600], rnd.uniform(0.9505, 0.97, 600))]
    v += [rotated(x, 0.949, rnd) for x in v[600:800]]
    v += [v[900] / np.linalg.norm(v[900]) + rnd.normal(size=64) * 0.015 for _ in range(200)]
    v += [v[1000]] * 300 + [v[1001] * 3]
    ids = [int(i) for i in rnd.permutation(10 * len(v))[: len(v)]]
    v = [[float(a) for a in x] for x in v]
    want, near = brute(ids, v)
    got = {r.vec_id: r for r in embeddings.embedding_groups(spark.createDataFrame(list(zip(ids, v)), "vec_id long, embedding array<double>")).collect()}
    assert got.keys() == want.keys()
    assert all(got[i].n_links <= want[i][0] for i in ids)
    spread = [i for i in ids if 0 < want[i][0] < 100]
    assert sum(got[i].n_links for i in spread) >= 0.97 * sum(want[i][0] for i in spread)
    assert sum(r.n_links for r in got.values()) >= 0.99 * near.sum()
    assert all(got[i].kept == (got[i].component_id == i) and got[i].component_id >= want[i][1] for i in ids)
    assert sum(got[i].component_id == want[i][1] for i in ids) >= 0.97 * len(ids)


def test_edges_of_the_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.001]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (10, [-0.0, 1e30]), (11, [0.0, 1e-30]), (None, [0.5, -0.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, v long")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(df).collect())
    alone = [(str(i), 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([("1", 3, 1, True)] * 2 + [("2", 3, 1, False), ("None", 3, 1, False), ("10", 1, 10, True), ("11", 1, 10, False),
                          ("None", 0, None, False)] + alone, key=str)
    assert embeddings.embedding_groups(df.limit(0)).count() == 0


def test_query_over_a_table_with_links(spark, tmp_path):
    """The query itself, on a table that holds copies, close pairs and a chain."""
    rnd = np.random.default_rng(8)
    v = [*rnd.normal(size=(400, 32))]
    v += [rotated(x, c, rnd) for x, c in zip(v[:120], rnd.uniform(0.955, 0.99, 120))] + v[200:230]
    for _ in range(5):
        v.append(rotated(v[-1], 0.96, rnd))
    ids = [int(i) for i in rnd.permutation(len(v))]
    rows = [(i, [float(a) for a in x], 0) for i, x in zip(ids, v)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want, near = brute(ids, [x for _, x, _ in rows])
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op6_embeddings(spark, str(tmp_path)).collect()}
    assert near.sum() >= 300 and sum(n for n, _ in got.values()) >= 0.97 * near.sum()
    assert sum(got[i] == want[i] for i in ids) >= 0.97 * len(ids) and all(got[i][0] <= want[i][0] for i in ids)
