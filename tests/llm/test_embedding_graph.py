import numpy as np

from helpers import components
from tollgate.llm import embedding_graph as M

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long"


def near_data(seed=1, n=700, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(200, n):
        if rng.random() < 0.4:
            x[i] = x[rng.integers(0, 200)] + rng.normal(size=dim) * 0.08
    x[50:60] = x[50]
    return x.astype(np.float32), rng.integers(0, 2, n)


def rows_of(x, label):
    return [(i, [float(v) for v in e], int(c), "s", 1) for i, (e, c) in enumerate(zip(x, label))]


def brute(x, label):
    u = x.astype(np.float64)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    a = (u @ u.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(a, False)
    return a


def test_links_and_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 100)
    monkeypatch.setattr(M, "BLOCK", 120)
    x, label = near_data()
    a = brute(x, label)
    df = spark.createDataFrame(rows_of(x, label), SCHEMA)
    got = {r.vec_id: r for r in M.near_duplicates(df).collect()}
    found = sum(min(got[i].n_links, int(a[i].sum())) for i in range(len(x)))
    assert a.sum() > 200 and found >= 0.97 * a.sum()
    assert all(got[i].n_links <= a[i].sum() for i in range(len(x)))
    want = components(list(range(len(x))), lambda i, j: a[i, j])
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) >= 0.99


def test_one_cell_is_exact(spark):
    x, label = near_data(seed=3, n=300)
    a = brute(x, label)
    df = spark.createDataFrame(rows_of(x, label), SCHEMA)
    res = M.near_duplicates(df)
    got = {r.vec_id: r for r in res.collect()}
    assert [got[i].n_links for i in range(len(x))] == a.sum(1).tolist()
    audit = M.audit(df, res, every=5).collect()[0]
    assert audit.recall == 1.0 and audit.queries == 60 and audit.links == int(a[::5].sum())


def test_odd_vectors(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(1, e, 0, "s", 1), (2, e, 0, "s", 1), (3, [2.0, 0.0, 0.0], 0, "s", 1), (4, e, 1, "s", 1), (5, e, None, "s", 1), (6, None, 0, "s", 1), (7, [0.0, 0.0, 0.0], 0, "s", 1),
            (8, [1.0, None, 0.0], 0, "s", 1), (9, [float("nan"), 1.0, 0.0], 0, "s", 1), (10, [float("inf"), 1.0, 0.0], 0, "s", 1), (11, [1.0, 0.0], 0, "s", 1), (None, e, 0, "s", 1),
            (1, e, 0, "s", 1), (12, [], 0, "s", 1), (13, [1e-30, 0.0, 0.0], 0, "s", 1), (14, [3e38, 0.0, 1.0], 0, "s", 1)]
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id in (1, 2, 3, 13, 14):
            assert (r.n_links, r.component_id, r.kept) == (4, 1, r.vec_id == 1)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
