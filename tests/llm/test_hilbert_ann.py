import numpy as np

from pixelflow.llm import hilbert_ann as H

SCHEMA = "vec_id bigint, embedding array<double>"


def model(rows, k, every):
    """Query rows against all other rows."""
    rows = [(i, np.array(v)) for i, v in rows]
    out = []
    for a, (q, v) in enumerate(rows):
        if q % every == 0:
            s = sorted((-float(v @ w), i) for b, (i, w) in enumerate(rows) if b != a)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def search(spark, rows, **cfg):
    got = H.search(spark.createDataFrame(rows, SCHEMA).repartition(3), H.CurveConfig(**cfg)).collect()
    return sorted(tuple(r) for r in got)


def same(got, want):
    assert len(got) == len(want)
    assert all(g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


def test_keys_walk_through_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = H.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_clusters_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 10)) * 4
    v = [(centres[i % 12] + rng.normal(size=10) * 0.3).round(3).tolist() for i in range(900)]
    for i in range(100, 500):
        v[i] = v[20]                                    # one vector with almost half of all rows
    rows = list(enumerate(v)) + [(40, v[41]), (40, v[40]), (60, v[20])]
    same(search(spark, rows, block=32), model(rows, 20, 20))


def test_random_directions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-2, 3, 6) + 0.0).tolist()) for i in range(400)]
    rows = [(i, v) for i, v in rows if any(v)]
    same(search(spark, rows, block=16, k=5), model(rows, 5, 20))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [1.0, 2.0]), (40, None)]
    got = search(spark, rows)
    same(got, model([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 2.0])], 20, 20))
    assert search(spark, []) == [] and search(spark, [(1, [1.0])]) == [] and search(spark, [(0, [1.0])]) == []
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as q", "3 as score", "4 as block", "5 as label")
    assert sorted(tuple(r) for r in H.search(df).collect()) == got
