import duckdb
import numpy as np
import pytest

from patronlens.llm import queries, vptree

SF = "/root/testdata/sf0.01"


def plain(rows, k, asked):
    out = []
    for q, a in rows:
        if not asked(q):
            continue
        scores = [(-float(sum(np.float64(x) * np.float64(y) for x, y in zip(a, b))), v) for v, b in rows if v != q and len(a) == len(b)]
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(sorted(scores)[:k])]
    return out


def test_whole_table_equals_sql(spark):
    got = sorted(tuple(r) for r in queries.op3_nearest(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(queries.OP3_SQL).fetchall())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [r[3] for r in want]


@pytest.mark.parametrize("shape", ["ties", "lengths", "copies", "clusters"])
def test_exact_for_any_vectors(spark, shape):
    rng = np.random.default_rng(7)
    if shape == "ties":
        data = [rng.integers(-1, 2, 4).tolist() for _ in range(300)]
    elif shape == "lengths":
        data = [(rng.normal(size=rng.integers(1, 4)) * 10 ** float(rng.uniform(-3, 3))).tolist() for _ in range(200)]
    elif shape == "copies":
        data = [[1.0, 2.0, 0.5]] * 150 + [[1.0, 2.0, 0.25]] * 60 + [rng.normal(size=3).tolist() for _ in range(40)]
    else:
        data = [(rng.normal(size=6) * 0.05 + (np.arange(6) == i % 6) * 3).tolist() for i in range(300)]
    data = [[float(np.float32(x)) for x in v] for v in data]
    ids = rng.permutation(len(data)).tolist()
    df = spark.createDataFrame(list(zip(ids, data, ["x"] * len(data))), "vec_id long, embedding array<float>, rank string")
    vectors = vptree.usable(df)
    got = vptree.nearest(vectors, vectors.where("vec_id % 5 = 0"), 7, shard_rows=90, block_rows=25).collect()
    rows = [(i, v) for i, v in zip(ids, data) if any(v)]
    want = plain(rows, 7, lambda q: q % 5 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(w[:3] for w in want)
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in sorted(want)], rtol=1e-12)


def test_pruning_is_exact_at_one_and_cheaper_above():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 8)) * 4
    points = (centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 0.2).astype(float)
    queries_ = points[:200]
    tree = vptree.VantageTree(points)
    scores = queries_ @ points.T
    best = np.argsort(-scores, axis=1)[:, :10]
    recalls, costs = [], []
    for factor in (1.0, 2.0, 6.0):
        q, p, products = tree.search(queries_, 10, factor)
        found = [set(p[q == i].tolist()) for i in range(200)]
        recalls.append(np.mean([len(f & set(b.tolist())) / 10 for f, b in zip(found, best)]))
        costs.append(products)
    assert recalls[0] == 1.0 and recalls[1] >= 0.9
    assert costs[0] < scores.size and costs[0] >= costs[1] >= costs[2]


def test_bounds_hold():
    rng = np.random.default_rng(5)
    points, asked = rng.normal(size=(900, 5)) * 3, rng.normal(size=(50, 5))
    tree = vptree.VantageTree(points, leaf_rows=20)
    assert sorted(np.concatenate([leaf.rows for leaf in tree.leaves]).tolist()) == list(range(900))
    bounds = tree.bounds(asked)
    for i, leaf in enumerate(tree.leaves):
        square = (asked**2).sum(1)[:, None] + tree.longest - 2 * asked @ points[leaf.rows].T
        assert np.all(np.sqrt(square).min(axis=1) >= bounds[:, i] - 1e-9)


def test_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [])]
    rows += [(None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (8, [0.25, 9.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = vptree.usable(df)
    got = sorted(tuple(r) for r in vptree.nearest(vectors, vectors, 20).collect())
    assert got == [(1, 1, 8, 0.25), (8, 1, 1, 0.25)]
    empty = vectors.where("false")
    assert vptree.nearest(empty, empty, 20).count() == 0
    assert vptree.nearest(vectors, empty, 20).count() == 0
