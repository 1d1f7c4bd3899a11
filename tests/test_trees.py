"""Trees on counted cells: against trees on rows, and the same under any partitioning."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from patronlens.models import grid, trees
from patronlens.models.metrics import classification_metrics


def best_split(x, y):
    """The cut of least squares over all features of a small table, by trying each."""
    best = (0.0, None, None)
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            low = x[:, j] <= cut
            won = ((y - y.mean()) ** 2).sum() - sum(((p - p.mean()) ** 2).sum() for p in (y[low], y[~low]))
            if won > best[0] + 1e-9:
                best = (won, j, cut)
    return best


def grown(x, y, depth):
    won, j, cut = best_split(x, y) if depth and len(y) > 1 else (0, None, None)
    if j is None:
        return np.full(len(y), y.mean())
    found, low = np.empty(len(y)), x[:, j] <= cut
    found[low], found[~low] = grown(x[low], y[low], depth - 1), grown(x[~low], y[~low], depth - 1)
    return found


def test_regression_trees_equal_trees_on_rows():
    pick = np.random.default_rng(3)
    for _ in range(8):
        x = pick.integers(0, 5, (120, 3)).astype(np.uint8)
        y = np.round(3.0 * x[:, 0] - x[:, 1] * x[:, 2] + pick.normal(size=120), 3)
        cells, place = np.unique(x, axis=0, return_inverse=True)
        n, total = np.bincount(place).astype(float), np.bincount(place, y)
        for depth in (1, 2, 3):
            got = trees.grow_regression(cells, n, total, depth)[place]
            assert ((y - got) ** 2).sum() == pytest.approx(((y - grown(x, y, depth)) ** 2).sum())


def test_cells_without_rows_get_the_value_of_their_leaf():
    bins = np.array([[0], [1], [2], [3]], np.uint8)
    got = trees.grow_regression(bins, np.array([5.0, 0, 0, 5]), np.array([5.0, 0, 0, 50]), 1)
    assert got[0] == 1 and got[3] == 10 and set(got) == {1, 10}
    chance, gone = trees.grow_classifier(bins, np.array([9.0, 0, 0, 0]), np.array([0, 0, 0, 9.0]), 4, np.random.default_rng(1))
    assert chance[0] == 0 and chance[3] == 1 and gone.tolist() == [1.0]


@pytest.fixture(scope="module")
def shoppers(spark):
    pick = np.random.default_rng(11)
    n = 1500
    a, b, c = pick.integers(0, 60, n), pick.exponential(100, n).round(2), pick.integers(0, 4, n)
    y = (a * 5 + b * (1 + c) + pick.normal(0, 40, n)).clip(0).round(2)
    label = (pick.random(n) < 1 / (1 + np.exp(-(a - 30) / 6 + (c == 2) * 3))).astype(int)
    table = pa.table({"id": [f"r{i}" for i in range(n)], "a": a.astype(float), "b": b, "c": [f"v{i}" for i in c], "y": y, "label": label})
    return spark.createDataFrame(table)


def cells_of(rows, totals, parts):
    bins_rows, bins = grid.binned(rows.repartition(parts), "id", ["a", "b"], ["c"], ["id", "y", "label"], "test-bins")
    return bins_rows, bins, grid.counted_cells(bins_rows, bins.keys, totals)


def test_boosting_is_as_good_as_on_rows(spark, shoppers):
    total = F.sum(F.col("y").cast("decimal(24,4)")).cast("double")
    losses, predictions = [], []
    for parts in (1, 5):
        rows, bins, cells = cells_of(shoppers, {"n": F.count("y"), "total": total}, parts)
        assert bins.names == ["a", "b", "c_v0", "c_v1", "c_v2", "c_v3"]
        counts = (cells.column(c).to_numpy().astype(float) for c in ("n", "total"))
        fitted = trees.boosted_cells(spark, bins.matrix(cells), *counts, 60, 0.1, 3)
        found = grid.on_rows(rows, bins.keys, cells, fitted).select("id", "y", "prediction")
        predictions.append(sorted(map(tuple, found.collect())))
        losses.append(np.sqrt(np.mean([(y - p) ** 2 for _, y, p in predictions[-1]])))
    assert predictions[0] == predictions[1]
    values = F.array(*[(F.col("c") == f"v{i}").cast("double") for i in range(4)])
    wide = shoppers.select("y", "a", "b", *[values[i].alias(f"c{i}") for i in range(4)])
    wide = VectorAssembler(inputCols=["a", "b", "c0", "c1", "c2", "c3"], outputCol="features").transform(wide)
    plain = GBTRegressor(labelCol="y", maxIter=60, stepSize=0.1, maxDepth=3, seed=1).fit(wide).transform(wide)
    on_rows = plain.select(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert losses[0] <= 1.1 * on_rows


def test_forest_is_as_good_as_on_rows(spark, shoppers):
    scores = []
    for parts in (1, 4):
        rows, bins, cells = cells_of(shoppers, {"low": F.count_if(F.col("label") == 0), "high": F.count_if(F.col("label") == 1)}, parts)
        low, high = (cells.column(c).to_numpy() for c in ("low", "high"))
        votes = trees.forest_votes(spark, bins.matrix(cells), low, high, (1.0, 1.0), 40, 8, 42)
        share = votes.where("cell >= 0").select("cell", (F.col("votes") / (40.0 * trees.VOTE_UNIT)).alias("score"))
        scored = grid.on_rows(rows, bins.keys, cells, share).select("id", "label", "score")
        scores.append(sorted(map(tuple, scored.collect())))
        importances = {r.feature: r.votes for r in votes.where("feature >= 0").collect()}
        assert max(importances, key=importances.get) == 0
    assert scores[0] == scores[1]
    auc = classification_metrics(scored, "label", "score").first().auc_roc
    values = [(F.col("c") == f"v{i}").cast("double").alias(f"c{i}") for i in range(4)]
    wide = VectorAssembler(inputCols=["a", "b", "c0", "c1", "c2", "c3"], outputCol="features").transform(
        shoppers.select("label", "a", "b", *values)
    )
    plain = RandomForestClassifier(numTrees=40, maxDepth=8, seed=1, featureSubsetStrategy="sqrt").fit(wide).copy().transform(wide)
    plain = plain.select("label", F.element_at(vector_to_array("probability"), 2).alias("score"))
    assert auc >= classification_metrics(plain, "label", "score").first().auc_roc - 0.02


def test_cells_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(grid, "MAX_CELLS", 100)
    df = spark.range(3000).selectExpr(
        "cast(id as string) as id", "cast(id as double) as a", "cast((id * 7919) % 3000 as double) as b",
        "concat('v', cast(sqrt(id) as int)) as c",
    )
    rows, bins = grid.binned(df, "id", ["a", "b"], ["c"], ["id"], "few-cells")
    assert rows.select(*bins.keys).distinct().count() <= 100 and rows.count() == 3000
    assert grid.OTHER in bins.values["c"]


def test_bounds_and_values(spark):
    assert grid._bounds(np.array([1.0, 1, 2, 5]), 32) == (1.5, 3.5)
    assert len(grid._bounds(np.arange(1000.0), 32)) == 31
    assert grid._bounds(np.array([]), 32) == () and grid._bounds(np.zeros(50), 4) == ()
    df = spark.createDataFrame([(v,) for v in "aaabbcd"], "c string")
    assert grid._values(df, "c", 4) == ("a", "b", "c", "d")
    assert grid._values(df, "c", 3) == ("a", "b", grid.OTHER)
