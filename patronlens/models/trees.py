"""Boosted regression trees and random forests on counted cells.

A tree grows level by level: one histogram per feature over all nodes of a level, from which
every node takes its best cut. Bins are small integers, so a histogram is one count of
``node * bins + bin``. Ties go to the first feature and the lowest bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.session import ship_package

#: Votes of trees are added as integers of this unit, so that their order does not matter.
VOTE_UNIT = 1 << 40


def _histograms(bins: np.ndarray, node: np.ndarray, nodes: int, totals: np.ndarray) -> np.ndarray:
    """Totals of the cells of a node whose bin is not above b: axes total, node, feature, b."""
    width = int(bins.max(initial=0)) + 1
    found = np.empty((len(totals), nodes, bins.shape[1], width))
    base = node * width
    for j in range(bins.shape[1]):
        at = base + bins[:, j]
        for k, total in enumerate(totals):
            found[k, :, j] = np.bincount(at, total, nodes * width).reshape(nodes, width)
    return np.cumsum(found, axis=3)


def _best(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, bin and gain of the best cut of each node."""
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    return at // gain.shape[2], at % gain.shape[2], flat[np.arange(len(flat)), at]


def _moved(bins: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """Nodes of the next level: left child ``2 i``, right child ``2 i + 1``; a node that is not
    split goes on as its left child."""
    right = (bins[np.arange(len(node)), feature[node]] > cut[node]) & splits[node]
    return 2 * node + right


def _packed(node: np.ndarray) -> tuple[np.ndarray, int]:
    """Nodes that hold cells, numbered without gaps."""
    found, packed = np.unique(node, return_inverse=True)
    return packed, len(found)


def grow_regression(bins: np.ndarray, n: np.ndarray, total: np.ndarray, depth: int) -> np.ndarray:
    """Value of each cell in a tree of least squares; ``total`` is the sum of a cell's targets."""
    node, nodes = np.zeros(len(n), np.int64), 1
    for _ in range(depth if bins.shape[1] else 0):
        count, sums = _histograms(bins, node, nodes, np.stack([n, total]))
        all_n, all_s = count[:, :, -1:], sums[:, :, -1:]
        right_n, right_s = all_n - count, all_s - sums
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = sums**2 / count + right_s**2 / right_n - all_s**2 / all_n
        gain = np.where((count > 0) & (right_n > 0), gain, -np.inf)
        feature, cut, won = _best(gain)
        node, nodes = _packed(_moved(bins, node, feature, cut, won > 1e-9))
    count, sums = np.bincount(node, n, nodes), np.bincount(node, total, nodes)
    mean = total.sum() / max(n.sum(), 1e-300)
    return np.where(count > 0, sums / np.maximum(count, 1e-300), mean)[node]


def boosted(bins: np.ndarray, n: np.ndarray, total: np.ndarray, trees: int, rate: float, depth: int) -> np.ndarray:
    """Prediction of each cell: the mean, and ``rate`` of each tree fitted to what is left."""
    found = np.full(len(n), total.sum() / max(n.sum(), 1e-300))
    for _ in range(trees):
        found = found + rate * grow_regression(bins, n, total - n * found, depth)
    return found


def _impurity(negative: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weighted Gini impurity of nodes, by their total weights per class."""
    both = negative + positive
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(both > 0, 2 * negative * positive / both, 0.0)


def grow_classifier(
    bins: np.ndarray, negative: np.ndarray, positive: np.ndarray, depth: int, random: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each cell, and the impurity that each feature takes away. Every node looks at a
    random subset of the features, as many as the square root of their number."""
    features = bins.shape[1]
    chosen = max(1, int(np.sqrt(features))) if features else 0
    gone = np.zeros(features)
    node, nodes = np.zeros(len(bins), np.int64), 1
    chance = np.full(len(bins), positive.sum() / max(1e-300, (negative + positive).sum()))
    for _ in range(depth if features else 0):
        low, high = _histograms(bins, node, nodes, np.stack([negative, positive]))
        all_low, all_high = low[:, :, -1:], high[:, :, -1:]
        before = _impurity(all_low, all_high)
        gain = before - _impurity(low, high) - _impurity(all_low - low, all_high - high)
        sides = (low + high > 0) & (all_low + all_high - low - high > 0)
        order = np.argsort(random.random((nodes, features)), axis=1)
        looked = np.zeros((nodes, features), bool)
        # Constant features do not count among those a node looks at.
        open_ = sides.any(axis=2)
        ranked = np.take_along_axis(open_, order, axis=1)
        first = ranked & (np.cumsum(ranked, axis=1) <= chosen)
        np.put_along_axis(looked, order, first, axis=1)
        gain = np.where(sides & looked[:, :, None], gain, -np.inf)
        feature, cut, won = _best(gain)
        splits = won > 1e-12
        if not splits.any():
            break
        np.add.at(gone, feature[splits], won[splits])
        node, nodes = _packed(_moved(bins, node, feature, cut, splits))
        weight = np.bincount(node, negative + positive, nodes)
        share = np.bincount(node, positive, nodes) / np.maximum(weight, 1e-300)
        # A node without training cells keeps the probability of the one above.
        chance = np.where(weight[node] > 0, share[node], chance)
    return chance, gone / max(gone.sum(), 1e-300)


def forest_votes(
    spark: SparkSession, bins: np.ndarray, negative: np.ndarray, positive: np.ndarray, weights: tuple[float, float],
    trees: int, depth: int, seed: int,
) -> DataFrame:
    """``cell, feature, votes``: the added probabilities of each cell over all trees, and, in rows
    without a cell, the added importance of each feature.

    Trees grow side by side in the tasks of one job. The bootstrap of a tree is a Poisson count
    per cell and class from a generator of its own, so it does not matter which task grows it.
    The cells, at most ``grid.MAX_CELLS``, are sent to every task.
    """
    ship_package(spark)
    shared = spark.sparkContext.broadcast((bins, negative, positive))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, low, high = shared.value
        votes, gone, grown = np.zeros(len(own), np.int64), np.zeros(own.shape[1], np.int64), False
        for batch in batches:
            for tree in batch["id"].tolist():
                random = np.random.Generator(np.random.PCG64([seed, tree]))
                drawn = random.poisson(low) * weights[0], random.poisson(high) * weights[1]
                chance, taken = grow_classifier(own, *drawn, depth, random)
                votes += np.rint(chance * VOTE_UNIT).astype(np.int64)
                gone += np.rint(taken * VOTE_UNIT).astype(np.int64)
                grown = True
        if grown:
            yield pd.DataFrame({"cell": np.arange(len(own), dtype=np.int32), "feature": -1, "votes": votes})
            yield pd.DataFrame({"cell": -1, "feature": np.arange(len(gone), dtype=np.int32), "votes": gone})

    tasks = max(1, min(trees, spark.sparkContext.defaultParallelism))
    numbers = spark.range(0, trees, 1, tasks)
    votes = numbers.mapInPandas(grow, "cell int, feature int, votes long")
    return votes.groupBy("cell", "feature").agg(F.sum("votes").alias("votes"))


def boosted_cells(
    spark: SparkSession, bins: np.ndarray, n: np.ndarray, total: np.ndarray, trees: int, rate: float, depth: int
) -> DataFrame:
    """``cell, prediction`` of boosted trees, grown one after the other in a task; the cells are at most
    ``grid.MAX_CELLS``."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast((bins, n, total))

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            found = boosted(*shared.value, trees, rate, depth)
            yield pd.DataFrame({"cell": np.arange(len(found), dtype=np.int32), "prediction": found})

    return spark.range(0, 1, 1, 1).mapInPandas(grow, "cell int, prediction double")
