"""Customer segments: k-means over recency, frequency and monetary scores.

Scores are quintiles, so any population reduces to a grid of at most 216 weighted
points with one aggregate. K-means, the choice of k and the exact silhouette work
on that grid; labels are joined back on the three scores. Customers without an
order in 365 days are "Inactive" and take no part.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions.dates import as_run_date
from patronlens.functions.numbers import number_or, require_columns

log = logging.getLogger(__name__)

RFM = ("recency_score", "frequency_score", "monetary_score")
ACTIVITY = "order_frequency_365d"
MAX_SCORE = 5
GRID_POINTS = (MAX_SCORE + 1) ** len(RFM)

# The model's settings and labels, best to worst.
ALGORITHM = "kmeans"
K_RANGE = (4, 5, 6, 7, 8)
DEFAULT_K = 4
TIE_THRESHOLD = 0.01
SEED = 42
RESTARTS = 10
INACTIVE = "Inactive"
LABELS = {
    4: ["Champions", "Loyal", "At-Risk", "Dormant"],
    5: ["Champions", "Loyal", "Potential Loyalist", "At-Risk", "Dormant"],
    6: ["Champions", "Loyal", "Potential Loyalist", "Needs Attention", "At-Risk", "Dormant"],
    7: [
        "Champions",
        "Loyal",
        "Potential Loyalist",
        "Needs Attention",
        "At-Risk",
        "Hibernating",
        "Dormant",
    ],
    8: [
        "Champions",
        "Loyal",
        "Potential Loyalist",
        "Promising",
        "Needs Attention",
        "At-Risk",
        "Hibernating",
        "Dormant",
    ],
}

MAX_STEPS = 100


@dataclass(frozen=True)
class Clustering:
    """One k-means result on the grid."""

    cost: float
    centers: np.ndarray
    clusters: np.ndarray


@dataclass(frozen=True)
class Segmentation:
    scores: DataFrame  # customer_id, segment_label
    params: dict[str, object] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)


def is_active() -> Column:
    return number_or(F.col(ACTIVITY), 0) > 0


def score_value(column: str) -> Column:
    """A quintile score as an integer; an unreadable one counts as 0."""
    return number_or(F.col(column), 0).cast("int")


def rfm_grid(features: DataFrame) -> DataFrame:
    """Active customers per combination of scores."""
    return (
        features.where(is_active())
        .groupBy(*[score_value(c).alias(c) for c in RFM])
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def grid_statistics(grid: DataFrame) -> DataFrame:
    """One row: population mean and standard deviation of each score, by customer."""
    n = F.sum("customers").cast("double")
    stats = []
    for c in RFM:
        total = F.sum(F.col(c) * F.col("customers")).cast("double")
        squares = F.sum(F.col(c) * F.col(c) * F.col("customers")).cast("double")
        stats.append((total / n).alias(f"{c}_mean"))
        stats.append((F.sqrt(n * squares - total * total) / n).alias(f"{c}_std"))
    return grid.agg(*stats)


def silhouette(points: np.ndarray, weights: np.ndarray, clusters: np.ndarray) -> float:
    """Exact mean Euclidean silhouette of a weighted point set; customers on the same
    point are at distance 0."""
    distance = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    names = np.unique(clusters)
    member = (clusters[:, None] == names[None, :]).astype(float)
    totals = distance @ (member * weights[:, None])
    sizes = (member * weights[:, None]).sum(axis=0)
    own = member.astype(bool)
    own_size = sizes[np.argmax(own, axis=1)]
    inside = totals[own] / np.maximum(own_size - 1, 1)
    outside = np.where(own, np.inf, totals / sizes).min(axis=1)
    larger = np.maximum(inside, outside)
    width = np.where(larger > 0, (outside - inside) / np.where(larger > 0, larger, 1), 0.0)
    width = np.where(own_size > 1, width, 0.0)
    return float((width * weights).sum() / weights.sum())


def choose_k(silhouettes: dict[int, float]) -> int:
    """Highest silhouette; when all lie within the threshold, the default k, or the
    smallest scored one."""
    if max(silhouettes.values()) - min(silhouettes.values()) <= TIE_THRESHOLD:
        chosen = DEFAULT_K if DEFAULT_K in silhouettes else min(silhouettes)
        log.warning("silhouettes %s are tied; using k=%d", silhouettes, chosen)
        return chosen
    return max(silhouettes, key=lambda k: (silhouettes[k], -k))


def rank_labels(centers: np.ndarray, k: int) -> dict[int, str]:
    """Cluster -> label, by descending sum of the center's scores; ties by cluster id."""
    order = sorted(range(len(centers)), key=lambda c: (-centers[c].sum(), c))
    return {cluster: LABELS[k][rank] for rank, cluster in enumerate(order)}


def weighted_kmeans(
    points: np.ndarray, weights: np.ndarray, k: int, seed: list[int]
) -> tuple[float, np.ndarray, np.ndarray]:
    """Cost, centers and cluster of each point: weighted k-means++ and Lloyd steps."""
    rng = np.random.default_rng(seed)
    centers = points[[rng.choice(len(points), p=weights / weights.sum())]]
    for _ in range(k - 1):
        away = weights * ((points[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1)
        chance = away / away.sum() if away.sum() > 0 else weights / weights.sum()
        centers = np.vstack([centers, points[rng.choice(len(points), p=chance)]])
    for _ in range(MAX_STEPS):
        square = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        clusters = square.argmin(axis=1)
        mass = np.bincount(clusters, weights, k)
        sums = np.stack([np.bincount(clusters, weights * x, k) for x in points.T], axis=1)
        moved = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centers)
        if np.allclose(moved, centers, atol=1e-9):
            break
        centers = moved
    square = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
    return float((weights * square.min(axis=1)).sum()), centers, square.argmin(axis=1)


def _fit_all(
    spark: SparkSession, points: np.ndarray, weights: np.ndarray, ks: list[int], restarts: int
) -> dict[int, Clustering]:
    """The fit with the lowest cost per k. All fits run as rows of one job; each task gets the
    grid, at most ``GRID_POINTS`` points."""
    if not ks:
        return {}
    pairs = [(k, n) for k in ks for n in range(restarts)]
    fits = spark.createDataFrame(pairs, "k int, restart int").repartition(len(pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, restart in zip(batch["k"].tolist(), batch["restart"].tolist(), strict=True):
                cost, centers, clusters = weighted_kmeans(points, weights, k, [SEED, k, restart])
                found = (k, restart, cost, centers.tolist(), clusters.tolist())
                yield pd.DataFrame([found], columns=["k", "restart", "cost", "centers", "clusters"])

    schema = "k int, restart int, cost double, centers array<array<double>>, clusters array<int>"
    done = fits.mapInPandas(run, schema).collect()
    best: dict[int, Clustering] = {}
    for row in sorted(done, key=lambda r: (r.k, r.cost, r.restart)):
        found = Clustering(row.cost, np.array(row.centers), np.array(row.clusters))
        best.setdefault(row.k, found)
    return best


def train_and_score(
    features: DataFrame, run_date: str | date | datetime, restarts: int = RESTARTS
) -> Segmentation:
    """One ``segment_label`` per customer of ``features`` (read twice: pass a written
    table)."""
    require_columns(features, {"customer_id", ACTIVITY, *RFM})
    day = as_run_date(run_date)
    spark = features.sparkSession
    rows = rfm_grid(features).limit(GRID_POINTS + 1).collect()
    if any(not 0 <= row[c] <= MAX_SCORE for row in rows for c in RFM):
        raise ValueError(f"scores must lie between 0 and {MAX_SCORE}")
    if not rows:
        log.warning("no active customers on %s", day)
        return Segmentation(features.select("customer_id", F.lit(INACTIVE).alias("segment_label")))

    rows = sorted(rows)
    raw = np.array([[row[c] for c in RFM] for row in rows], dtype=float)
    weights = np.array([row.customers for row in rows], dtype=float)
    active = int(weights.sum())
    mean = np.average(raw, axis=0, weights=weights)
    std = np.sqrt(np.average((raw - mean) ** 2, axis=0, weights=weights))
    scale = np.where(std > 0, std, 1.0)
    points = (raw - mean) / scale

    ks = [k for k in K_RANGE if k < active and len(rows) >= 2]
    clusterings, silhouettes = {}, {}
    for k, found in _fit_all(spark, points, weights, ks, restarts).items():
        if len(np.unique(found.clusters)) >= 2:
            clusterings[k] = found
            silhouettes[k] = silhouette(points, weights, found.clusters)
    if not silhouettes:
        raise ValueError(f"{active} active customers do not form two clusters for any k")

    k = choose_k(silhouettes)
    cost, clusters = clusterings[k].cost, clusterings[k].clusters
    centers = clusterings[k].centers * scale + mean
    names = rank_labels(centers, k)
    labelled = spark.createDataFrame(
        [(*(int(row[c]) for c in RFM), names[int(c)]) for row, c in zip(rows, clusters)],
        "r int, f int, m int, label string",
    )
    keys = [score_value(c) == F.col(short) for c, short in zip(RFM, "rfm")]
    scores = features.join(F.broadcast(labelled), keys, "left").select(
        "customer_id",
        F.when(is_active(), F.col("label")).otherwise(INACTIVE).alias("segment_label"),
    )
    return Segmentation(
        scores,
        {"algorithm": ALGORITHM, "k": k, "random_state": SEED, "run_date": day.isoformat()},
        {"silhouette_score": silhouettes[k], "inertia": float(cost)},
    )
