"""Quality grades by ordinal cumulative-link regression on hashed text.

Every word of a text gives a few hashed features (the word itself, its shape, its ending,
whether it repeats the word before). A document's score is the mean weight of all its
words; all grades share the weights, and ordered thresholds turn the score into
``P(grade >= k) = logistic(score - threshold_k)``. From these come the expected grade
and the tail probability by which documents are selected.

The fit uses a bounded sample (``SAMPLE_ROWS`` per grade of at most ``SAMPLE_BYTES`` each);
scoring reads every text whole. A null or empty text has the score 0. Without any label
nothing can be learned: grades are null and every document is kept; with one
grade only, all get it. Columns made here replace columns of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.sampling import labelled_sample
from patronlens.llm.textbytes import SPACE, SliceHashes, TextBatch, lower_latin, pieces, text_batch

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 20_000
BITS = 16
KEEP_PROBABILITY = 0.5
_STEPS = 300
_PENALTY = 1e-4

#: Byte classes for word shapes: letters, capitals, digits; other ASCII bytes are themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(97, 123), *range(128, 256)]] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers: a multiplicative hash that differs for each kind of feature."""
    odd = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * kind & (1 << 64) - 1 | 1)
    mixed = hashes ^ (hashes >> np.uint64(29))
    return ((mixed * odd) >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(batch: TextBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """First word of each text (with an end mark), and one array of feature numbers for all
    words per kind of feature."""
    tokens = batch.tokens(~SPACE)
    starts, ends = tokens.starts, tokens.ends
    words = SliceHashes(lower_latin(batch.data)).of(starts, ends)
    shape = SliceHashes(_SHAPE[batch.data])
    length = np.minimum(ends - starts, 24).astype(np.uint64)
    repeats = np.zeros(len(starts), np.uint64)
    repeats[1:] = words[1:] == words[:-1]
    begins = tokens.first[:-1]
    repeats[begins[begins < len(starts)]] = 0
    head = shape.of(starts, np.minimum(starts + 2, ends))
    tail = shape.of(np.maximum(ends - 3, starts), ends)
    both = head * np.uint64(3) + tail
    kinds = [words, tail, head + length, both, repeats * np.uint64(5) + np.uint64(1)]
    return tokens.first, [_buckets(k, i) for i, k in enumerate(kinds)]


def mean_scores(batch: TextBatch, weights: np.ndarray) -> np.ndarray:
    """Mean weight of the words of each text, 0 for a text without words."""
    first, kinds = word_features(batch)
    total = np.zeros(len(kinds[0]) + 1)
    np.cumsum(sum(weights[k] for k in kinds), out=total[1:])
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)


def sparse_rows(batch: TextBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and shares (count by number of words) of each text."""
    first, kinds = word_features(batch)
    rows = []
    for low, high in zip(first, first[1:], strict=False):
        found, counts = np.unique(np.concatenate([k[low:high] for k in kinds]), return_counts=True)
        rows.append((found, counts / max(1, high - low)))
    return rows


@dataclass(frozen=True)
class OrdinalModel:
    """``grades`` in rising order, thresholds between them, and the shared weights."""

    grades: tuple[float, ...] = ()
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= grades[k])`` for k from 1, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(scores) @ np.diff(self.grades)


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: list[float], row_weights: np.ndarray | None = None
) -> OrdinalModel:
    """Penalised maximum likelihood by Adam on all rows; thresholds stay ordered because
    only the logarithms of their distances are free."""
    levels = tuple(sorted(set(grades)))
    if len(levels) < 2:
        return OrdinalModel(levels)
    level = np.searchsorted(levels, grades)
    index = np.concatenate([i for i, _ in rows])
    share = np.concatenate([s for _, s in rows])
    owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    used, index = np.unique(index, return_inverse=True)
    per_row = np.ones(len(rows)) if row_weights is None else row_weights
    per_row = per_row / per_row.sum()
    cuts = len(levels) - 1
    value = np.concatenate([np.zeros(len(used)), [0.0], np.zeros(cuts - 1)])
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, _STEPS + 1):
        weights, gaps = value[: len(used)], np.exp(value[len(used) + 1 :])
        theta = value[len(used)] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, share * weights[index], len(rows))
        # Upper and lower tail of each row's own grade; their difference is its likelihood.
        bounds = np.concatenate([[-np.inf], theta, [np.inf]])
        upper = 1 / (1 + np.exp(np.clip(bounds[level] - score, -60, 60)))
        lower = 1 / (1 + np.exp(np.clip(bounds[level + 1] - score, -60, 60)))
        chance = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = -per_row * (slope_up - slope_low)
        by_theta = np.zeros(cuts + 2)
        np.add.at(by_theta, level, per_row * slope_up)
        np.add.at(by_theta, level + 1, -per_row * slope_low)
        by_theta = by_theta[1:-1]
        gradient = np.concatenate(
            [
                np.bincount(index, share * by_score[owner], len(used)) + _PENALTY * weights,
                [by_theta.sum()],
                np.cumsum(by_theta[::-1])[::-1][1:] * gaps,
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.1 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        value = value - rate * mean / (np.sqrt(square) + 1e-9)
    full = np.zeros(1 << BITS)
    full[used] = value[: len(used)]
    theta = value[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(value[len(used) + 1 :]))])
    return OrdinalModel(tuple(float(x) for x in levels), theta, full)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> OrdinalModel:
    """Fit on a bounded sample of labelled rows; executors make the features, the driver
    gets at most ``sample_rows`` sparse rows per grade. In the fit a grade weighs as much as
    its labels are frequent, so the balanced sample does not shift the probabilities."""
    counted = labels.where(F.col(grade).isNotNull()).groupBy(F.col(grade).cast("double")).count()
    frequency = dict(map(tuple, counted.collect()))
    sample = labelled_sample(docs, labels, grade, sample_rows, sample_bytes, doc_id, text)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = sparse_rows(text_batch(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.string()),
                        part.column("label").cast(pa.float64()),
                        pa.array([i for i, _ in rows], pa.list_(pa.int32())),
                        pa.array([s for _, s in rows], pa.list_(pa.float32())),
                    ],
                    names=["doc_id", "label", "i", "s"],
                )

    found = sample.mapInArrow(features, "doc_id string, label double, i array<int>, s array<float>")
    table = found.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    rows = [
        (i.values.to_numpy().astype(np.int64), s.values.to_numpy().astype(float))
        for i, s in zip(table.column("i"), table.column("s"), strict=True)
    ]
    grades = table.column("label").to_pylist()
    taken = Counter(grades)
    return fit_ordinal(rows, grades, np.array([frequency[g] / taken[g] for g in grades]))


def score(
    df: DataFrame,
    model: OrdinalModel,
    keep_from: float | None = None,
    text: str = "text",
    probability: float = KEEP_PROBABILITY,
    keep_text: bool = False,
) -> DataFrame:
    """Replace the text (unless ``keep_text``) by ``expected_grade``, ``tail_probability`` (of
    ``keep_from`` or better, by default the best grade) and ``keep`` (the tail probability
    reaches ``probability``)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    made = ("expected_grade", "tail_probability", "keep")
    gone = {*made} if keep_text else {*made, text.lower()}
    out = df.drop(*[c for c in df.columns if c.lower() in gone])
    least = model.grades[-1] if model.grades and keep_from is None else keep_from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in pieces(batch, text):
                kept = [i for i, name in enumerate(part.schema.names) if name.lower() not in gone]
                texts = text_batch(part.column(part.schema.names.index(text)))
                grades, tails = _scored(fitted, texts, least)
                columns = [pa.array(grades, pa.float64()), pa.array(tails, pa.float64())]
                keep = tails >= probability
                if not fitted.grades:
                    columns = [pa.nulls(part.num_rows, pa.float64())] * 2
                    keep = np.ones(part.num_rows, bool)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), *columns, pa.array(keep, pa.bool_())],
                    names=[*(part.schema.names[i] for i in kept), *made],
                )

    fields = [
        T.StructField("expected_grade", T.DoubleType()),
        T.StructField("tail_probability", T.DoubleType()),
        T.StructField("keep", T.BooleanType()),
    ]
    return df.mapInArrow(run, T.StructType([*out.schema.fields, *fields]))


def _scored(model: OrdinalModel, batch: TextBatch, least: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and tail probability; the tail of the lowest grade is 1."""
    if len(model.grades) < 2:
        level = model.grades[0] if model.grades else np.nan
        tail = float(not model.grades or level >= least)
        return np.full(len(batch), level), np.full(len(batch), tail)
    scores = mean_scores(batch, model.weights)
    at = int(np.searchsorted(model.grades, least))
    tails = model.tails(scores)
    if at == 0:
        return model.expected(scores), np.ones(len(batch))
    if at > tails.shape[1]:
        return model.expected(scores), np.zeros(len(batch))
    return model.expected(scores), tails[:, at - 1]
