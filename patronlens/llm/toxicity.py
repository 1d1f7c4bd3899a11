"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Labels are known per document only, so tokens are labelled first: in toxic documents of the
sample, a token is toxic if one of its features (word, beginnings, endings) is far more
frequent in toxic than in clean documents. A two-state chain is then fitted to these token
labels by maximum likelihood. Forward-backward marginals give each token's probability;
their sum, maximum and share are calibrated to the probability of the document's label.

The recursions of all texts of a batch run as one chain with restarts: its steps are two by
two matrices, multiplied chunk by chunk, so numpy works on thousands of chunks at once.

The fit uses a bounded sample (``SAMPLE_ROWS`` per label of at most ``SAMPLE_BYTES``); every
text is scored whole. A null or empty text has no tokens and gets the calibrated score of
nothing toxic. If the labels hold one class only, or none, every score is the share of toxic
labels (0 without labels) and no span is reported. Columns made here replace columns
of the same name; input order and repeated rows do not matter.
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
from patronlens.llm.textbytes import (
    SliceHashes,
    TextBatch,
    Tokens,
    code_points,
    lower_latin,
    mix,
    pieces,
    text_batch,
)

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 12_000
BITS = 18
SPAN_PROBABILITY = 0.5
_STEPS = 40
_CHUNK = 512
_SKETCH = 64
SHINGLE_WORDS = 5
COPY_SIMILARITY = 0.8
_MIN_TOXIC, _MIN_TOXIC_SHARE, _MIN_RATIO = 5, 0.02, 15.0
_PREFIXES, _SUFFIXES = (3, 4, 5, 6, 7, 8), (3, 4)
KINDS = 1 + len(_PREFIXES) + len(_SUFFIXES)

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def token_features(batch: TextBatch) -> tuple[Tokens, np.ndarray]:
    """Tokens (runs of letters and digits) and one row of feature numbers for each kind."""
    tokens = batch.tokens(_WORD)
    starts, ends = tokens.starts, tokens.ends
    hashes = SliceHashes(lower_latin(batch.data))
    parts = [(starts, ends)]
    parts += [(starts, np.minimum(starts + n, ends)) for n in _PREFIXES]
    parts += [(np.maximum(ends - n, starts), ends) for n in _SUFFIXES]
    rows = np.empty((KINDS, len(tokens)), np.int32)
    for kind, (low, high) in enumerate(parts):
        odd = np.uint64((0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * kind) & (1 << 64) - 1 | 1)
        found = hashes.of(low, high)
        rows[kind] = ((found ^ (found >> np.uint64(31))) * odd) >> np.uint64(64 - BITS)
    return tokens, rows


@dataclass(frozen=True)
class Chain:
    """Score of the toxic state per feature, of the moves 0-1, 1-0, 1-1, and of starting in it."""

    weights: np.ndarray
    moves: np.ndarray
    start: float

    def matrix(self) -> np.ndarray:
        return np.exp(np.array([[0.0, self.moves[0]], [self.moves[1], self.moves[2]]]))


def _scan(steps: np.ndarray) -> np.ndarray:
    """``steps[t] @ ... @ steps[0] @ (1, 0)`` for every t, each scaled to sum 1.

    ``steps`` has shape (n, 2, 2). Chunks are multiplied side by side, joined in order, then
    swept again from their true beginnings: exact, with n / chunk sequential steps.
    """
    n = len(steps)
    width = max(1, min(_CHUNK, int(np.sqrt(n)) + 1))
    chunks = -(-n // width)
    padded = np.empty((chunks * width, 2, 2))
    padded[:n] = steps
    padded[n:] = np.eye(2)
    grid = np.ascontiguousarray(padded.reshape(chunks, width, 2, 2).transpose(1, 2, 3, 0))
    a, b = np.ones(chunks), np.zeros(chunks)
    c, d = np.zeros(chunks), np.ones(chunks)
    for m in grid:
        a, b, c, d = (
            m[0, 0] * a + m[0, 1] * c,
            m[0, 0] * b + m[0, 1] * d,
            m[1, 0] * a + m[1, 1] * c,
            m[1, 0] * b + m[1, 1] * d,
        )
        size = a + b + c + d
        a, b, c, d = a / size, b / size, c / size, d / size
    x, y = np.empty(chunks), np.empty(chunks)
    now = (1.0, 0.0)
    for i, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        x[i], y[i] = now
        first, second = p * now[0] + q * now[1], r * now[0] + s * now[1]
        now = (first / (first + second), second / (first + second))
    out = np.empty((width, 2, chunks))
    for t, m in enumerate(grid):
        x, y = m[0, 0] * x + m[0, 1] * y, m[1, 0] * x + m[1, 1] * y
        size = x + y
        x, y = x / size, y / size
        out[t, 0], out[t, 1] = x, y
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def forward_backward(
    emission: np.ndarray, first: np.ndarray, chain: Chain
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward vectors (scaled to sum 1) of all tokens, and which begin a text."""
    n = len(emission)
    begins = np.zeros(n, bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    move, weight = chain.matrix(), np.exp(np.clip(emission, -30, 30))
    steps = np.empty((n, 2, 2))
    steps[:, 0, 0], steps[:, 0, 1] = move[0, 0], move[1, 0]
    steps[:, 1, 0], steps[:, 1, 1] = move[0, 1] * weight, move[1, 1] * weight
    steps[begins, 0] = 1.0
    steps[begins, 1] = (weight[begins] * np.exp(chain.start))[:, None]
    forward = _scan(steps)
    ends = np.zeros(n, bool)
    ends[:-1], ends[-1:] = begins[1:], True
    following = np.ones(n)
    following[:-1] = weight[1:]
    steps[:, 0, 0], steps[:, 0, 1] = move[0, 0], move[0, 1] * following
    steps[:, 1, 0], steps[:, 1, 1] = move[1, 0], move[1, 1] * following
    steps[ends] = 1.0
    backward = _scan(steps[::-1])[::-1]
    return forward, backward, begins


def marginals(emission: np.ndarray, first: np.ndarray, chain: Chain) -> np.ndarray:
    """Probability of the toxic state for each token."""
    if not len(emission):
        return np.zeros(0)
    forward, backward, _ = forward_backward(emission, first, chain)
    joint = forward * backward
    return joint[:, 1] / joint.sum(axis=1)


def fit_chain(features: np.ndarray, first: np.ndarray, tags: np.ndarray) -> Chain:
    """Penalised maximum likelihood of the token tags by Adam.

    Features are looked up once per distinct token: ``features`` has one row per kind.
    """
    odd = (2 * np.arange(KINDS) + 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = mix((features.astype(np.uint64) * odd[:, None]).sum(axis=0, dtype=np.uint64))
    _, some, word = np.unique(key, return_index=True, return_inverse=True)
    index = features[:, some]
    begins = np.zeros(len(tags), bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    inner = ~begins[1:]
    seen = np.array(
        [((tags[:-1] == i) & (tags[1:] == j) & inner).sum() for i, j in ((0, 1), (1, 0), (1, 1))], float
    )
    started = float(tags[begins].sum())
    value = np.zeros((1 << BITS) + 4)
    value[-4:] = (-4.0, 0.0, -3.0, -4.0)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, _STEPS + 1):
        chain = Chain(value[:-4], value[-4:-1], float(value[-1]))
        emission = chain.weights[index].sum(axis=0)[word]
        forward, backward, _ = forward_backward(emission, first, chain)
        joint = forward * backward
        inside = joint[:, 1] / joint.sum(axis=1)
        move, weight = chain.matrix(), np.exp(np.clip(emission, -30, 30))
        after = np.stack([backward[1:, 0], weight[1:] * backward[1:, 1]], axis=1)
        pair = forward[:-1, :, None] * move * after[:, None, :]
        pair = (pair / pair.sum(axis=(1, 2), keepdims=True))[inner].sum(axis=0)
        by_word = np.bincount(word, inside - tags, len(some))
        gradient = np.empty_like(value)
        gradient[:-4] = 0.02 * value[:-4]
        for row in index:
            gradient[:-4] += np.bincount(row, by_word, 1 << BITS)
        gradient[-4:-1] = np.array([pair[0, 1], pair[1, 0], pair[1, 1]]) - seen
        gradient[-1] = inside[begins].sum() - started
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.15 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        value = value - rate * mean / (np.sqrt(square) + 1e-6)
    return Chain(value[:-4].astype(np.float32), value[-4:-1], float(value[-1]))


def tag_tokens(features: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents with a feature that marks such documents."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = np.array([max(1, (toxic == 0).sum()), max(1, (toxic == 1).sum())], float)
    tagged = np.zeros(len(owner), bool)
    for row in features:
        once = np.unique(row.astype(np.int64) << 32 | owner)
        number, doc = once >> 32, once & 0xFFFFFFFF
        clean, bad = (np.bincount(number[toxic[doc] == k], minlength=1 << BITS) for k in (0, 1))
        ratio = (bad / n[1]) / ((clean + 0.5) / n[0])
        often = bad >= max(_MIN_TOXIC, _MIN_TOXIC_SHARE * n[1])
        tagged |= (often & (ratio >= _MIN_RATIO))[row]
    return tagged & (toxic[owner] == 1)


def summaries(inside: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: a constant, log(1 + expected toxic tokens), largest marginal, their share."""
    total = np.zeros(len(inside) + 1)
    np.cumsum(inside, out=total[1:])
    expected = total[first[1:]] - total[first[:-1]]
    most = np.zeros(len(expected))
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        most[some] = np.maximum.reduceat(inside, first[some])
    share = expected / np.maximum(1, np.diff(first))
    return np.stack([np.ones(len(expected)), np.log1p(expected), most, np.sqrt(share)], axis=1)


def calibrate(rows: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps."""
    value = np.zeros(rows.shape[1])
    penalty = np.diag([0.01, 0.3, 0.3, 0.3])
    for _ in range(40):
        chance = 1 / (1 + np.exp(-np.clip(rows @ value, -30, 30)))
        gradient = rows.T @ (weights * (chance - toxic)) + penalty @ value
        hessian = (rows * (weights * np.maximum(chance * (1 - chance), 1e-6))[:, None]).T @ rows + penalty
        move = np.linalg.solve(hessian, gradient)
        value = value - move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
    return value


@dataclass(frozen=True)
class ToxicityModel:
    chain: Chain | None = None
    calibration: np.ndarray = field(default_factory=lambda: np.zeros(4))
    prior: float = 0.0

    def tokens(self, batch: TextBatch) -> tuple[Tokens, np.ndarray]:
        """Tokens and their probability of being toxic."""
        tokens, features = token_features(batch)
        emission = np.zeros(len(tokens))
        for row in features:
            emission += self.chain.weights[row]
        return tokens, marginals(emission, tokens.first, self.chain)

    def scores(self, inside: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries(inside, first) @ self.calibration, -30, 30)))


def _shingles(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of each ``SHINGLE_WORDS`` words, or of all words of a shorter text."""
    length = min(SHINGLE_WORDS, len(words))
    starts = np.arange(len(words) - length + 1 if length else 0)
    return np.unique(mix(SliceHashes(words).of(starts, starts + length)))


def without_copies(features: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which sample rows to learn from: of near copies with the same label only the first.

    A text copied often would make all its words look typical of its label. Two texts are copies
    if ``COPY_SIMILARITY`` of their shingles agree. Rows that share half of their ``_SKETCH``
    smallest shingles are looked at, and compared by all of them; the sample is bounded.
    """
    seen: dict[tuple[int, int], list[int]] = {}
    kept: dict[int, np.ndarray] = {}
    words = mix(features[0].astype(np.uint64))
    for row, (low, high) in enumerate(zip(first, first[1:], strict=False)):
        own, label = _shingles(words[low:high]), int(toxic[row])
        sketch = own[:_SKETCH].tolist()
        shared = Counter(r for s in sketch for r in seen.get((label, s), ()))
        near = (kept[r] for r, n in shared.most_common() if 2 * n >= len(sketch))
        if any(_similarity(own, other) >= COPY_SIMILARITY for other in near):
            continue
        kept[row] = own
        for s in sketch:
            seen.setdefault((label, s), []).append(row)
    keep = np.zeros(len(toxic), bool)
    keep[list(kept)] = True
    return keep


def _similarity(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct values."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / max(1, len(one) + len(other) - both)


def fit_model(texts: pa.Array, toxic: np.ndarray, prior: float | None = None) -> ToxicityModel:
    """Fit tagger and calibration; ``prior`` is the share of toxic labels outside the sample."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    prior = share if prior is None else prior
    if share in (0.0, 1.0):
        return ToxicityModel(prior=prior)
    tokens, features = token_features(text_batch(texts))
    keep = without_copies(features, tokens.first, toxic)
    texts, toxic = texts.filter(pa.array(keep)), toxic[keep]
    share = float(toxic.mean())
    # Every third row calibrates; the tagger has not seen it.
    held = np.arange(len(toxic)) % 3 == 2
    for part in (held, ~held):
        if len(set(toxic[part].tolist())) < 2:
            held = np.zeros(len(toxic), bool)
    learn = ~held
    tokens, features = token_features(text_batch(texts.filter(pa.array(learn))))
    if not len(tokens):
        return ToxicityModel(prior=prior)
    tags = tag_tokens(features, tokens.first, toxic[learn]).astype(np.int64)
    chain = fit_chain(features, tokens.first, tags)
    part = held if held.any() else learn
    tokens, features = token_features(text_batch(texts.filter(pa.array(part))))
    emission = chain.weights[features].sum(axis=0, dtype=float)
    rows = summaries(marginals(emission, tokens.first, chain), tokens.first)
    weights = np.where(toxic[part] == 1, prior / share, (1 - prior) / (1 - share))
    return ToxicityModel(chain, calibrate(rows, toxic[part], weights), prior)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> ToxicityModel:
    """Fit on a bounded sample of the rows of ``labels`` (0 or 1); other labels are left out."""
    known = labels.where(F.col(label).isin(0, 1))
    counts = dict(map(tuple, known.groupBy(F.col(label).cast("int")).count().collect()))
    sample = labelled_sample(docs, known, label, sample_rows, sample_bytes, doc_id, text).toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    toxic = sample.column("label").to_numpy().astype(np.int64)
    return fit_model(sample.column("text").combine_chunks(), toxic, prior)


def _span_texts(batch: TextBatch, tokens: Tokens, inside: np.ndarray) -> list[str]:
    """``start:end`` in code points of neighbouring toxic tokens joined to one span."""
    hot = np.flatnonzero(inside >= SPAN_PROBABILITY)
    out = [""] * len(batch)
    if not len(hot):
        return out
    owner = np.searchsorted(tokens.first, hot, side="right") - 1
    breaks = np.flatnonzero((np.diff(hot) != 1) | (np.diff(owner) != 0)) + 1
    lows, highs = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(hot)]]) - 1
    points = code_points(batch.data)
    base = points[batch.offsets[owner[lows]]]
    starts = points[tokens.starts[hot[lows]]] - base
    ends = points[tokens.ends[hot[highs]]] - base
    found: dict[int, list[str]] = {}
    for doc, a, b in zip(owner[lows].tolist(), starts.tolist(), ends.tolist(), strict=True):
        found.setdefault(doc, []).append(f"{a}:{b}")
    for doc, spans in found.items():
        out[doc] = ",".join(spans)
    return out


def score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Replace the text by ``score``, ``predicted`` (score of 0.5 or more) and ``toxic_spans``
    (code point offsets, end exclusive)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    made = ("score", "predicted", "toxic_spans")
    gone = {*made, text.lower()}
    out = df.drop(*[c for c in df.columns if c.lower() in gone])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in pieces(batch, text):
                names = part.schema.names
                kept = [i for i, name in enumerate(names) if name.lower() not in gone]
                texts = text_batch(part.column(names.index(text)))
                if fitted.chain is None:
                    scores, spans = np.full(len(texts), fitted.prior), [""] * len(texts)
                else:
                    tokens, inside = fitted.tokens(texts)
                    scores, spans = fitted.scores(inside, tokens.first), _span_texts(texts, tokens, inside)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in kept),
                        pa.array(scores, pa.float64()),
                        pa.array((scores >= 0.5).astype(np.int32)),
                        pa.array(spans, pa.string()),
                    ],
                    names=[*(names[i] for i in kept), *made],
                )

    fields = [
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
        T.StructField("toxic_spans", T.StringType()),
    ]
    return df.mapInArrow(run, T.StructType([*out.schema.fields, *fields]))
