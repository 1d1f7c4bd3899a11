"""Personal data: generators propose spans, boosted trees choose among them, spans are redacted.

Everything that touches a row is a DataFrame expression. Spans are counted in code points,
the end is exclusive.

1. Base patterns (email, ip, card, phone) and looser generators propose spans, which may
   overlap. A base match that passes its check (parts up to 255, Luhn, digit counts) is
   *sure* and always redacted.
2. Each span gets a few features with small domains: kind, digits, separators, the characters
   and words around it. Counting sure and other spans per combination of features over all
   rows gives a table whose size is bounded by the product of the domains.
3. Boosted trees are fitted to the base matches of that table, sure or not. For each kind the
   threshold is the lowest probability of at least ``PRECISION`` above which that share of
   the matches is sure, so a span is added only where format and context say as much as
   a passed check. Spans of the looser generators are scored by the same trees.

Null and empty texts have no spans. Without spans nothing is fitted. Columns made here
replace columns of the same name; all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
ROUNDS = 24
DEPTH = 3
RATE = 0.3

#: The base patterns. Possessive quantifiers and look-behinds only save
#: time; where a match may start inside a run, ``\G`` allows it after the match before.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spans that the base patterns miss: spelt-out addresses, phone numbers without a plus sign, and
#: card numbers that touch other digits across a blank or hyphen.
LOOSE = {
    "card": r"(?<![0-9])[0-9]{13,19}(?![0-9])",
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
#: What a text must contain before a pattern is tried at all.
_NEEDS = {
    ("base", "email"): "@",
    ("base", "ip"): r"[0-9]\.[0-9]",
    ("base", "card"): r"[0-9](?:[\x20-]?[0-9]){11}",
    ("base", "phone"): r"\+[0-9]",
    ("loose", "email"): r"(?:\(at\)|\[at\])",
    ("loose", "phone"): r"[0-9][\x20.-][0-9]{3}",
    ("loose", "card"): "[0-9]{13}",
}
#: Words that announce a kind, in the languages of the corpus.
_CUES = {
    1: r"(?i)(mail|contact|correo|courriel)",
    2: r"(?i)(\bip\b|host|server|addr)",
    3: r"(?i)(card|karte|carte|tarjeta|visa|iban|konto)",
    4: r"(?i)(phone|tel|fon|call|mobil|fax)",
    5: r"(?i)(version|order|token|isbn|\bid\b|nr\.)",
}
FEATURES = ("kind", "digits", "mark", "groups", "left", "right", "cue")
#: Upper bound of distinct feature combinations: the product of the domains.
MAX_COMBINATIONS = 4 * 12 * 6 * 6 * 6 * 6 * 6

CANDIDATES = "_pii_candidates"


def _matches(text: str, pattern: str, needs: str) -> tuple[Column, Column]:
    """All matches and the texts between them; both empty unless ``needs`` is found."""
    value = F.coalesce(F.col(text), F.lit(""))
    there = value.contains(needs) if needs == "@" else value.rlike(needs)
    none = F.array().cast("array<string>")
    found = F.when(there, F.regexp_extract_all(value, F.lit(pattern), F.lit(0))).otherwise(none)
    gaps = F.when(there, F.split(value, pattern, -1)).otherwise(none)
    return found, gaps


def _placed(found: str, gaps: str) -> Column:
    """Matches with their places: the lengths of all matches and gaps before them."""
    n = F.size(found)
    steps = F.arrays_zip(
        F.col(found).alias("match"),
        F.slice(F.col(gaps), F.lit(1), n).alias("before"),
        F.slice(F.col(gaps), F.lit(2), n).alias("after"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,match:string,left:string,right:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["match"])
        item = F.struct(
            start.alias("start"),
            end.alias("end"),
            x["match"].alias("match"),
            F.right(x["before"], F.lit(24)).alias("left"),
            F.left(x["after"], F.lit(1)).alias("right"),
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(item)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.when(n > 0, F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digit sum with every second digit from the right doubled ends in 0."""
    mirrored = F.reverse(digits)
    doubled = F.translate(mirrored, "0123456789", "0246813579")

    def add(total: Column, i: Column) -> Column:
        own = F.when(i % 2 == 0, F.substring(doubled, i, F.lit(1))).otherwise(
            F.substring(mirrored, i, F.lit(1))
        )
        return total + own.cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _sure(kind: str, match: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _character(value: Column) -> Column:
    """0 none, 1 white space, 2 letter, 3 digit, 4 quote or bracket, 5 other."""
    return (
        F.when(value == "", 0)
        .when(value.rlike(r"^\s$"), 1)
        .when(value.rlike(r"^\p{L}$"), 2)
        .when(value.rlike("^[0-9]$"), 3)
        .when(value.rlike(r"^[\"'()\[\]<>=]$"), 4)
        .otherwise(5)
    )


def _described(kind: str, loose: bool, c: Column) -> Column:
    """A span with its features; the checks of the base patterns are not among them."""
    match, left = c["match"], c["left"]
    cue = F.lit(0)
    for number, words in reversed(_CUES.items()):
        cue = F.when(left.rlike(words), number).otherwise(cue)
    mark = (
        F.when(match.rlike(r"\(|\["), 5)
        .when(match.rlike("[0-9A-Za-z]-[0-9]"), 4)
        .when(match.rlike(r"[0-9A-Za-z]\x20"), 3)
        .when(match.rlike(r"[0-9A-Za-z]\.[0-9A-Za-z]"), 2)
        .when(match.rlike("@"), 1)
        .otherwise(0)
    )
    groups = F.size(F.split(match, "[^0-9A-Za-z]+", -1))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        F.least(F.lit(11), F.greatest(F.lit(0), F.length(_digits(match)) - 8)).alias("digits"),
        mark.alias("mark"),
        F.least(F.lit(5), groups).alias("groups"),
        _character(F.right(left, F.lit(1))).alias("left"),
        _character(c["right"]).alias("right"),
        cue.alias("cue"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        _sure(kind, match).alias("passes"),
        F.lit(loose).alias("loose"),
        (F.lit(False) if loose else _sure(kind, match)).alias("sure"),
    )


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the proposed spans as an array of structs."""
    df = df.drop(CANDIDATES)
    generators = [(kind, False, BASE[kind]) for kind in KINDS]
    generators += [(kind, True, pattern) for kind, pattern in LOOSE.items()]
    kept, wide = df.columns, {}
    for i, (kind, loose, pattern) in enumerate(generators):
        found, gaps = _matches(text, pattern, _NEEDS["loose" if loose else "base", kind])
        wide |= {f"_pii_found{i}": found, f"_pii_gaps{i}": gaps}
    df = df.withColumns(wide)
    df = df.withColumns(
        {f"_pii_at{i}": _placed(f"_pii_found{i}", f"_pii_gaps{i}") for i in range(len(generators))}
    )
    described = [
        F.transform(f"_pii_at{i}", partial(_described, kind, loose))
        for i, (kind, loose, _) in enumerate(generators)
    ]
    # A digit run too short for a card or phone is no proposal, nor a loose one that fails.
    def worth(c: Column) -> Column:
        enough = (c["digits"] > 0) | (c["kind"] <= KINDS.index("ip"))
        return c["sure"] | (enough & (~c["loose"] | c["passes"]))

    proposals = F.filter(F.concat(*described), worth)
    return df.select(*kept, proposals.alias(CANDIDATES))


@dataclass(frozen=True)
class Tree:
    """A leaf (``feature`` is None) or a test ``features[feature] <= at``."""

    value: float = 0.0
    feature: int | None = None
    at: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(rows), self.value)
        return np.where(rows[:, self.feature] <= self.at, self.low.predict(rows), self.high.predict(rows))

    def column(self, span: Column) -> Column:
        if self.feature is None:
            return F.lit(float(self.value))
        test = span[FEATURES[self.feature]] <= self.at
        return F.when(test, self.low.column(span)).otherwise(self.high.column(span))


def _grow(rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int) -> Tree:
    """Greedy second-order regression tree with leaf values already scaled by the rate."""

    def gain(g: float, h: float) -> float:
        return g * g / (h + 1.0)

    best, total_g, total_h = (1e-6, 0, 0), gradient.sum(), hessian.sum()
    for feature in range(rows.shape[1]) if depth else ():
        top = int(rows[:, feature].max())
        g = np.cumsum(np.bincount(rows[:, feature], gradient, top + 1))
        h = np.cumsum(np.bincount(rows[:, feature], hessian, top + 1))
        for at in range(top):
            won = gain(g[at], h[at]) + gain(total_g - g[at], total_h - h[at]) - gain(total_g, total_h)
            best = max(best, (won, feature, at))
    won, feature, at = best
    low = rows[:, feature] <= at
    if won <= 1e-6 or low.all() or not low.any():
        return Tree(RATE * total_g / (total_h + 1.0))
    return Tree(
        0.0,
        feature,
        at,
        _grow(rows[low], gradient[low], hessian[low], depth - 1),
        _grow(rows[~low], gradient[~low], hessian[~low], depth - 1),
    )


@dataclass(frozen=True)
class SpanModel:
    """Boosted trees and, per kind, the log-odds from which a span is redacted."""

    start: float = 0.0
    trees: tuple[Tree, ...] = ()
    thresholds: tuple[float, ...] = field(default=(float("inf"),) * len(KINDS))

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return self.start + sum((tree.predict(rows) for tree in self.trees), np.zeros(len(rows)))

    def chosen(self, span: Column) -> Column:
        """Whether a span is redacted: sure, or its log-odds reach the threshold of its kind."""
        if not self.trees or all(np.isinf(self.thresholds)):
            return span["sure"]
        score = F.lit(float(self.start))
        for tree in self.trees:
            score = score + tree.column(span)
        enough = F.lit(False)
        for kind, least in enumerate(self.thresholds):
            if not np.isinf(least):
                enough = enough | ((span["kind"] == kind) & (score >= float(least)))
        return span["sure"] | enough


def fit_table(rows: np.ndarray, counts: np.ndarray, sure: np.ndarray) -> SpanModel:
    """Boosted trees on distinct feature rows with their counts and counts of sure spans."""
    if not len(rows) or sure.sum() in (0, counts.sum()):
        return SpanModel()
    start = float(np.log((sure.sum() + 0.5) / (counts.sum() - sure.sum() + 0.5)))
    odds, trees = np.full(len(rows), start), []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-odds))
        tree = _grow(rows, sure - counts * chance, counts * chance * (1 - chance), DEPTH)
        odds = odds + tree.predict(rows)
        trees.append(tree)
    thresholds, likely = [], np.log(PRECISION / (1 - PRECISION))
    for kind in range(len(KINDS)):
        mine = rows[:, 0] == kind
        order = np.argsort(-odds[mine], kind="stable")
        # Equal scores stand or fall together: judge only at the last of each value.
        values = odds[mine][order]
        share = np.cumsum(sure[mine][order]) / np.maximum(1, np.cumsum(counts[mine][order]))
        last = np.append(values[1:] < values[:-1] - 1e-9, True)[: len(values)]
        fine = np.flatnonzero(last & (share >= PRECISION) & (values >= likely))
        thresholds.append(float(values[fine[-1]] - 1e-9) if len(fine) else float("inf"))
    return SpanModel(start, tuple(trees), tuple(thresholds))


def fit(proposed: DataFrame) -> SpanModel:
    """Fit on the base matches of all rows of ``with_candidates``; the driver gets one row per
    combination of features, at most ``MAX_COMBINATIONS``."""
    spans = proposed.select(F.explode(CANDIDATES).alias("c")).select("c.*").where("not loose")
    counted = spans.groupBy(*FEATURES).agg(
        F.count("*").alias("n"), F.sum(F.col("sure").cast("int")).alias("sure")
    )
    table = sorted(tuple(r) for r in counted.collect())
    data = np.array(table, np.int64).reshape(len(table), len(FEATURES) + 2)
    return fit_table(data[:, :-2], data[:, -2].astype(float), data[:, -1].astype(float))


def _by_place(spans: Column) -> Column:
    """Spans by kind, then start, then end, each once."""
    plain = F.transform(spans, lambda c: F.struct(c["kind"], c["start"], c["end"]))
    return F.array_sort(F.array_distinct(plain))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            _by_place(spans),
            lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"], c["end"]),
        ),
        ",",
    )


def with_spans(proposed: DataFrame, model: SpanModel) -> DataFrame:
    """Replace the proposals by ``pii_sure`` and ``pii_spans`` (arrays of kind, start, end).

    An added span that overlaps a sure one is left out: its text is redacted already.
    """
    chosen = proposed.withColumns(
        {
            "pii_sure": F.filter(CANDIDATES, lambda c: c["sure"]),
            "_pii_more": F.filter(CANDIDATES, lambda c: ~c["sure"] & model.chosen(c)),
        }
    )
    free = F.filter(
        "_pii_more",
        lambda c: ~F.exists("pii_sure", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])),
    )
    chosen = chosen.withColumn("pii_spans", F.concat("pii_sure", free))
    return chosen.drop(CANDIDATES, "_pii_more")


def digests(found: DataFrame) -> DataFrame:
    """Counts of sure spans per kind, the digest of their list, and the list of all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("pii_sure", lambda c: c["kind"] == kind)).cast("long")

    return found.withColumns(
        {f"n_{name}": count(i) for i, name in enumerate(KINDS)}
        | {
            "base_sha256": F.sha2(_listed(F.col("pii_sure")).cast("binary"), 256),
            "spans": _listed(F.col("pii_spans")),
        }
    ).drop("pii_sure", "pii_spans")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans, the one
    that starts first names the whole stretch."""
    ordered = F.array_sort(
        F.transform(spans, lambda c: F.struct(c["start"], (-c["end"]).alias("size"), c["end"], c["kind"]))
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, c: Column) -> Column:
        inside = c["start"] < acc["at"]
        piece = F.concat(
            F.substring(text, acc["at"] + 1, c["start"] - acc["at"]), F.get(names, c["kind"])
        )
        return F.struct(
            F.greatest(acc["at"], c["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(piece))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.length(text))
        return F.concat(F.array_join(acc["out"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, finish)).otherwise(text)
