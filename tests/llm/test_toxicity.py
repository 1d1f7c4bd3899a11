import zlib

import numpy as np
import pyarrow as pa
import pytest

from patronlens.llm import queries, toxicity
from patronlens.llm.textbytes import text_batch

SF = "/root/testdata/sf0.1"


def plain_marginals(emission, first, chain):
    """Sum over all state sequences of each text."""
    out = []
    move = np.exp([[0.0, chain.moves[0]], [chain.moves[1], chain.moves[2]]])
    for low, high in zip(first, first[1:]):
        n = high - low
        weight, toxic = 0.0, np.zeros(n)
        for code in range(1 << n) if n else ():
            tags = [code >> i & 1 for i in range(n)]
            p = np.exp(chain.start * tags[0] + sum(e * t for e, t in zip(emission[low:high], tags)))
            for a, b in zip(tags, tags[1:]):
                p *= move[a][b]
            weight += p
            toxic += p * np.array(tags)
        out += list(toxic / weight) if n else []
    return np.array(out)


@pytest.mark.parametrize("seed", range(6))
def test_forward_backward(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(toxicity, "_CHUNK", int(rng.integers(1, 9)))
    first = np.concatenate([[0], np.cumsum(rng.integers(0, 8, 9))])
    emission = rng.normal(0, 3, first[-1])
    chain = toxicity.Chain(np.zeros(1), rng.normal(0, 2, 3), float(rng.normal()))
    assert np.allclose(toxicity.marginals(emission, first, chain), plain_marginals(emission, first, chain))


def test_extreme_scores_stay_finite():
    chain = toxicity.Chain(np.zeros(1), np.array([-20.0, 3.0, 5.0]), -25.0)
    emission = np.tile([60.0, -60.0, 0.0], 40_000)
    inside = toxicity.marginals(emission, np.array([0, 50_000, 120_000]), chain)
    assert np.all((inside >= 0) & (inside <= 1))


def test_held_out_scores(spark):
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for doc_id, row in rows.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        for span in filter(None, row.toxic_spans.split(",")):
            a, b = map(int, span.split(":"))
            assert texts[doc_id][a:b].strip() == texts[doc_id][a:b] != ""
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    bad = [rows[r.doc_id].predicted for r in labels if r.toxic]
    clean = [rows[r.doc_id].predicted for r in labels if not r.toxic]
    assert np.mean(bad) > 0.8 and np.mean(clean) < 0.03


def test_spans_are_code_points(spark):
    rng = np.random.default_rng(3)
    texts = [
        " ".join([f"été{x}" for x in rng.integers(0, 500, 20)] + ["trash" if i % 2 else "fine"])
        for i in range(400)
    ]
    model = toxicity.fit_model(pa.array(texts), np.array([i % 2 for i in range(400)]))
    df = spark.createDataFrame([(1, "é été TRASH! scum", "old"), (2, None, ""), (3, "", ""), (3, "", "")], "id long, text string, Score string")
    got = toxicity.score(df, model).collect()
    assert got[0].toxic_spans == "6:11" and got[0].predicted == 1
    assert got[1].score == got[2].score < 0.5
    assert toxicity.score(df.limit(0), model).count() == 0


def test_one_class_and_no_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (None, "c")], "doc_id long, text string")
    for rows, want in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (5, 0), (None, 1)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        got = toxicity.score(df, toxicity.fit(df, labels.where("doc_id is not null"))).collect()
        assert {r.score for r in got} == {want}


def test_parts_of_a_batch_do_not_matter():
    texts = ["alpha beta", "", "gamma " * 50, "trash"] * 5
    model = toxicity.fit_model(pa.array(texts), np.array([0, 0, 0, 1] * 5))
    if model.chain is None:
        return
    whole = text_batch(pa.array(texts))
    tokens, inside = model.tokens(whole)
    together = model.scores(inside, tokens.first)
    for text, score in zip(texts, together):
        alone, own = model.tokens(text_batch(pa.array([text])))
        assert np.isclose(model.scores(own, alone.first)[0], score)


def test_only_near_copies_are_left_out_of_the_sample():
    import random

    from patronlens.llm.textbytes import text_batch
    from patronlens.llm.toxicity import token_features, without_copies

    pick = random.Random(4)
    common = [f"w{i}" for i in range(300)]
    own = lambda: [pick.choice(common) for _ in range(400)]
    texts = [own() for _ in range(60)]
    near = [[*t[:390], "other", *t[391:]] for t in texts[:20]]
    half = [[*t[:200], *own()[:200]] for t in texts[20:40]]
    every = [" ".join(t) for t in (*texts, *near, *half)] + ["one two", "one two", "", "", "one"]
    tokens, features = token_features(text_batch(pa.array(every)))
    kept = without_copies(features, tokens.first, np.zeros(len(every), np.int64))
    assert kept[:60].all() and not kept[60:80].any() and kept[80:100].all()
    assert kept[100:].tolist() == [True, False, True, True, True]
    labels = np.zeros(len(every), np.int64)
    labels[60:80] = 1
    assert without_copies(features, tokens.first, labels)[60:80].all()
