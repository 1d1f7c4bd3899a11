import numpy as np
import pyarrow as pa
import pytest

from patronlens.llm import quality, queries
from patronlens.llm.textbytes import text_batch

SF = "/root/testdata/sf0.01"


def test_scores_of_whole_table(spark):
    rows = {r.doc_id: r for r in queries.op10_quality(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    right = [rows[r.doc_id].keep == (r.quality == 1) for r in labels]
    assert np.mean(right) > 0.97
    assert np.mean([rows[r.doc_id].keep for r in labels if r.quality == 1]) > 0.99


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 3 <> 0"), sample_rows=400)
    scored = quality.score(docs.where("doc_id % 3 = 0"), model).join(labels, "doc_id").collect()
    good = [r.keep for r in scored if r.quality == 1]
    bad = [r.keep for r in scored if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.08


def test_ordered_grades():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    texts, grades = [], []
    for i in range(900):
        grade = i % 4
        odds = np.array([1.0 + grade * (j % 3 == 0) * 2 for j in range(60)])
        texts.append(" ".join(rng.choice(words, 80, p=odds / odds.sum())))
        grades.append(float(grade))
    rows = quality.sparse_rows(text_batch(pa.array(texts)))
    model = quality.fit_ordinal(rows[:600], grades[:600])
    assert np.all(np.diff(model.thresholds) > 0)
    batch = text_batch(pa.array(texts[600:]))
    scores = quality.mean_scores(batch, model.weights)
    tails = model.tails(scores)
    assert np.all(np.diff(tails, axis=1) <= 0)
    expected = model.expected(scores)
    assert np.corrcoef(expected, grades[600:])[0, 1] > 0.85
    assert np.abs(expected - grades[600:]).mean() < 0.6
    # The batch score is the plain dot product of shares and weights.
    plain = [model.weights[i] @ s for i, s in rows[600:]]
    assert np.allclose(plain, scores)


def test_edge_rows(spark):
    rows = [(1, "good text here", 1), (2, None, None), (None, "", 0), (3, "x" * 200_000, 1), (3, "x" * 200_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Keep int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    scored = quality.score(df, model, keep_text=True)
    assert scored.columns == ["doc_id", "text", "expected_grade", "tail_probability", "keep"]
    assert scored.count() == len(rows)
    none = quality.fit(df, labels.limit(0))
    assert {(r.expected_grade, r.keep) for r in quality.score(df, none).collect()} == {(None, True)}
    one = quality.fit(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {(r.expected_grade, r.keep) for r in quality.score(df, one).collect()} == {(1.0, True)}
    assert quality.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("texts", [[], [""], ["", "a", ""], ["a b", "", "b a b"]])
def test_empty_texts_in_a_batch(texts):
    weights = np.arange(1 << quality.BITS, dtype=float)
    batch = text_batch(pa.array(texts, pa.string()))
    alone = [quality.mean_scores(text_batch(pa.array([t])), weights)[0] for t in texts]
    assert np.allclose(quality.mean_scores(batch, weights), alone)
