import base64

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_decontaminate import clean, plain_leaks, template
from test_pii import base_spans
from test_simhash import plain_classes

import corpus_pipeline as pipeline
from patronlens.llm import quality
from patronlens.llm.sampling import labelled_sample
from patronlens.workspace import stage

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, apply in pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns and df.schema.simpleString() == steps[0].schema.simpleString()
    assert steps[-1].columns == [*steps[0].columns, "token_ids", "n_tokens", "round_trip"]
    assert steps[-1].count() == steps[-2].count() > 0


def test_quality(spark, steps):
    before, after = rows(steps[0]), rows(steps[1])
    model = quality.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    keep = {r.doc_id for r in quality.score(steps[0], model).where("keep").collect()}
    assert after == {k: r for k, r in before.items() if k in keep}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id in after for r in labels if r.quality == 1]
    bad = [r.doc_id in after for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05


def test_near_duplicates(steps):
    before, after = rows(steps[1]), rows(steps[2])
    classes = plain_classes([(k, r.text) for k, r in sorted(before.items())])
    assert after == {k: before[k] for k in {c for _, _, c in classes}}


def test_decontamination(spark, steps):
    before, after = rows(steps[2]), rows(steps[3])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = {}
    for item in items:
        for t in (template(item), clean(item)):
            for j in range(len(t) - 4):
                index.setdefault(tuple(t[j : j + 5]), set()).add(item)
    leaked = set()
    for k, r in before.items():
        near = set()
        for t in (template(r.text), clean(r.text)):
            near.update(*[index.get(tuple(t[j : j + 5]), ()) for j in range(len(t) - 4)])
        if any(plain_leaks(r.text, item) >= 0.8 for item in near):
            leaked.add(k)
    assert leaked and after == {k: r for k, r in before.items() if k not in leaked}


def test_personal_data(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert before.keys() == after.keys()
    touched = 0
    for k, r in before.items():
        spans = base_spans(r.text)
        if not spans and after[k].text == r.text:
            assert after[k] == r
            continue
        touched += 1
        assert after[k].n_chars == len(after[k].text)
        left = base_spans(after[k].text)
        assert not [s for s in left if r.text.find(after[k].text[s[1] : s[2]]) >= 0], (k, left)
        for kind, a, b in spans:
            assert r.text[a:b] not in after[k].text and f"[{kind.upper()}]" in after[k].text
    assert touched > 3


def test_tokens(steps):
    with open(public_tokenizers.path(pipeline.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in steps[5].collect():
        assert r.token_ids == own.encode_ordinary(r.text) and r.n_tokens == len(r.token_ids) and r.round_trip


def test_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and an extra column pass all stages."""
    good = "The quick brown fox jumps over the lazy dog and runs away into the deep green forest again."
    data = [(1, good, "en", "s", 1, "x"), (1, good, "en", "s", 1, "x"), (None, good, None, None, None, None)]
    data += [(2, None, "en", None, 0, "y"), (3, "", "en", "s", 0, None), (4, "call a@b.cd now", "en", "s", 15, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string"
    docs = spark.createDataFrame(data, schema)
    for name, apply in pipeline.STAGES:
        docs = stage(apply(spark, docs, "/root/testdata/sf0.001"), name)
    found = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == len(found) and None not in found
    assert 1 in found and found[4].text == "call [EMAIL] now" and found[4].n_chars == 16
    assert len(found.keys() & {2, 3}) <= 1


def test_no_stage_touches_extra_columns(spark):
    """Extra columns with the names that stages and operators make pass the first four stages."""
    names = (
        "keep expected_grade tail_probability _row row order rest doc_key pii_spans pii_sure pii_candidates label "
        "fingerprint component_id words plain item_id windows similarity _rank seg none"
    ).split()
    good = "The quick brown fox jumps over the lazy dog and runs away into the deep green forest again."
    rows = [(i, f"{good} number {'abcdefgh'[i] * 9} {'xyzuvwrt'[i] * 7} mail a{i}@b.cd", "en", "s", 1) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs = docs.withColumns({c: F.concat(F.lit(f"mine {c} "), "doc_id") for c in names})
    count = docs.count()
    for name, apply in pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        assert docs.schema["n_chars"].dataType.simpleString() == "int"
        found = docs.collect()
        assert 0 < len(found) <= count
        assert all(r[c] == f"mine {c} {r.doc_id}" for r in found for c in names), name
    assert all("[EMAIL]" in r.text and r.n_chars == len(r.text) for r in found)


def test_sample_is_the_same_under_any_partitioning(spark):
    docs = spark.range(4000).selectExpr("id % 10 as doc_id", "concat('text ', id div 10) as text")
    labels = spark.range(10).selectExpr("id as doc_id", "id % 2 as toxic")
    taken = [
        sorted(tuple(r) for r in labelled_sample(docs.repartition(n, "text"), labels, "toxic", 300, 100).collect())
        for n in (1, 7)
    ]
    assert taken[0] == taken[1] and len(taken[0]) == 600
