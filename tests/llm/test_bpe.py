import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABET = " \n\t\r  \x1c\x85abcABz019'sté中ก🙂!?-.,​́ſ٣ª"


def test_same_ids_as_reference_library(coder, reference):
    @settings(max_examples=1500, deadline=None, database=None)
    @given(st.text(alphabet=ALPHABET, max_size=20) | st.text(max_size=20))
    def check(text):
        ids = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids) == text
        assert coder.offsets(ids)[-1:] == ([len(text.encode())] if text else [])

    check()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 999, " " * 500 + "x", "\n" * 77 + " a", "'" * 400])
def test_long_runs(coder, reference, text):
    assert coder.encode(text) == reference.encode_ordinary(text)


def test_cache_size_never_matters(coder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 900)
    text = " ".join(f"word{i % 7} and{i}" for i in range(60))
    assert coder.encode(text) == reference.encode_ordinary(text)


def test_split_characters_decode_whole(coder):
    ids = [next(i for i, b in coder.token_bytes.items() if b == bytes([x])) for x in "é🙂".encode()]
    assert coder.decode(ids) == "é🙂"
    assert coder.decode(ids[:1]) == "�"


def test_frames(spark, reference):
    texts = ["Hello  world", None, "", "é" * 3000, "Hello  world"]
    rows = [(i, t, "old") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TOKEN_IDS string")
    encoded = bpe.encode(df, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "text", "token_ids", "token_ends"]
    for row in bpe.decode(encoded, PATH, PATTERN).collect():
        assert row.token_ids == reference.encode_ordinary(row.text or "")
        assert row.decoded == (row.text or "")
    digests = {r.doc_id: r for r in bpe.digest(df.select("doc_id", "text"), PATH, PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode_ordinary(text or "")
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digest(df.where(F.lit(False)), PATH, PATTERN).count() == 0


def test_texts_without_blanks_do_not_fill_the_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 200_000)
    own = bpe.ByteBpe(bpe.read_ranks(PATH), PATTERN)
    for i in range(5000):
        own.encode(f"x{i}" + "\u4e2d\u6587" * 300 + f" QUJD{i}" * 3 + " " + f"{i:x}" * 40)
    assert own.cached_bytes() < 2 * 200_000 + 2000
    assert own.cached_bytes() == sum(map(len_of, ((w, e) for kept in (own._recent, own._older) for w, e in kept.items())))


def len_of(entry):
    word, (ids, decoded) = entry
    return bpe._ENTRY_BYTES + 4 * len(word) + len(ids) + len(decoded)


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 700_000, "b" * 700_000, None, "c"], "n": [1, 2, 3, 4]})
    parts = list(bpe._parts(batch, "text"))
    assert [p.num_rows for p in parts] == [1, 3] and sum(p.num_rows for p in bpe._parts(batch, None)) == 4


def test_whole_table_against_the_second_library(spark, reference):
    from patronlens.llm import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op1_byte_bpe(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode_ordinary(docs[r.doc_id] or "")
        listed = ",".join(map(str, ids))
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(listed.encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
