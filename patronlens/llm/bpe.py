"""Byte-level BPE: texts to token ids and back, with the ranks of a public vocabulary.

The `tokenizers` library merges; it gets the bytes as printable characters by the
usual byte-to-character table. A rank file has no merge list, so one is derived: the
last merge of each token when its own bytes are merged by rank. Within a longer
piece the bytes of a token merge in the same order, hence no other split ever makes it.

A blank before a non-blank always starts a match of the pattern, so texts are first
split there. Each word of at most ``CACHED_BYTES`` bytes is cut by the pattern and encoded once
while it stays in a cache of two generations, each of at most ``CACHE_BYTES``; longer words, such as
texts without blanks, are never kept. The cache never changes a result. Batches are worked off in
pieces of about ``BATCH_BYTES`` bytes of text.

Null and empty texts have no tokens. Texts of any length are encoded whole; repeated rows give equal
rows; an empty table gives none. Columns of the input stay; an input column of the
same name as an output column is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patronlens.llm.textbytes import pieces

CACHED_BYTES = 64
CACHE_BYTES = 24 << 20
_ENTRY_BYTES = 280  # of the objects of one entry, besides their contents
BATCH_ROWS = 256
BATCH_BYTES = 1 << 20

Encoded = tuple[str, bytes]


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable in
    Latin-1, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that become ``token`` last, None if merging never reaches it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return None
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteBpe:
    """Encoder and decoder for one rank table and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import models

        table = byte_characters()
        shown = {token: "".join(map(table.__getitem__, token)) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            if pair := last_merge(token, ranks):
                merges.append((shown[pair[0]], shown[pair[1]]))
        vocabulary = {shown[token]: rank for token, rank in ranks.items()}
        self._model = models.BPE(vocabulary, merges, ignore_merges=True)
        self._shown = dict(enumerate(table))
        byte_of = {c: b for b, c in enumerate(table)}
        self.token_bytes = {
            rank: bytes(map(byte_of.__getitem__, text)) for text, rank in vocabulary.items()
        }
        # White space is the Unicode property, without the separators that Python adds.
        self._pattern = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}")
            .replace(r"\s", r"\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}")
        )
        self._uneven = re.compile(r" (?=\s|\Z)")
        self._even = re.compile(r" (?=\S)")
        self._recent: dict[str, Encoded] = {}
        self._older: dict[str, Encoded] = {}
        self._recent_bytes = 0

    def _encode_part(self, part: str) -> Encoded:
        """Ids as text and the bytes that they decode to, for a text cut by the pattern."""
        if part[1:].isalpha() and part[0] == " ":  # letters only: one match, no need to search
            cut = (part,)
        elif part[1:-1].isalpha() and part[0] == " " and part[-1] in ",.":
            cut = (part[:-1], part[-1])
        else:
            cut = self._pattern.findall(part)
        shown = [p.encode().decode("latin-1").translate(self._shown) for p in cut]
        ids = [token.id for piece in shown for token in self._model.tokenize(piece)]
        return ",".join(map(str, ids)), b"".join([self.token_bytes[i] for i in ids])

    def _known(self, word: str) -> Encoded:
        """The encoding of a blank and ``word`` when it is not among the recent ones."""
        found = self._older.get(word) or self._encode_part(" " + word)
        if len(word) > CACHED_BYTES or len(found[1]) > CACHED_BYTES + 1:
            return found
        if self._recent_bytes >= CACHE_BYTES:
            self._older, self._recent, self._recent_bytes = self._recent, {}, 0
        if word not in self._recent:
            self._recent[word] = found
            self._recent_bytes += _ENTRY_BYTES + 4 * len(word) + len(found[0]) + len(found[1])
        return found

    def cached_bytes(self) -> int:
        """About what both generations of the cache hold."""
        return sum(
            _ENTRY_BYTES + 4 * len(word) + len(ids) + len(decoded)
            for kept in (self._recent, self._older)
            for word, (ids, decoded) in kept.items()
        )

    def _encoded(self, text: str) -> list[Encoded]:
        """The encodings of the parts of a non-empty text, in order."""
        first, *words = self._even.split(text) if self._uneven.search(text) else text.split(" ")
        found = list(map(self._recent.get, words))
        if None in found:
            found = [f or self._known(w) for f, w in zip(found, words, strict=True)]
        return [self._encode_part(first), *found] if first else found

    def encode(self, text: str | None) -> list[int]:
        """The token ids of a text, without special tokens."""
        return [int(i) for ids, _ in self._encoded(text) for i in ids.split(",")] if text else []

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Join the bytes before decoding, since a character may span several tokens; bytes
        that form no character become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def offsets(self, ids: list[int]) -> list[int]:
        """The byte position after each token."""
        return np.cumsum([len(self.token_bytes[i]) for i in ids], dtype=np.int64).tolist()

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded bytes."""
        found = self._encoded(text) if text else []
        ids = ",".join([f[0] for f in found])
        decoded = b"".join([f[1] for f in found])
        return (
            ids.count(",") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest(),
        )


@lru_cache(maxsize=2)
def _cached(ranks_file: bytes, pattern: str) -> ByteBpe:
    lines = (line.split() for line in ranks_file.splitlines() if line.strip())
    return ByteBpe({base64.b64decode(t): int(r) for t, r in lines}, pattern)


def _shared(df: DataFrame, path: str):
    """The vocabulary file as a broadcast, so that only the driver needs the path."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _parts(batch: pa.RecordBatch, text: str | None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, cut by bytes of text where there is one."""
    whole = [batch] if text is None else pieces(batch, text, BATCH_BYTES)
    for part in whole:
        for low in range(0, part.num_rows, BATCH_ROWS):
            yield part.slice(low, BATCH_ROWS)


def _with_columns(df: DataFrame, fields: list[T.StructField], per_batch, text: str | None = None) -> DataFrame:
    """Append columns made by ``per_batch(record batch) -> list of Arrow arrays``."""
    names = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    source = df.schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = [i for i, name in enumerate(source) if name.lower() not in names]
        for batch in batches:
            for part in _parts(batch, text):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in keep), *per_batch(part)],
                    names=[*(f.name for f in kept), *(f.name for f in fields)],
                )

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``token_ids`` and ``token_ends`` (byte position after each token)."""
    shared = _shared(df, path)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = _cached(shared.value, pattern)
        ids = [coder.encode(t) for t in batch.column(text).to_pylist()]
        ends = [coder.offsets(i) for i in ids]
        return [pa.array(ids, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int64()))]

    fields = [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("token_ends", T.ArrayType(T.LongType())),
    ]
    return _with_columns(df, fields, columns, text)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded``, the text of the ids in column ``ids``; null ids give an empty text."""
    shared = _shared(df, path)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = _cached(shared.value, pattern)
        return [pa.array([coder.decode(i or ()) for i in batch.column(ids).to_pylist()], pa.string())]

    return _with_columns(df, [T.StructField("decoded", T.StringType())], columns)


def encode_checked(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``token_ids``, ``n_tokens`` and ``round_trip``, whether decoding gives the text back."""
    shared = _shared(df, path)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = _cached(shared.value, pattern)
        texts = batch.column(batch.schema.names.index(text)).to_pylist()
        ids = [coder.encode(t) for t in texts]
        same = [coder.decode(i) == (t or "") for i, t in zip(ids, texts, strict=True)]
        counts = pa.array([len(i) for i in ids], pa.int64())
        return [pa.array(ids, pa.list_(pa.int32())), counts, pa.array(same, pa.bool_())]

    fields = [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    return _with_columns(df, fields, columns, text)


def digest(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Replace the text by ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: encodes and
    decodes every text but keeps only what is needed to compare two runs."""
    shared = _shared(df, path)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = _cached(shared.value, pattern)
        rows = [coder.digests(t) for t in batch.column(text).to_pylist()]
        counts, ids, decoded = zip(*rows) if rows else ((), (), ())
        return [
            pa.array(counts, pa.int64()),
            pa.array(ids, pa.string()),
            pa.array(decoded, pa.string()),
        ]

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return _with_columns(df, fields, columns, text).drop(text)
