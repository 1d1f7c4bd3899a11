"""Passages that repeat across documents, by a sparse suffix array.

Of all suffixes (one per word) only those at content-selected places are kept: the smallest
of the hashes of ``SEED_WORDS`` words in every window that a passage of ``min_words``
words must contain. Two copies of a passage keep the same places, so a kept suffix of
one sorts next to its copy in the other.

1. Texts that occur more than once are collapsed; such a text is one passage itself.
2. The kept suffixes are sorted across the cluster and neighbours compared. Suffixes that
   begin like one of another text are seeds.
3. Around each seed the match is extended left and right: every run of ``min_words`` words
   that contains the seed is hashed, these runs are sorted and compared in the same way, and
   runs found in two texts are joined to maximal passages.

Sorting is by value, text and place, so a passage shared by very many documents is spread over
as many partitions as its rows need; runs of equal values that cross partitions are
settled by a list of at most one value per partition. The result is exact: all words in a
run of ``min_words`` words that occurs in two documents, up to 64-bit hash collisions.

Words end at ASCII white space and compare byte by byte. Null, empty and shorter texts have
no passages. Repeats inside one document do not count; rows with the same id and text count
as one document, rows with other ids (null is one id) as others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.textbytes import (
    SPACE,
    SliceHashes,
    TextBatch,
    Tokens,
    code_points,
    mix,
    pieces,
    text_batch,
)
from patronlens.workspace import delete_path, stage, stage_at

MIN_WORDS = 50
SEED_WORDS = 20
PARTITION_ROWS = 500_000


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbouring values, the first of equal ones."""
    places = np.arange(len(values))
    span = 1

    def smaller(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return np.where(values[high] < values[low], high, low)

    while span < width:
        step = min(span, width - span)
        places = smaller(places[:-step], places[step:])
        span += step
    return places


def _word_hashes(batch: TextBatch) -> tuple[Tokens, np.ndarray]:
    tokens = batch.tokens(~SPACE)
    return tokens, mix(SliceHashes(batch.data).of(tokens.starts, tokens.ends))


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that start at each word, as far as there are so many."""
    starts = np.arange(max(0, len(words) - length + 1))
    return mix(SliceHashes(words).of(starts, starts + length)).view(np.int64)


def _whole_runs(tokens: Tokens, length: int) -> np.ndarray:
    """Words from which ``length`` words lie in the same text."""
    starts = np.arange(max(0, len(tokens) - length + 1))
    return starts[starts + length <= tokens.first[1:][tokens.owner()[starts]]]


def kept_suffixes(batch: TextBatch, min_words: int, seed_words: int) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Words at which a suffix is kept, and the hash of its first ``seed_words`` words."""
    tokens, words = _word_hashes(batch)
    whole = _whole_runs(tokens, min_words)
    if not len(whole):
        return tokens, whole, np.zeros(0, np.int64)
    seeds = _runs(words, seed_words)
    least = _window_minimum(seeds, min_words - seed_words + 1)
    at = np.unique(least[whole])
    return tokens, at, seeds[at]


def _suffix_table(texts: DataFrame, min_words: int, seed_words: int) -> DataFrame:
    """``value, text_id, place`` of all kept suffixes; places count the words of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens, at, values = kept_suffixes(text_batch(part.column("text")), min_words, seed_words)
                owner = tokens.owner()[at]
                ids = part.column("text_id").to_numpy()[owner]
                places = (at - tokens.first[owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(ids), pa.array(places)], names=["value", "text_id", "place"]
                )

    return texts.select("text_id", "text").mapInArrow(run, "value long, text_id long, place int")


def shared_by_texts(
    rows: DataFrame, partition_rows: int = PARTITION_ROWS
) -> tuple[DataFrame, str]:
    """The rows of ``rows(value, text_id, place, ...)`` whose value occurs in two texts or more.

    ``rows`` must be cheap to read several times (staged). Neighbours are compared in the
    order of value, text and place. Returns the path of the compared rows as well.
    """
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, least, -(-rows.count() // partition_rows))
    ordered = rows.repartitionByRange(parts, "value", "text_id", "place")
    ordered = ordered.sortWithinPartitions("value", "text_id", "place")
    marked = T.StructType([*rows.schema.fields, T.StructField("shared", T.BooleanType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if b.num_rows]
        if not whole:
            return
        table = pa.Table.from_batches(whole)
        value, text = table.column("value").to_numpy(), table.column("text_id").to_numpy()
        begins = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        ends = np.append(begins[1:], len(value)) - 1
        run = np.repeat(np.arange(len(begins)), ends - begins + 1)
        shared = (text[begins] != text[ends])[run]
        # The first and the last run may go on in another partition.
        outer = (run == 0) | (run == run[-1])
        table = table.append_column("shared", pa.array(shared)).filter(pa.array(shared | outer))
        yield from table.to_batches(max_chunksize=1 << 16)

    found, path = stage_at(ordered.mapInArrow(compare, marked), "suffix-neighbours")
    open_ends = found.where("not shared").groupBy("value").agg(
        F.min("text_id").alias("low"), F.max("text_id").alias("high")
    )
    across = open_ends.where("low <> high").select("value")
    also = found.where("not shared").join(across, "value", "left_semi")
    # A run that is shared in one partition makes its rows in others shared as well.
    ours = found.where("shared").select("value").distinct()
    more = found.where("not shared").join(across, "value", "left_anti").join(ours, "value", "left_semi")
    return found.where("shared").union(also).union(more).drop("shared"), path


def _run_table(texts: DataFrame, seeds: DataFrame, min_words: int, seed_words: int) -> DataFrame:
    """All runs of ``min_words`` words around the seeds: ``value, text_id, place, start, end``,
    the last two in code points."""
    per_text = seeds.groupBy("text_id").agg(F.collect_list("place").alias("places"))
    reach = min_words - seed_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts_here = text_batch(part.column("text"))
                tokens, words = _word_hashes(texts_here)
                values = _runs(words, min_words)
                places = part.column("places")
                offsets = places.offsets.to_numpy()
                seeds_here = places.values.to_numpy()[offsets[0] : offsets[-1]]
                owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                wanted = np.zeros(len(tokens) + 1, np.int64)
                at = tokens.first[owner] + seeds_here
                np.add.at(wanted, np.maximum(at - reach, tokens.first[owner]), 1)
                np.add.at(wanted, at + 1, -1)
                starts = _whole_runs(tokens, min_words)
                starts = starts[np.cumsum(wanted)[starts] > 0]
                points = code_points(texts_here.data)
                of = tokens.owner()[starts]
                base = points[texts_here.offsets[of]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values[starts]),
                        pa.array(part.column("text_id").to_numpy()[of]),
                        pa.array((starts - tokens.first[of]).astype(np.int32)),
                        pa.array((points[tokens.starts[starts]] - base).astype(np.int32)),
                        pa.array((points[tokens.ends[starts + min_words - 1]] - base).astype(np.int32)),
                    ],
                    names=["value", "text_id", "place", "start", "end"],
                )

    schema = "value long, text_id long, place int, start int, end int"
    chosen = texts.select("text_id", "text").join(per_text, "text_id").select("text_id", "text", "places")
    return chosen.mapInArrow(run, schema)


def _passages(runs: DataFrame, min_words: int) -> DataFrame:
    """``text_id, start, end, words``: overlapping or touching runs joined."""
    by_place = Window.partitionBy("text_id").orderBy("place")
    first = F.coalesce(F.col("place") > F.lag("place").over(by_place) + min_words, F.lit(True))
    numbered = runs.withColumn("number", F.sum(first.cast("int")).over(by_place))
    return numbered.groupBy("text_id", "number").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("place") - F.min("place") + min_words).alias("words"),
    )


def _words(text: Column) -> Column:
    return F.size(F.split(F.trim(F.regexp_replace(text, r"[ \t-\r]++", " ")), " "))


def repeated_passages(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    seed_words: int = SEED_WORDS,
) -> DataFrame:
    """``doc_id, copied, n_passages, repeated_words, passages`` of the documents with a passage of
    ``min_words`` words or more that another document has too.

    ``passages`` lists ``start:end`` in code points; ``copied`` says that another document has
    the very same text, which is then one passage.
    """
    if seed_words > min_words:
        raise ValueError("a seed is a part of the passage")
    value = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(
        F.col(doc_id).alias("doc_id"),
        value.alias("text"),
        F.xxhash64(value).alias("k1"),
        F.xxhash64(F.lit(1), value).alias("k2"),
    ).where(F.octet_length("text") >= 2 * min_words - 1)
    once = docs.groupBy("k1", "k2").agg(
        F.first("text").alias("text"),
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        F.max(F.col("doc_id").isNull().cast("int")).alias("nulls"),
    )
    # A text is a copy if rows with different ids have it.
    once = once.withColumn(
        "copied", (F.col("low") != F.col("high")) | ((F.col("nulls") == 1) & F.col("low").isNotNull())
    ).select("k1", "k2", "text", F.coalesce("copied", F.lit(False)).alias("copied"))
    texts = stage(once.withColumn("text_id", F.monotonically_increasing_id()), "suffix-texts")
    suffixes, suffix_path = stage_at(_suffix_table(texts, min_words, seed_words), "suffixes")
    seeds, seed_path = shared_by_texts(suffixes)
    seeds = seeds.select("text_id", "place")
    runs, run_path = stage_at(_run_table(texts, seeds, min_words, seed_words), "suffix-runs")
    # All that reads these tables has been written; the disk is needed for the next sort.
    for path in (suffix_path, seed_path):
        delete_path(df.sparkSession, path)
    repeated, _ = shared_by_texts(runs)
    delete_path(df.sparkSession, run_path)
    found = _passages(repeated, min_words)
    trimmed = F.regexp_extract("text", r"^[ \t-\r]*+", 0)
    copied = texts.where("copied").withColumn("words", _words(F.col("text")))
    whole = copied.where(F.col("words") >= min_words)
    whole = whole.select(
        "text_id",
        F.length(trimmed).alias("start"),
        (F.length("text") - F.length(F.regexp_extract(F.reverse("text"), r"^[ \t-\r]*+", 0))).alias("end"),
        "words",
    )
    parts = found.select("text_id", "start", "end", "words").join(
        texts.where("not copied").select("text_id"), "text_id", "left_semi"
    )
    listed = parts.union(whole).groupBy("text_id").agg(
        F.count("*").alias("n_passages"),
        F.sum("words").cast("long").alias("repeated_words"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    by_key = texts.select("k1", "k2", "text_id", "copied").join(listed, "text_id")
    return (
        docs.select("doc_id", "k1", "k2")
        .join(by_key, ["k1", "k2"])
        .select("doc_id", "copied", "n_passages", "repeated_words", spans.alias("passages"))
    )
