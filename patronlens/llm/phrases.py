"""Collocations: phrases of two to five words whose parts meet more often than chance.

Words are counted first. Then follows the vertical partitioning of a suffix tree over the words of
all texts, cut off at five words:

1. Frequencies of prefixes of one and two words tell which positions can begin a phrase that is
   frequent enough; a suffix goes on only while each two neighbouring words are frequent together.
   Prefixes are counted by 64-bit hash; those that are frequent are packed into Bloom
   filters of at most 16 MB, whose false positives only let more suffixes through.
2. Prefixes are grouped by memory budget: a prefix of two words with more suffixes than the budget
   is extended by one word, and again, for which the texts are read again; then consecutive
   prefixes, in the order of their hashes, are put together until a group is full.
3. The texts are read once more. What a task finds is counted, equal suffixes once, and
   sent to the groups in blocks. Tasks hold words as numbers and bytes in Arrow arrays, and what
   waits in them is bounded by bytes.
4. Each group's subtree is built alone, from its sorted suffixes: a node's frequency is the sum of
   its leaves. Nodes above an extended prefix get the totals of several groups, which are added.

All counts are exact and cover all texts; counts of phrases compare words as bytes, never by
hash, which decides the group alone. The driver and the tasks hold at most a million group
bounds; beyond that the budget grows. Null texts
are empty; a text without words adds nothing; a null language is ``und``. Very long texts are
cut between pieces, which changes no count. Repeated rows count each time. Ties in the score go to the smaller
cut, ties in rank to more frequent phrases and then to the smaller one in byte order. An
empty table gives no rows. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.positions import numbered
from patronlens.llm.textbytes import mix
from patronlens.workspace import stage

WORDS = 5
MIN_COUNT = 100
TOP = 2000
GROUP_SUFFIXES = 500_000
MAX_GROUPS = 1 << 20
CHUNK_BYTES = 8 << 20
KEPT_BYTES = 32 << 20
KEPT_HASHES = 4_000_000
BLOCK_ROWS = 100_000
MAX_FILTER_BITS = 27
UNKNOWN_LANGUAGE = "und"

_BREAK = b"\xff"  # stands in no UTF-8 text
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + _MARKS + b"\t", bytes(range(97, 123)) + _BREAK * len(_MARKS) + b" "
)


# --- reading texts ---


def _cut(text: bytes, limit: int) -> Iterator[bytes]:
    """A translated text in parts of about ``limit`` bytes, cut between pieces."""
    start = 0
    while len(text) - start > limit:
        end = text.find(_BREAK, start + limit)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[str, bytes]]:
    """Language and joined texts, with ``_BREAK`` between pieces, of some texts at a time. What waits
    is ``limit`` bytes and one part at most, whatever the number of languages."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    total = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            whole = (text.as_py() or b"").translate(_TABLE)
            for part in _cut(whole, limit) if len(whole) > limit else (whole,):
                waiting.setdefault(lang, []).append(part)
                sizes[lang] += len(part) + 1
                total += len(part) + 1
                if total > limit:
                    largest = max(sizes, key=sizes.__getitem__)
                    total -= sizes.pop(largest)
                    yield largest, _BREAK.join(waiting.pop(largest))
    while waiting:
        lang, parts = waiting.popitem()
        yield lang, _BREAK.join(parts)


def _encoded(text: bytes) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Number of each word of a chunk, and the different words by number; 0 is the break between
    pieces. Only bytes and numbers are held, no object per word."""
    spaced = b"\xff " + text.replace(_BREAK, b" \xff ")
    ends = pa.py_buffer(np.array([0, len(spaced)], np.int64))
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 1, [None, ends, pa.py_buffer(spaced)])
    words = pc.split_pattern(whole, " ").values
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary


class _Sums:
    """Tables of counts ``n``, added up where all other columns are equal and given out when they are many bytes."""

    def __init__(self) -> None:
        self.waiting: list[pa.Table] = []
        self.size = 0

    def add(self, table: pa.Table) -> Iterator[pa.Table]:
        self.waiting.append(table)
        self.size += table.nbytes
        if self.size > KEPT_BYTES:
            summed = self._summed()
            if summed.nbytes > KEPT_BYTES // 2:
                yield summed
            else:
                self.waiting, self.size = [summed], summed.nbytes

    def rest(self) -> Iterator[pa.Table]:
        if self.waiting:
            yield self._summed()

    def _summed(self) -> pa.Table:
        whole = pa.concat_tables(self.waiting)
        self.waiting, self.size = [], 0
        return _added_up(whole)


def _added_up(table: pa.Table) -> pa.Table:
    keys = [name for name in table.column_names if name != "n"]
    summed = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return summed.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = _Sums()
    for lang, text in _chunks(batches):
        ids, words = _encoded(text)
        n = np.bincount(ids, minlength=len(words))
        table = pa.table({"lang": pa.repeat(lang, len(n) - 1), "word": words[1:], "n": pa.array(n[1:], pa.int64())})
        yield from _word_batches(kept.add(table))
    yield from _word_batches(kept.rest())


def _word_batches(tables: Iterable[pa.Table]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    for table in tables:
        for batch in table.to_batches(max_chunksize=50_000):
            yield batch.cast(schema)


def _hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """Hashes of the words of a chunk by number."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))
    hashes[0] = 0
    return hashes


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)




# --- filters ---


class Filter:
    """Bloom filter of 64-bit hashes: two bits a hash, at most ``2 ** MAX_FILTER_BITS`` bits,
    whatever the number of hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(len(bits) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        def bit(at: np.ndarray) -> np.ndarray:
            return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)

        low = hashes & self.mask
        high = (hashes >> np.uint64(32)) & self.mask
        return (bit(low) & bit(high)).astype(bool)


def build_filter(hashes: DataFrame, column: str) -> Filter:
    """The filter of a column of 64-bit hashes. Only the words of the bit array reach the driver."""
    count = hashes.count()
    size = 1 << min(MAX_FILTER_BITS, max(10, (32 * count - 1).bit_length()))
    low = F.col(column).bitwiseAND(F.lit(size - 1))
    high = F.shiftrightunsigned(column, 32).bitwiseAND(F.lit(size - 1))
    bits = hashes.select(F.explode(F.array(low, high)).alias("at"))
    word = F.bit_or(F.expr("shiftleft(1L, cast(at & 63L as int))")).alias("bits")
    found = bits.groupBy(F.shiftright("at", 6).alias("place")).agg(word).toArrow()
    array = np.zeros(size // 64, np.uint64)
    array[found["place"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(array)


# --- passes over the texts ---


def _word_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of words as the passes over the texts compute them."""
    for batch in batches:
        words = batch.column("word").cast(pa.binary()).to_pylist()
        seeds = np.array([_seed(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
        own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        yield pa.RecordBatch.from_arrays([pa.array((own ^ seeds).view(np.int64))], ["hash"])


def _pairs_of(ids: np.ndarray, hashes: np.ndarray, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of each two neighbours that are frequent words of one piece."""
    good = frequent.holds(hashes)[ids] & (ids > 0)
    places = np.flatnonzero(good[:-1] & good[1:])
    return places, _pair_hashes(hashes[ids[places]], hashes[ids[places + 1]])


class _HashCounts:
    """Counts of 64-bit hashes, given out when there are many."""

    def __init__(self) -> None:
        self.waiting = np.empty(KEPT_HASHES, np.uint64)
        self.size = 0

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        while len(hashes):
            own, hashes = np.split(hashes, [len(self.waiting) - self.size])
            self.waiting[self.size : self.size + len(own)] = own
            self.size += len(own)
            if self.size == len(self.waiting):
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        held = self.waiting[: self.size]
        held.sort()
        starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        found, n = held[starts], np.diff(starts, append=self.size)
        self.size = 0
        batch = pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])
        yield from (batch.slice(i, 200_000) for i in range(0, len(found), 200_000))


def _pair_counter(frequent) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _HashCounts()
        for lang, text in _chunks(batches):
            ids, words = _encoded(text)
            yield from kept.add(_pairs_of(ids, _hashes(words) ^ _seed(lang), frequent.value)[1])
        yield from kept.rest()

    return count


@dataclass(frozen=True)
class Prefixes:
    """How suffixes are dealt to groups: at each depth from two on, the hashes of the prefixes that are
    extended, and the smallest hash of each group of those that are not. Both are sorted."""

    extended: tuple[np.ndarray, ...] = ()
    starts: tuple[np.ndarray, ...] = ()

    def is_extended(self, level: int, hashes: np.ndarray) -> np.ndarray:
        own = self.extended[level]
        return own[np.minimum(np.searchsorted(own, hashes), len(own) - 1)] == hashes if len(own) else hashes != hashes

    def groups(self, hashes: np.ndarray, following: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Depth and group of suffixes, from the hashes of their first two words and of each later
        one (0: none)."""
        depth, part = np.full(len(hashes), 2, np.int64), np.zeros(len(hashes), np.int64)
        open_ = np.ones(len(hashes), bool)
        for level, starts in enumerate(self.starts):
            if level:
                hashes = _pair_hashes(hashes.view(np.uint64), following[level - 1]).view(np.int64)
                depth[open_] = level + 2
            part[open_] = np.maximum(np.searchsorted(starts, hashes[open_], "right") - 1, 0)
            open_ &= self.is_extended(level, hashes)
        return depth, part


_NOTHING = pa.scalar(b"", pa.large_binary())


class _Suffixes:
    """Finds the suffixes of chunks of words whose neighbours are frequent together."""

    def __init__(self, frequent: Filter, pairs: Filter, longest: int):
        self.frequent, self.pairs, self.longest = frequent, pairs, longest

    def of(self, lang: str, text: bytes) -> None:
        """Set the ``ids`` of the words of each different suffix, place by place (0: none), how often it
        occurs (``n``), the hash of its first two words (``pair``) and of each ``later`` one."""
        ids, words = _encoded(text)
        own = _hashes(words) ^ _seed(lang)
        places, hashes = _pairs_of(ids, own, self.frequent)
        starts = places[self.pairs.holds(hashes)]
        linked = np.zeros(len(ids) + self.longest, bool)
        linked[starts] = True
        padded = np.concatenate([ids, np.zeros(self.longest, ids.dtype)])
        columns = [padded[starts], padded[starts + 1]]
        goes_on = np.ones(len(starts), bool)
        for d in range(2, self.longest):
            goes_on &= linked[starts + d - 1]
            columns.append(np.where(goes_on, padded[starts + d], 0))
        # Suffixes are equal if all their words are: counted by the numbers of the words.
        names = [str(place) for place in range(len(columns))]
        table = pa.table([*columns, np.ones(len(starts), np.int64)], [*names, "n"])
        table = _added_up(table).combine_chunks()
        self.ids = [table[name].to_numpy() for name in names]
        self.n = table["n"].to_numpy()
        own[0] = 0
        self.pair = _pair_hashes(own[self.ids[0]], own[self.ids[1]]).view(np.int64)
        self.later = [own[place] for place in self.ids[2:]]
        # Every word ends with a blank: a suffix is a prefix of another just as its bytes are.
        ended = pc.binary_join_element_wise(words[1:], _NOTHING, pa.scalar(b" ", pa.large_binary()))
        self.ended = pa.concat_arrays([pa.array([b""], pa.large_binary()), ended])

    def strings(self, rows: slice) -> pa.LargeBinaryArray:
        """Some of the suffixes."""
        return pc.binary_join_element_wise(*(self.ended.take(pa.array(place[rows])) for place in self.ids), _NOTHING)


def _prefix_counter(frequent, pairs, prefixes: Prefixes, longest: int):
    """Counts of the prefixes that are one word longer than the longest ones of ``prefixes``, below
    those that are extended there."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kept = _Suffixes(frequent.value, pairs.value, longest), _HashCounts()
        for lang, text in _chunks(batches):
            found.of(lang, text)
            below, hashes = np.ones(len(found.n), bool), found.pair
            for level, following in enumerate(found.later[: len(prefixes.starts)]):
                below &= prefixes.is_extended(level, hashes)
                hashes = _pair_hashes(hashes.view(np.uint64), following).view(np.int64)
            yield from kept.add(np.repeat(hashes[below].view(np.uint64), found.n[below]))
        yield from kept.rest()

    return count


def _block_maker(frequent, pairs, prefixes: Prefixes, longest: int):
    """Blocks of counted suffixes, one per language and group, whenever a task holds enough of them."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kept = _Suffixes(frequent.value, pairs.value, longest), _Sums()
        for lang, text in _chunks(batches):
            found.of(lang, text)
            for low in range(0, len(found.n), BLOCK_ROWS):
                own = slice(low, low + BLOCK_ROWS)
                depth, part = prefixes.groups(found.pair[own], [later[own] for later in found.later])
                columns = {"lang": pa.repeat(lang, len(part)), "depth": depth, "part": part}
                columns |= {"suffix": found.strings(own), "n": found.n[own]}
                yield from _blocks(kept.add(pa.table(columns)))
        yield from _blocks(kept.rest())

    return make


def _blocks(tables: Iterable[pa.Table]) -> Iterator[pa.RecordBatch]:
    keys = ["lang", "depth", "part"]
    for table in tables:
        table = table.sort_by([(key, "ascending") for key in keys]).combine_chunks()
        ends = _added_up(table.select([*keys, "n"]).set_column(3, "n", pa.repeat(1, len(table))))
        high = 0
        for row in ends.sort_by([(key, "ascending") for key in keys]).to_pylist():
            own = table.slice(high, row.pop("n"))
            high += len(own)
            suffixes = pa.LargeListArray.from_arrays([0, len(own)], own["suffix"].combine_chunks())
            row["suffixes"] = pc.binary_join(suffixes, pa.scalar(_BREAK, pa.large_binary()))[0].as_py()
            row["counts"] = own["n"].to_numpy().tobytes()
            yield pa.RecordBatch.from_pylist([row], _BLOCK)


_BLOCK = pa.schema(
    [("lang", pa.string()), ("depth", pa.int32()), ("part", pa.int64()), ("suffixes", pa.binary()), ("counts", pa.binary())]
)
_BLOCK_DDL = "lang string, depth int, part long, suffixes binary, counts binary"


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words of ``texts(lang, text)``."""
    counted = texts.mapInArrow(_count_words, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hash_counts(texts: DataFrame, counter) -> DataFrame:
    return texts.mapInArrow(counter, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


# --- groups and their subtrees ---


def _sorted_hashes(df: DataFrame) -> np.ndarray:
    return np.sort(df.select("hash").toArrow()["hash"].to_numpy())


def grouped_prefixes(texts: DataFrame, frequent, pairs, counts: DataFrame, longest: int, budget: int) -> Prefixes:
    """Deal the prefixes of ``counts(hash, n)``, of two words, to groups of at most ``budget`` suffixes and
    those of one prefix more; prefixes with more than the budget are extended as far as they have words."""
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    budget = max(budget, total // MAX_GROUPS)
    prefixes = Prefixes()
    for depth in range(2, longest + 1):
        placed = numbered(
            counts.withColumn("all", F.lit(0)), ["all"], ["hash"], f"phrase-order-{depth}", weight=F.col("n")
        )
        groups = placed.groupBy(F.expr(f"pos div {budget}").alias("part")).agg(F.min("hash").alias("hash"))
        # At most total / budget prefixes are above the budget, and as many groups are full.
        above = counts.where(F.col("n") > budget) if depth < longest else counts.limit(0)
        extended = _sorted_hashes(above)
        prefixes = Prefixes((*prefixes.extended, extended), (*prefixes.starts, _sorted_hashes(groups)))
        if not len(extended):
            break
        counts = stage(
            _hash_counts(texts, _prefix_counter(frequent, pairs, prefixes, longest)), f"phrase-prefixes-{depth + 1}"
        )
    return prefixes


def suffix_blocks(texts: DataFrame, frequent_words: DataFrame, min_count: int, longest: int, budget: int) -> DataFrame:
    """``lang, depth, part, suffixes, counts``: what each group's subtree is built from. ``depth`` is the number
    of words of the prefixes in the group."""
    context = texts.sparkSession.sparkContext
    hashes = stage(frequent_words.select("lang", "word").mapInArrow(_word_hashes, "hash long"), "phrase-words")
    words = context.broadcast(build_filter(hashes, "hash"))
    counts = _hash_counts(texts, _pair_counter(words)).where(F.col("n") >= min_count)
    counts = stage(counts, "phrase-pairs")
    pairs = context.broadcast(build_filter(counts.select("hash"), "hash"))
    prefixes = grouped_prefixes(texts, words, pairs, counts, longest, budget)
    return texts.mapInArrow(_block_maker(words, pairs, prefixes, longest), _BLOCK_DDL)


def _leaves(blocks: pa.Table) -> pa.Table:
    """``lang, suffix, n``: counted suffixes of all blocks of a group, in the order of their bytes."""
    found = []
    for lang, suffixes, counts in zip(blocks["lang"], blocks["suffixes"], blocks["counts"], strict=True):
        own = pc.split_pattern(pa.array([suffixes.as_py()], pa.large_binary()), _BREAK).values
        n = pa.array(np.frombuffer(counts.as_py(), np.int64))
        found.append(pa.table({"lang": pa.repeat(lang, len(own)), "suffix": own, "n": n}))
    return _added_up(pa.concat_tables(found)).sort_by([("lang", "ascending"), ("suffix", "ascending")])


_NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


def _subtree(min_count: int) -> Callable[[pa.Table], pa.Table]:
    """Nodes of two words and more of a group's subtree, with the sums of their leaves."""

    def build(blocks: pa.Table) -> pa.Table:
        depth = blocks["depth"][0].as_py()
        found: list[tuple[str, str, int, int]] = []
        path: list[bytes] = []  # words from the root to the open node
        totals: list[int] = []

        def close(keep: int, lang: str) -> None:
            while len(path) > keep:
                n, words = totals.pop(), len(path)
                # Above an extended prefix other groups hold more leaves.
                if words >= 2 and (n >= min_count or words < depth):
                    found.append((lang, b" ".join(path).decode(), words, n))
                path.pop()
                if totals:
                    totals[-1] += n

        last = ""
        for batch in _leaves(blocks).to_batches(max_chunksize=10_000):
            for lang, suffix, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if lang != last:
                    close(0, last)
                    last = lang
                words = suffix.split(b" ")[:-1]
                same, most = 0, min(len(path), len(words))
                while same < most and path[same] == words[same]:
                    same += 1
                close(same, lang)
                path.extend(words[same:])
                totals.extend([0] * (len(words) - same))
                totals[-1] += n
        close(0, last)
        columns = zip(*found, strict=True) if found else ([], [], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, _NODES.types, strict=True)], _NODES)

    return build


def phrase_counts(blocks: DataFrame, min_count: int) -> DataFrame:
    """``lang, phrase, words, n`` of all phrases of two words and more that are frequent enough."""
    schema = "lang string, phrase string, words int, n long"
    nodes = blocks.groupBy("depth", "part").applyInArrow(_subtree(min_count), schema)
    whole = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return whole.where(F.col("n") >= min_count)


# --- scores ---


def _exact_score(scale: int) -> Column:
    """``floor(scale * a * n / (l * r))`` in decimals of 38 digits."""
    wide = lambda name, digits: F.col(name).cast(f"decimal({digits},0)")
    product = F.lit(scale).cast("decimal(4,0)") * wide("a", 17) * wide("n", 17)
    return F.call_function("div", product, wide("l", 18) * wide("r", 18)).cast("long")


def scored(counts: DataFrame, totals: DataFrame, scale: int = 1000) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of every phrase of ``counts(lang, phrase, words,
    n)``, at its weakest cut. ``counts`` holds single words too."""
    parts = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cut = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), cuts)
    cut = cut.withColumns(
        {
            "left": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
            "right": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " "),
        }
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # ``totals`` has a row per language and is written, so its size is known to Spark.
    known = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    best = F.min(F.struct(_exact_score(scale).alias("score"), "k", "l", "r")).alias("best")
    return known.groupBy("lang", "phrase", "words", "a", "n").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score"
    )


def covered(counts: DataFrame, percent: int = 100) -> DataFrame:
    """``lang, phrase`` of the phrases that stand inside a longer one at least ``percent`` percent as frequent.

    A phrase between the two is at least as frequent as the longer one, so it is enough to
    look one word further.
    """
    parts = F.split("phrase", " ")
    inner = F.array(
        F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " "),
    )
    longer = counts.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    inside = counts.join(most, ["lang", "phrase"])
    return inside.where(F.lit(100) * F.col("longer") >= F.lit(percent) * F.col("n")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    longest: int = WORDS,
    budget: int = GROUP_SUFFIXES,
    covered_percent: int = 100,
) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of every collocation: ``a`` occurrences, ``l`` and
    ``r`` of its two parts at the weakest cut, ``n`` words in the language."""
    language = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang")
    texts = docs.select(language, F.col(text).alias("text")).where(F.octet_length("text") > 0)
    words = stage(word_counts(texts), "phrase-word-counts")
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    frequent = words.where(F.col("n") >= min_count)
    blocks = suffix_blocks(texts, frequent, min_count, longest, budget)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    counts = stage(single.unionByName(phrase_counts(blocks, min_count)), "phrase-counts")
    return scored(counts, totals).join(covered(counts, covered_percent), ["lang", "phrase"], "left_anti")


def strongest(found: DataFrame, top: int = TOP, spread: int = 16) -> DataFrame:
    """The first ``top`` phrases of each language with their ``rank``. The phrases of a language are
    ranked in ``spread`` parts first, so that one task sees ``spread * top`` rows at most."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(spread))
    inside = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    few = found.withColumn("_part", part).withColumn("_rank", inside).where(F.col("_rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = few.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
