"""Benchmark items in documents, also with other numbers, names or units.

Both sides are turned into templates: words in lower case without punctuation, with numbers, names
(capitalised words that are not common) and units replaced by typed placeholders. Items are
indexed by all windows of five template words and by all windows of five plain words, so that
case, line breaks and unusual names hide nothing. A document first contributes only every
``stride``-th window: an item with enough windows found has more of them in a row than that, so
it is met wherever it starts; the stride follows from the items. Documents that hit an item
are then compared window by window. Windows on one diagonal (same distance between document and
item) count if each value of the item stands for its usual value in the document, or if the
values are the same. An item leaks if at least 0.8 of its windows are found so.

A window of placeholders alone, such as five numbers in a row, says nothing and is the same in all
tables of all documents. It is never looked up or joined by itself, but only at the one place
of a document where a diagonal that has a hit with a word expects it. An item of
nothing but placeholders leaks where its plain words stand.

Up to ``LISTED_WINDOWS`` item windows, the first look is a filter in the scan of the documents;
beyond, the windows are joined. Both find the same documents.

Items of five to eight words are looked up at every position, in documents' windows of their own
length; items of one to four words match documents that have the same template as a whole.
Null and empty texts match nothing. Repeated rows of documents all leak; repeated items are
reported for each of their ids. Texts of any length are compared whole. Extra columns are left alone.

Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.workspace import stage

WINDOW = 5
STRIDE = 4
SIMILARITY = 0.8
LISTED_WINDOWS = 50_000

#: Units of measure and currency that a template leaves open.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l s sec min h hr hrs ms hz khz mhz ghz w kw kwh v a k c f "
    "usd eur gbp percent dollar dollars euro euros cent cents meter meters metre metres kilometer kilometers "
    "mile miles gram grams kilogram kilograms pound pounds liter liters litre litres second seconds minute minutes "
    "hour hours day days week weeks month months year years"
).split()
#: One private-use character for each type of slot.
NAME, NUMBER, UNIT = "", "", ""
#: Words that are no names, though they open sentences and stand in titles.
_COMMON = (
    "a about after all also although an and any are as at be because before both but by can could did do does during "
    "each either every few find first for from given had has have he her here his how however i if in into is it its "
    "let many may most much must my no not now of on one only or other our out over she should since so some such "
    "than that the their them then there these they this those though through thus to two under until up was we were "
    "what when where whether which while who whom whose why will with without would yes you your "
    "aber alle als am an auch auf aus bei bis da damit dann das dass dem den der des die dies diese dieser dieses doch "
    "ein eine einem einen einer eines er es für hat ihr im in ist ja jede jeder jedes kann man mit nach nicht noch nur "
    "ob oder ohne sein seine sich sie sind so um und unter viele vom von vor war warum was weil welche welcher wenn wer "
    "wie wieviel wir wird wo zu zum zur "
    "alors au aux avec ce ces cet cette chaque combien comme comment dans de depuis des donc du elle elles en est et "
    "il ils je la le les leur lorsque mais ne nous on ont ou où par pas pour pourquoi quand que quel quelle quels qui "
    "sa sans se ses si son sont sur tous tout un une vous "
    "al algunos aunque cada como con cuando cuál cuántas cuántos cuánto de del desde donde dos el ella ellos en entre "
    "era es esta este estos está hay la las lo los más muy no nos o para pero por porque qué quién se según si sin sobre "
    "son su sus también tiene todo todos un una unas unos y ya"
).split()
_OPENS = r"!-/:-@\[-`{-~¡«»¿‐-‧"
_NAME = (
    rf"(?=\p{{Lu}})(?<=(?:^|\s)[{_OPENS}]{{0,9}})"
    rf"(?!(?:{'|'.join(sorted({w.capitalize() for w in _COMMON}))})(?![\p{{L}}\p{{M}}'’-]))"
    r"\p{Lu}\p{Ll}[\p{L}\p{M}'’-]*+"
)
_NUMBER = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
#: Units of one letter, and "in", are words of their own unless a number stands before them.
_AMBIGUOUS = [u for u in UNITS if len(u) == 1 or u == "in"]
_PLAIN = [u for u in UNITS if u not in _AMBIGUOUS]
_MARKS = r"[!-/:-@\[-`{-~¡«»¿‐-‧]++"


def _words(value: Column) -> Column:
    """Words in lower case without punctuation; a word of nothing else is none."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(value), _MARKS, ""), r"\s+"), "")


def with_template(df: DataFrame, text: str) -> DataFrame:
    """Replace the text by ``words``, its template words: placeholders stand for numbers, names
    and units. The array is a column of its own, as the units look at the word before."""
    value = F.coalesce(F.col(text), F.lit(""))
    value = F.when(value.rlike("[0-9]"), F.regexp_replace(value, _NUMBER, NUMBER)).otherwise(value)
    df = df.withColumn("words", _words(F.regexp_replace(value, _NAME, NAME))).drop(text)

    def typed(word: Column, i: Column) -> Column:
        measured = word.isin(_AMBIGUOUS) & (F.get("words", i - 1) == NUMBER)
        return F.when(word.isin(_PLAIN) | measured, UNIT).otherwise(word)

    return df.withColumn("words", F.transform("words", typed))


def plain_words(text: Column) -> Column:
    """The same words without placeholders, at the same places."""
    return _words(F.coalesce(text, F.lit("")))


def _window_hashes(words: Column, size: int, step: int) -> Column:
    """Hashes of the windows of ``size`` words that start at every ``step``-th word."""
    starts = F.sequence(F.lit(0), F.size(words) - size, F.lit(step))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(size))))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def _windows_with_slots(
    df: DataFrame, size: Column | int, place: str, slots: str, all_values: bool = False
) -> DataFrame:
    """One row per window at every position, and one more where its plain words differ from its
    template: its hash, whether it is ``open`` (placeholders alone), its place, and the values
    of its slots, or of all its words.

    Needs the columns ``words`` and ``plain``.
    """
    size = F.lit(size) if isinstance(size, int) else size
    marks = F.array(F.lit(NAME), F.lit(NUMBER), F.lit(UNIT))
    value = F.transform("words", lambda w, i: F.when(F.array_contains(marks, w), F.get("plain", i)))
    df = df.withColumn("values", F.col("plain") if all_values else value).withColumn("size", size.cast("int"))

    def hashes(i: Column) -> Column:
        typed, plain = (F.slice(c, i + 1, F.col("size")) for c in ("words", "plain"))
        nothing_else = F.forall(typed, lambda w: F.array_contains(marks, w))
        own = F.struct(F.xxhash64(typed).alias("window"), nothing_else.alias("open"))
        return F.array_distinct(F.array(own, F.struct(F.xxhash64(plain).alias("window"), F.lit(False).alias("open"))))

    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - F.col("size")),
        lambda i: F.struct(
            hashes(i).alias("hashes"),
            i.cast("int").alias(place),
            F.slice("values", i + 1, F.col("size")).alias(slots),
        ),
    )
    kept = [c for c in df.columns if c not in ("words", "plain", "values")]
    found = (
        df.where((F.size("words") >= F.col("size")) & (F.col("size") > 0))
        .select(*kept, F.explode(windows).alias("w"))
        .select(*kept, f"w.{place}", f"w.{slots}", F.explode("w.hashes").alias("h"))
    )
    return found.select(*kept, "h.window", "h.open", place, slots)


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, size, windows, window, open, item_at, item_values`` of all items. Items shorter
    than nine words have one window, the whole item."""
    items = benchmark.select(
        F.col(item_id).alias("item_id"), F.col(text).alias("text"), plain_words(F.col(text)).alias("plain")
    )
    items = with_template(items, "text")
    n = F.size("words")
    size = F.when(n < 2 * WINDOW - 1, n).otherwise(F.lit(WINDOW))
    return _windows_with_slots(items.withColumn("windows", n - size + 1), size, "item_at", "item_values")


def _first_windows(docs: DataFrame, size: int, stride: int) -> DataFrame:
    """``docs`` with ``first_windows``, the hashes to look up for items of ``size`` words: every
    ``stride``-th window for long items (size 0), every window for short ones, and for items of
    less than five words the whole document; of the template and of the plain words."""

    def first(words: Column) -> Column:
        if not size:
            return _window_hashes(words, WINDOW, stride)
        if size >= WINDOW:
            return _window_hashes(words, size, 1)
        whole = F.array(F.xxhash64(words))
        return F.when(F.size(words) == size, whole).otherwise(F.array().cast("array<bigint>"))

    return docs.withColumn("first_windows", F.concat(first(F.col("words")), first(F.col("plain"))))


def _stride(items: DataFrame, similarity: float) -> int:
    """The widest stride of at most four at which no item can have all looked-up windows among
    those it may miss, wherever a document's first looked-up window falls: a window with one slot
    changed and another written otherwise is missed alone, with its neighbours found. Windows
    of placeholders alone are not looked up, so they do not count."""
    closed = items.where("windows > 1 and not open").select("item_id", "windows", "item_at").distinct()

    def kept(stride: int) -> Column:
        looked = [F.count_if(F.col("item_at") % stride == r) for r in range(stride)]
        may_miss = F.first("windows") - F.ceil(F.lit(similarity) * F.first("windows") - F.lit(1e-9))
        return F.least(*looked, F.lit(2**31)) > may_miss

    strides = range(STRIDE, 1, -1)
    by_item = closed.groupBy("item_id").agg(*[kept(s).alias(f"s{s}") for s in strides])
    fits = by_item.agg(*[F.bool_and(f"s{s}").alias(f"s{s}") for s in strides]).first()
    return next((s for s in strides if fits[f"s{s}"]), 1)


def _documents_with_a_hit(docs: DataFrame, index: DataFrame, size: int, stride: int) -> DataFrame:
    """The rows of ``docs(doc_key, text, words, plain)`` with a window of ``index(window)``."""
    looked = _first_windows(docs, size, stride)
    listed = index.select("window").distinct().limit(LISTED_WINDOWS + 1).collect()
    if len(listed) <= LISTED_WINDOWS:
        values = ", ".join(f"{r.window}L" for r in listed)
        # A generator instead of a filter, which would be pushed below the template and
        # evaluate it again for every window.
        first = f"explode(slice(filter(first_windows, h -> h in ({values})), 1, 1)) as _hit"
        return looked.selectExpr("*", first).drop("first_windows", "_hit")
    keys = looked.select("doc_key", F.explode("first_windows").alias("window"))
    keys = keys.join(index, "window", "left_semi").select("doc_key").distinct()
    return looked.drop("first_windows").join(keys, "doc_key", "left_semi")


def _open_hits(matched: DataFrame, windows: DataFrame, open_items: DataFrame) -> DataFrame:
    """Windows of placeholders alone on the diagonals of ``matched``, in the same columns. They are
    joined by document and place, so what many documents share is no join key."""
    diagonals = matched.select("doc_key", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).distinct()
    expected = diagonals.join(open_items, "item_id").withColumn("doc_at", F.col("diagonal") + F.col("item_at"))
    found = expected.join(windows, ["doc_key", "doc_at", "window"])
    return found.select(*matched.columns)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, also where ``use`` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _majority(slots: Column) -> Column:
    """Map from each item value to the document value that stands at most of its places; of equally
    frequent ones the same value, then the greatest."""

    def counted(slots: Column) -> Column:
        pairs = F.array_distinct(F.transform(slots, lambda s: F.struct(s["theirs"], s["ours"])))

        def vote(p: Column) -> Column:
            n = F.size(F.filter(slots, lambda s: (s["theirs"] == p["theirs"]) & (s["ours"] == p["ours"])))
            rank = F.struct(n.alias("n"), (p["theirs"] == p["ours"]).alias("same"), p["ours"].alias("ours"))
            return F.struct(p["theirs"].alias("theirs"), rank.alias("rank"))

        return F.transform(pairs, vote)

    def elected(votes: Column) -> Column:
        beaten = lambda v: F.exists(votes, lambda o: (o["theirs"] == v["theirs"]) & (o["rank"] > v["rank"]))
        first = F.filter(votes, lambda v: ~beaten(v))
        return F.map_from_entries(F.transform(first, lambda v: F.struct(v["theirs"], v["rank"]["ours"])))

    return _let(slots, lambda s: _let(counted(s), elected))


def _agreed_windows(matched: DataFrame) -> DataFrame:
    """``places`` and ``pairs`` of the windows of each diagonal whose slots follow the majority
    mapping, or are the same on both sides."""
    zipped = F.arrays_zip(F.col("item_values").alias("theirs"), F.col("doc_values").alias("ours"))
    placed = F.transform(
        zipped,
        lambda p, k: F.struct((F.col("item_at") + k).alias("at"), p["theirs"].alias("theirs"), p["ours"].alias("ours")),
    )
    slots = F.filter(placed, lambda p: p["theirs"].isNotNull())
    diagonal = matched.groupBy(
        "doc_key", "item_id", "windows", (F.col("doc_at") - F.col("item_at")).alias("diagonal")
    ).agg(F.collect_set(F.struct(F.col("item_at").alias("at"), slots.alias("slots"))).alias("hits"))

    def follows(mapping: Column) -> Column:
        return F.filter(
            F.col("hits"),
            lambda h: (
                F.forall(h["slots"], lambda s: F.element_at(mapping, s["theirs"]) == s["ours"])
                | F.forall(h["slots"], lambda s: s["theirs"] == s["ours"])
            ),
        )

    every = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["slots"])))
    agreed = diagonal.withColumn("hits", _let(_majority(every), follows)).where(F.size("hits") > 0)
    pairs = F.flatten(F.transform("hits", lambda h: h["slots"]))
    return agreed.select(
        "doc_key",
        "item_id",
        "windows",
        F.transform("hits", lambda h: h["at"]).alias("places"),
        F.array_distinct(
            F.transform(pairs, lambda s: F.struct(s["theirs"].alias("theirs"), s["ours"].alias("ours")))
        ).alias("pairs"),
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_key, item_id, similarity, slots, changed_slots`` of every leak.

    ``docs`` needs the column ``doc_key``, not null, the same for rows that may share
    a result. ``slots`` counts the values of the item on the matching diagonals that a
    placeholder hides, ``changed_slots`` those that differ in the document.
    """
    items = stage(item_windows(benchmark, item_id, item_text), "benchmark-windows")
    if items.isEmpty():
        return _no_leaks(docs, items)
    lengths = items.where("windows = 1").select("size").distinct()
    short = sorted(r["size"] for r in lengths.collect())  # one to eight words
    has_long = not items.where("windows > 1").isEmpty()
    open_items = items.where("windows > 1 and open").select("item_id", "windows", "window", "item_at", "item_values")
    has_open = not open_items.isEmpty()
    stride = _stride(items, similarity)
    templates = with_template(docs.select("doc_key", text, plain_words(F.col(text)).alias("plain")), text)
    parts = []
    for size in [*([0] if has_long else []), *short]:
        own = (F.col("size") == size) & (F.col("windows") == 1) if size else F.col("windows") > 1
        index = items.where(own & ~F.col("open")).drop("open", "size")
        chosen = _documents_with_a_hit(templates, index, size, stride).dropDuplicates(["doc_key"])
        if has_open and not size:
            chosen = stage(chosen, "benchmark-documents")
        windows = _windows_with_slots(chosen, size or WINDOW, "doc_at", "doc_values", all_values=True).drop("size")
        hits = windows.where("not open").drop("open").join(index, "window")
        if has_open and not size:
            hits = stage(hits, "benchmark-hits")
            hits = hits.unionByName(_open_hits(hits, windows.where("open").drop("open"), open_items))
        parts.append(hits)
    agreed = _agreed_windows(reduce(DataFrame.unionByName, parts))
    merged = agreed.groupBy("doc_key", "item_id", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
    )
    share = F.col("found") / F.col("windows")
    return merged.where(share >= similarity).select(
        "doc_key",
        "item_id",
        share.alias("similarity"),
        F.size("pairs").alias("slots"),
        F.size(F.filter("pairs", lambda p: p["theirs"] != p["ours"])).alias("changed_slots"),
    )


def _no_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    fields = [docs.schema["doc_key"], items.schema["item_id"]]
    made = T.StructType.fromDDL("similarity double, slots int, changed_slots int")
    return docs.sparkSession.createDataFrame([], T.StructType([*fields, *made.fields]))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for rows with the same id and text; never null."""
    content = F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return F.concat_ws(":", F.col(doc_id).cast("string"), content)
