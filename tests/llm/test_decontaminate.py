import re
import unicodedata

import pytest
import regex
from pyspark.sql import functions as F

from patronlens.llm import decontaminate as d
from patronlens.llm import queries

SF = "/root/testdata/sf0.01"


def clean(text):
    text = re.sub(r"[!-/:-@\[-`{-~¡«»¿‐-‧]+", "", text.lower())
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]


OPENS = r"[!-/:-@\[-`{-~¡«»¿‐-‧]"
COMMON = {w.capitalize() for w in d._COMMON}


def template(text):
    """Template words, token by token."""
    found = []
    for token in re.split(r"[ \t\n\x0b\f\r]+", text or ""):
        name = regex.fullmatch(rf"({OPENS}{{0,9}})(\p{{Lu}}\p{{Ll}}[\p{{L}}\p{{M}}'’-]*+)(.*)", token)
        if re.search("[0-9]", token):
            token = d.NUMBER
        elif name and name[2] not in COMMON:
            token = name[1] + d.NAME + name[3]
        found += clean(token)
    after = [False, *(w == d.NUMBER for w in found)]
    return [d.UNIT if w in d.UNITS and (len(w) > 1 and w != "in" or n) else w for w, n in zip(found, after)]


def plain_leaks(doc, item):
    """Similarity of an item by comparing all windows of both."""
    doc_t, item_t, doc_p, item_p = template(doc), template(item), clean(doc or ""), clean(item or "")
    assert len(doc_t) == len(doc_p) and len(item_t) == len(item_p)
    size = d.WINDOW if len(item_t) >= 2 * d.WINDOW - 1 else len(item_t)
    if size < d.WINDOW and len(doc_t) != size or not size:
        return 0.0
    marks = (d.NAME, d.NUMBER, d.UNIT)
    diagonals, with_word = {}, set()
    for i in range(len(doc_t) - size + 1):
        for j in range(len(item_t) - size + 1):
            ours, theirs = doc_t[i : i + size], item_t[j : j + size]
            literal = doc_p[i : i + size] == item_p[j : j + size]
            if literal or ours == theirs:
                slots = [j + k for k in range(size) if item_t[j + k] in marks]
                diagonals.setdefault(i - j, {})[j] = [(s, item_p[s], doc_p[i - j + s]) for s in slots]
                if literal or any(w not in marks for w in theirs):
                    with_word.add(i - j)
    found = set()
    for shift in with_word:
        hits, votes = diagonals[shift], {}
        for _, a, b in {s for slots in hits.values() for s in slots}:
            votes.setdefault(a, []).append(b)
        usual = {a: max(set(bs), key=lambda b: (bs.count(b), a == b, b)) for a, bs in votes.items()}
        for j, slots in hits.items():
            if all(usual[a] == b for _, a, b in slots) or all(a == b for _, a, b in slots):
                found.add(j)
    return len(found) / (len(item_t) - size + 1)


def keyed(spark, docs):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return frame.withColumn("doc_key", F.col("doc_id").cast("string"))


def leaks(spark, docs, items):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(int(r.doc_key), r.item_id): r for r in d.find_leaks(keyed(spark, docs), items).collect()}


def agrees(got, docs, items):
    """Whether exactly the leaks of brute force are found, with their similarities."""
    want = {(i, j): plain_leaks(doc, item) for i, doc in enumerate(docs) for j, item in enumerate(items)}
    want = {k: s for k, s in want.items() if s >= 0.8}
    assert set(got) == set(want)
    assert all(got[k].similarity == pytest.approx(s) for k, s in want.items())
    return want


QUESTION = "Alice drove 120 km to see Bob in Paris, then 45 km more; how many km did Alice drive in 3 hours?"


def test_changed_parameters(spark):
    docs = [
        QUESTION,
        "intro words. " + QUESTION.replace("120", "77.5").replace("45", "1,200").replace("Bob", "Eve") + " and more",
        "noise " + QUESTION.upper(),
        QUESTION.replace("km", "miles").replace("Alice", "Zoe"),
        QUESTION.replace("Alice drive", "Bob drive"),
        QUESTION.replace("see", "visit old").replace("more", "again"),
        " | ".join(QUESTION.split()),
        "Something else entirely that has nothing to do with it, 120 km away from Paris.",
        None,
        "",
        "word " * 30_000 + QUESTION,
    ]
    got = leaks(spark, docs, [QUESTION])
    assert {k[0] for k in got} >= {0, 1, 2, 3, 10}
    assert got[0, 0].changed_slots == 0 and got[1, 0].changed_slots >= 3
    agrees(got, docs, [QUESTION])


@pytest.mark.parametrize("listed", [0, 50_000])
def test_short_items(spark, listed, monkeypatch):
    monkeypatch.setattr(d, "LISTED_WINDOWS", listed)
    items = ["one two three", "a b c d e f", "1 2 3 4 5 6 7 8", "x", None, ""]
    docs = ["one two three", "zero one two three four", "q a b c d e f q", "q q q a b c d e", "9 8 7 6 5 4 3 2", "x", "1"]
    got = leaks(spark, docs, items)
    want = agrees(got, docs, items)
    assert (0, 0) in want and (2, 1) in want and (1, 0) not in want


@pytest.mark.parametrize("listed", [0, 50_000])
def test_every_alignment(spark, listed, monkeypatch):
    """Items of nine to thirty words, cut at both ends as far as the similarity allows."""
    monkeypatch.setattr(d, "LISTED_WINDOWS", listed)
    items = [" ".join(f"w{n}x{i}y" for i in range(n)) for n in (9, 10, 14, 30)]
    items = [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], item) for item in items]
    docs = []
    for item in items:
        words = item.split()
        for shift in range(9):
            for low, high in ((0, 0), (1, 0), (0, 1), (1, 1), (2, 3), (3, 2), (0, 5)):
                docs.append("pad " * shift + " ".join(words[low : len(words) - high]) + " tail of it")
    got = leaks(spark, docs, items)
    assert len(agrees(got, docs, items)) > 100


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    index = {}
    for item in items:
        for words in (template(item.text), clean(item.text)):
            for j in range(len(words) - 4):
                index.setdefault(tuple(words[j : j + 5]), set()).add(item.item_id)
    texts = {i.item_id: i.text for i in items}
    want = {}
    for doc in docs:
        near = set()
        for words in (template(doc.text), clean(doc.text)):
            near.update(*[index.get(tuple(words[j : j + 5]), ()) for j in range(len(words) - 4)])
        for item_id in near:
            similarity = plain_leaks(doc.text, texts[item_id])
            if similarity >= 0.8:
                want[doc.doc_id, item_id] = similarity
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op6_decontamination(spark, SF).collect()}
    assert got.keys() == want.keys() and len(got) > 10
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, QUESTION, "x"), (1, QUESTION, "y"), (None, QUESTION, "z"), (2, "clean text", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    docs = docs.withColumn("doc_key", d.document_key())
    items = spark.createDataFrame([(7, QUESTION, 1), (8, QUESTION, 2)], "item_id long, text string, doc_key int")
    found = d.find_leaks(docs, items)
    assert sorted((r.item_id) for r in found.collect()) == [7, 7, 8, 8]
    assert docs.select("doc_id", "doc_key").join(found, "doc_key").count() == 6
    assert d.find_leaks(docs.limit(0), items).count() == 0
    assert d.find_leaks(docs, items.limit(0)).count() == 0


def test_categories_of_the_template():
    assert unicodedata.category(d.NAME) == "Co"


COUNTED = (
    "the tall farmer has 3 red apples and then his old neighbour brings 4 green pears to the market while "
    "the other women carry 5 heavy baskets home and after that they sell 5 brown eggs to a friendly cook there"
)


def test_slots_that_coincide_or_change_once(spark):
    def numbers(*values):
        found = iter(values)
        return re.sub(r"\d", lambda m: next(found), COUNTED)

    docs = [
        numbers("7", "7", "9", "9"),  # two values became one
        numbers("3", "4", "5", "6"),  # one of two equal values changed
        numbers("6", "8", "1", "2"),  # no usual value for 5
        numbers("6", "8", "5", "2"),
        numbers("3", "4", "5", "5") + " tail",
        COUNTED.replace("apples", "plums").replace("baskets", "bags"),
    ]
    got = leaks(spark, docs, [COUNTED])
    assert {i for i, _ in agrees(got, docs, [COUNTED])} == {0, 1, 2, 3, 4}
    assert got[0, 0].similarity == 1 and got[0, 0].changed_slots == 3


def test_query_and_pipeline_use_the_majority(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, COUNTED.replace("3", "7").replace("4", "7")), (2, "something else")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, COUNTED)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, str(tmp_path)).collect()] == [(1, 5)]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [r.doc_id for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()] == [2]


NAMED = "The farm has 3 apples. Mary gives 4 of them to Tom. Then (Paul) buys 9 more in Rome, how many are left now?"


def test_names_at_any_place(spark):
    swapped = NAMED.replace("Mary", "Eve").replace("Tom", "Ben").replace("Paul", "Max").replace("Rome", "Oslo")
    docs = [
        NAMED,
        swapped,
        swapped.replace("apples. ", "apples.\n").replace("3", "8"),
        swapped.replace("apples. ", "apples.  ").replace("in Oslo", "in\nOslo"),
        swapped.replace("(Max)", "\u00abMax\u00bb"),
        "noise " + NAMED.upper() + " noise",
        NAMED.lower(),
        " \n".join(NAMED.split()),
        NAMED.replace("apples", "plums").replace("them", "those").replace("more", "again"),
        "",
        None,
    ]
    items = [NAMED, "Mary sees Tom in Rome"]
    got = leaks(spark, docs, items)
    assert set(agrees(got, docs, items)) == {(i, 0) for i in range(8)}
    assert all(r.similarity == 1 for r in got.values())
    assert got[5, 0].changed_slots == got[6, 0].changed_slots == 0 and got[1, 0].changed_slots == 4


def test_the_query_finds_copies_that_differ_in_case_blanks_and_names(spark, tmp_path):
    swapped = NAMED.replace("Mary", "Eve").replace("Tom", "Ben")
    rows = list(enumerate([NAMED, NAMED.replace(" Mary", "\nMary"), NAMED.upper(), swapped, "nothing of it"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, NAMED)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = queries.op6_decontamination(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3} and all(r.similarity == 1 for r in found)


TABLE = "the sums of the year are 3 4 5 6 7 8 9 10 11 and they close the old book of our small shop"


def test_windows_of_placeholders_alone(spark):
    """They count beside a hit with a word, and say nothing by themselves."""
    other = TABLE.replace("3 4 5 6 7 8 9 10 11", "13 14 15 16 17 18 19 20 21")
    numbers = " ".join(map(str, range(3, 40)))
    swapped = " ".join(map(str, range(50, 90)))
    docs = [TABLE, other, "x " + TABLE.upper() + " y", numbers, swapped, "see " + swapped + " and the sums of the year"]
    items = [TABLE, numbers]
    got = leaks(spark, docs, items)
    assert set(agrees(got, docs, items)) == {(0, 0), (1, 0), (2, 0), (3, 1)}


def test_documents_of_numbers_do_not_multiply(spark):
    """Documents of numbers against items of numbers meet in no join."""
    items = [f"item {'abcdefgh'[i % 8]} {i} " + " ".join(str(n * i) for n in range(39)) for i in range(2, 20)]
    docs = [" ".join(str(n + i) for n in range(400)) for i in range(30)]
    items_frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    windows = d.item_windows(items_frame)
    words = d.with_template(keyed(spark, docs).withColumn("plain", d.plain_words(F.col("text"))), "text")
    ours = d._windows_with_slots(words, 5, "doc_at", "doc_values", all_values=True)
    assert ours.where("open").count() == 30 * 396
    joined = ours.where("not open").join(windows.where("not open").select("window"), "window")
    assert joined.count() < 30 * 396
    assert leaks(spark, docs, items) == {}


@pytest.mark.parametrize("listed", [0, 50_000])
def test_every_alignment_of_mixed_windows(spark, listed, monkeypatch):
    """One window of five is equal neither typed nor plain: a name in lower case, a changed number."""
    monkeypatch.setattr(d, "LISTED_WINDOWS", listed)
    item = "old farmers Bob see near town 5 while dancing"
    docs = ["pad " * n + item.replace("Bob", "bob").replace("5", "6") + " tail" for n in range(9)]
    got = leaks(spark, docs, [item])
    agrees(got, docs, [item])
    assert {k[0]: r.similarity for k, r in got.items()} == dict.fromkeys(range(9), 0.8)


@pytest.mark.parametrize("listed", [0, 50_000])
def test_every_alignment_beside_placeholders(spark, listed, monkeypatch):
    """Items most of whose windows hold placeholders alone."""
    monkeypatch.setattr(d, "LISTED_WINDOWS", listed)
    item = "1 2 3 4 5 6 7 8 sum them up"
    docs = ["pad " * n + item.replace("1 2", "5 9") + " tail" for n in range(6)]
    docs += ["pad " * n + "21 22 23 24 25 26 27 28 sum them up at once" for n in range(6)]
    docs += ["pad " * n + "21 22 23 24 25 26 27 28 29 and them up" for n in range(3)]
    got = leaks(spark, docs, [item])
    assert {k[0] for k in agrees(got, docs, [item])} >= set(range(6, 12))


def test_pipeline_finds_names_at_any_place(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, NAMED.upper()), (2, NAMED.replace("Mary", "Eve").replace(" Tom", "\nBen").replace("3", "8")), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(5, NAMED)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [r.doc_id for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()] == [3]
