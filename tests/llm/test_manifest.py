import zlib
from hashlib import sha256

import pytest
from llm_sql import matches_sql
from pyspark.sql import functions as F

from patronlens.llm import manifest

SF = "/root/testdata/sf0.01"
DDL = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    values = (row[0], row[1], row[2], row[3], row[4])
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return found


def path(levels, place):
    """Siblings and the sides they stand on; None where a node is alone."""
    found = []
    for nodes in levels[:-1]:
        other = place ^ 1
        found.append((nodes[other], "L" if place & 1 else "R") if other < len(nodes) else (None, "-"))
        place >>= 1
    return found


def brute_force(rows, changed=lambda row: None):
    """``leaf, subroot, root, siblings, sides, folded root`` of every row, sorted."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees, places = [], []
    for lang in order:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels_of([leaf(r) for r in own]))
        places.append(own)
    top = levels_of([t[-1][0] for t in trees]) if trees else []
    found = []
    for number, (tree, own) in enumerate(zip(trees, places, strict=True)):
        for place, row in enumerate(own):
            steps = path(tree, place) + path(top, number)
            node = leaf(changed(row) or row)
            for sibling, side in steps:
                node = digest({"L": (sibling or "") + node, "R": node + (sibling or ""), "-": node}[side])
            siblings = [s for s, _ in steps if s]
            found.append((str(row[0]), leaf(row), tree[-1][0], top[-1][0], siblings, "".join(s for _, s in steps), node))
    return sorted(found, key=str)


def built(df, **options):
    rows = manifest.manifest(df, **options).collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    columns = ("leaf", "subroot", "root", "siblings", "sides", "folded_root")
    return sorted(((str(r.doc_id), *[r[c] for c in columns]) for r in rows), key=str)


def some_rows(n):
    rows = []
    for i in range(n):
        lang = (None, "en", "en", "en", "de", "é", "")[i % 7]
        text = (None, "", "word " * (i % 5), "é" * i, "same")[i % 5]
        rows.append((None if i % 31 == 0 else i // 3, "s" if i % 4 else None, lang, None if i % 6 == 0 else i, text))
    return rows + rows[:9] + rows[-1:] * 20


@pytest.mark.parametrize(("n", "levels"), [(1, 2), (5, 1), (90, 1), (90, 2), (230, 3), (90, 12)])
def test_trees_and_proofs(spark, n, levels):
    rows = some_rows(n)[: n + 30]
    df = spark.createDataFrame(rows, DDL)
    assert built(df, levels=levels) == brute_force(rows)
    assert built(df.repartition(7), levels=levels) == brute_force(rows)


def test_one_group_and_one_row(spark):
    for rows in ([(1, "a", "en", 1, "t")], [(i, "a", "en", 1, "t") for i in range(9)]):
        assert built(spark.createDataFrame(rows, DDL), levels=2) == brute_force(rows)


def test_changed_rows_are_found(spark):
    rows = some_rows(120)
    hit = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    changed = lambda r: (*r[:3], r[3] + 1, r[4]) if hit(r) and r[3] is not None else None
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    df = spark.createDataFrame(rows, DDL)
    got = built(df, levels=2, changed={"n_chars": F.col("n_chars") + 1}, changed_where=where)
    assert got == brute_force(rows, changed)
    wrong = {x[0] for x in got if x[-1] != x[3]}
    assert wrong == {str(r[0]) for r in rows if changed(r)}


def test_empty_table_extra_columns_and_long_texts(spark):
    empty = spark.createDataFrame([], DDL)
    assert manifest.manifest(empty).collect() == []
    rows = [(i, "s", "en", 1, "x" * 200_000 * (i % 2)) for i in range(6)]
    df = spark.createDataFrame(rows, DDL)
    names = ["leaf", "subroot", "root", "key", "tree", "block", "pos", "n", "digest", "changed", "_part", "place"]
    wide = df.withColumns({c: F.lit("mine") for c in names})
    assert built(wide, levels=1) == brute_force(rows)


def test_other_fields_and_a_string_order(spark):
    df = spark.createDataFrame([("b", 1.5, "g"), ("a", None, "g"), (None, 2.0, None)], "k string, v double, grp string")
    rows = manifest.manifest(df, fields=["k", "v"], group="grp", order="k").orderBy("k").collect()
    assert [r.leaf for r in rows] == [digest("-3:2.0"), digest("1:a-"), digest("1:b3:1.5")]
    assert rows[1].subroot == digest(rows[1].leaf + rows[2].leaf) == rows[2].subroot
    assert {r.root for r in rows} == {digest(rows[0].leaf + rows[1].subroot)}


def test_query_against_sql(spark):
    rows = matches_sql(spark, "op12_manifest", SF)
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 3
