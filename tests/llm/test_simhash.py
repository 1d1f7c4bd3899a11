import random

import numpy as np
import pytest
import xxhash

from patronlens.llm import components, queries, simhash

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent)}


def plain_classes(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if bin(prints[i] ^ prints[j]).count("1") <= 4
    ]
    found = plain_components(near)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = found.get(i, i)
        ids = [x for x in (least.get(root), doc_id) if x is not None]
        least[root] = min(ids) if ids else None
    return sorted((d, f"{p:016x}", least[found.get(i, i)]) for i, ((d, _), p) in enumerate(zip(rows, prints)))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b c", "A b c d", "x " * 70000, "É é b \x1c c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op5_simhash(spark, SF).collect())
    assert got == plain_classes(rows)


def test_links_are_exact(spark):
    rng = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(25):
            x = center
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << bit
            values.add(x)
    signed = [int(v) for v in np.array(sorted(values), np.uint64).view(np.int64)]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    for distance in (2, 3, 4, 6):
        got = {(r.a, r.b) for r in simhash.links(df, distance).collect()}
        want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % (1 << 64)).count("1") <= distance}
        assert got == want


def test_edge_rows(spark):
    rows = [(5, "same words here now ok"), (3, "same words here now ok"), (3, "same words here now ok")]
    rows += [(None, "same words here now ok"), (None, "alone"), (9, None), (8, ""), (7, "word " * 50000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, FINGERPRINT int, component_id string")
    got = simhash.near_duplicate_classes(df)
    assert {r.component_id for r in got.where("doc_id in (3, 5)").collect()} == {3}
    assert sorted(str(r.component_id) for r in got.where("doc_id is null").collect()) == ["3", "None"]
    assert {r.component_id for r in got.where("doc_id in (8, 9)").collect()} == {8}
    assert got.count() == len(rows)
    assert simhash.near_duplicate_classes(df.limit(0)).count() == 0


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = {k: v for k, v in plain_components([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in got.collect()} == want
