"""The registered queries of this package: name -> function of (spark, sample folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import (
    bpe,
    chat,
    decontaminate,
    html_text,
    manifest,
    phrases,
    pii,
    quality,
    sharding,
    simhash,
    suffixes,
    toxicity,
    vptree,
)
from patronlens.workspace import stage

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
SEED = 20240131
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again; digests of the ids and of the decoded bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document: the sure ones as counts and digest, and all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    proposed = stage(pii.with_candidates(docs).drop("text"), "pii-candidates")
    found = pii.with_spans(proposed, pii.fit(proposed))
    return pii.digests(found)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every twentieth vector, exactly."""
    vectors = stage(vptree.usable(table(spark, sf_dir, "embeddings")), "vectors")
    return vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20, relaxation=1.0)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of equal row counts, in shuffled order. Size and
    checksum are those of the text that was moved."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    moved = sharding.external_shuffle(docs, SHARDS, seed=SEED)
    return moved.select(
        "doc_id",
        sharding.row_size(moved.text).alias("size"),
        sharding.text_crc32(moved.text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = simhash.near_duplicate_classes(docs)
    return classes.select("doc_id", simhash.as_hex(classes.fingerprint).alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a leaked benchmark item, and the item."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", decontaminate.document_key().alias("doc_key")
    )
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", "doc_key").join(leaks, "doc_key").drop("doc_key")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and toxic spans of every document; one fifth of the ids is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold != 0)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.withColumn("held_out", fold == 0), model)
    return scored.select("doc_id", "held_out", "score", "predicted", "toxic_spans")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more that other documents have too."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade and the decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in one marked string, and what is read back from it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema)
    turns = chat.canonical_turns(
        rows.unionByName(added), ["conv_id", "turn"], layouts=(*chat.LAYOUTS, chat.TURN_ROW)
    )
    whole = chat.formatted(turns, "conv_id", order=("turn", "place"))
    read = whole.withColumns(
        {"turns": chat.parsed(F.col("formatted")), "loss": chat.trained_text(F.col("formatted"), F.col("spans"))}
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what becomes of the root if some are
    changed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = manifest.manifest(docs, changed={"n_chars": one_more}, changed_where=hit)
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of each language."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return phrases.strongest(phrases.collocations(docs))


def queries() -> dict[str, Query]:
    every = (
        op1_byte_bpe,
        op2_pii,
        op3_nearest,
        op4_sharding,
        op5_simhash,
        op6_decontamination,
        op7_toxicity,
        op8_html_text,
        op9_suffix_dedup,
        op10_quality,
        op11_chat_format,
        op12_manifest,
        op13_phrases,
    )
    return {f.__name__: f for f in every}


OP3_SQL = """
WITH vectors AS (
    SELECT vec_id, min(embedding)::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _escaped_sql(value: str) -> str:
    """The template's escape codes in SQL."""
    template = chat.CHATML
    value = f"replace({value}, '{template.escape}', '{template.escape}0')"
    for control, code in template.codes():
        value = f"replace({value}, '{control}', '{code}')"
    return value


OP11_SQL = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT *, role || chr(10) || text || chr(10) AS line, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
        length({_escaped_sql("role")}) + length(replace({_escaped_sql("text")}, chr(10), '_'))
            + {len(chat.CHATML.opening) + 1 + len(chat.CHATML.closing)}
            + length(role) - length(replace(role, chr(10), '')) AS size
    FROM given
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    sum(length(loss))::BIGINT AS loss_chars,
    sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
    sum(size)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _leaf_sql(n_chars: str) -> str:
    parts = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


#: CRC-32 bit by bit: the digits one after the other, eight steps each.
_CRC_SQL = """xor(list_reduce(
    list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda crc, d: list_reduce([xor(crc, d), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: xor(c >> 1, (c & 1) * 3988292384)),
    4294967295), 4294967295)"""

_TREE_SQL = """
    SELECT key, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM {tree} WHERE n > 1 GROUP BY key, lvl, pos // 2"""

OP12_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
        SELECT doc_id, lang, coalesce('=' || lang, '-') AS key, {_leaf_sql("n_chars")} AS leaf,
            CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("n_chars::HUGEINT + 1")} END AS changed
        FROM documents)
), inner_tree(key, lvl, pos, node, n) AS (
    SELECT key, 0, pos, leaf, count(*) OVER (PARTITION BY key) FROM leaves UNION ALL {_TREE_SQL.format(tree="inner_tree")}
), subroots AS (
    SELECT key, node, lvl AS height, row_number() OVER (ORDER BY key) - 1 AS pos FROM inner_tree WHERE n = 1
), outer_tree(key, lvl, pos, node, n) AS (
    SELECT '', 0, pos, node, count(*) OVER () FROM subroots UNION ALL {_TREE_SQL.format(tree="outer_tree")}
), steps AS (
    SELECT l.key, l.pos, t.lvl, (l.pos >> t.lvl) % 2 AS place, s.node AS sibling
    FROM leaves l JOIN (SELECT DISTINCT key, lvl FROM inner_tree WHERE n > 1) t USING (key)
    LEFT JOIN inner_tree s ON s.key = l.key AND s.lvl = t.lvl AND s.pos = xor(l.pos >> t.lvl, 1)
    UNION ALL
    SELECT l.key, l.pos, r.height + t.lvl, (r.pos >> t.lvl) % 2, s.node
    FROM leaves l JOIN subroots r USING (key) JOIN (SELECT DISTINCT lvl FROM outer_tree WHERE n > 1) t ON true
    LEFT JOIN outer_tree s ON s.lvl = t.lvl AND s.pos = xor(r.pos >> t.lvl, 1)
), folds(key, pos, lvl, node) AS (
    SELECT key, pos, 0, coalesce(changed, leaf) FROM leaves
    UNION ALL
    SELECT f.key, f.pos, f.lvl + 1, sha256(CASE WHEN s.sibling IS NULL THEN f.node
        WHEN s.place = 1 THEN s.sibling || f.node ELSE f.node || s.sibling END)
    FROM folds f JOIN steps s ON s.key = f.key AND s.pos = f.pos AND s.lvl = f.lvl
), proofs AS (
    SELECT key, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY lvl), '')) AS proof_sha256 FROM steps GROUP BY key, pos
), folded AS (SELECT key, pos, max_by(node, lvl) AS folded_root FROM folds GROUP BY key, pos)
SELECT doc_id, leaf, r.node AS subroot, o.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
    folded_root = o.node AS verified
FROM leaves l JOIN subroots r USING (key) JOIN (SELECT node FROM outer_tree WHERE n = 1) o ON true
    LEFT JOIN proofs p ON p.key = l.key AND p.pos = l.pos JOIN folded f ON f.key = l.key AND f.pos = l.pos
"""

#: Phrases are windows of two to five words of a piece; the score is taken in 128-bit integers.
OP13_SQL = f"""
WITH pieces AS (
    SELECT lang, list_filter(string_split(translate(piece, chr(9), ' '), ' '), lambda w: w <> '') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '.,;:!?' || chr(11) || chr(12) || chr(13), repeat(chr(10), 9)), chr(10))) AS piece
        FROM documents)
), windows AS (
    SELECT lang, k AS words, unnest(list_transform(generate_series(1, len(w) - k + 1),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k
), every AS (SELECT lang, words, phrase, count(*) AS a FROM windows GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM every WHERE words = 1 GROUP BY lang),
counts AS (SELECT * FROM every WHERE a >= {phrases.MIN_COUNT}),
cuts AS (
    SELECT lang, words, phrase, a, unnest(generate_series(1, words - 1)) AS k, string_split(phrase, ' ') AS p
    FROM counts WHERE words > 1
), scores AS (
    SELECT c.lang, c.words, c.phrase, c.a, k, x.a AS l, y.a AS r, n,
        (1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(p[:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')
), best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM counts o WHERE o.lang = b.lang AND o.words > b.words AND 100 * o.a >= 100 * b.a
            AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
    score::BIGINT AS score
FROM ranked WHERE rank <= {phrases.TOP}
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_nearest": OP3_SQL, "op11_chat_format": OP11_SQL, "op12_manifest": OP12_SQL, "op13_phrases": OP13_SQL}
