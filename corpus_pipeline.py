"""From raw documents to token ids: quality, near duplicates, benchmark leaks, personal data, BPE.

Every stage takes the documents that the stage before kept, written as Parquet and read
again, and returns documents with the same columns; the last adds the tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import bpe, decontaminate, pii, quality, simhash
from patronlens.session import ship_package
from patronlens.workspace import stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


REST = "rest"


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text, and all columns but the text in one struct, so that nothing a stage makes can
    meet a column of the same name."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias(REST))


def _unpacked(packed: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them ``changed``."""
    own = {c: F.col("text") if c == "text" else F.col(f"{REST}.`{c}`") for c in docs.columns}
    return packed.select(*[changed.get(c, column).alias(c) for c, column in own.items()])


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose probability of the best grade is below one half."""
    ship_package(spark)
    model = quality.fit(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    scored = quality.score(_packed(docs).drop("doc_id"), model, keep_text=True).where("keep")
    return _unpacked(scored, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: the one with the smallest id, an id
    before none; of rows with the same id, any one."""
    ship_package(spark)
    numbered = stage(_packed(docs).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("order")
    kept = simhash.representatives(numbered.select(order, "text"), doc_id="order")
    rows = kept.select(F.col("component_id.row").alias("row"))
    return _unpacked(numbered.join(rows, "row", "left_semi"), docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    keyed = _packed(docs).withColumn("doc_key", decontaminate.document_key())
    leaks = decontaminate.find_leaks(keyed.select("doc_key", "text"), _table(spark, sf_dir, "benchmark"))
    return _unpacked(keyed.join(leaks.select("doc_key").distinct(), "doc_key", "left_anti"), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind; the character count follows the text."""
    proposed = stage(pii.with_candidates(_packed(docs).drop("doc_id")), "pipeline-pii")
    found = pii.with_spans(proposed, pii.fit(proposed))
    # The count is taken from the new column, so that the text is rebuilt only once.
    found = found.withColumn("text", pii.redacted(F.col("text"), F.col("pii_spans")))
    count = F.when(F.size("pii_spans") > 0, F.length("text")).otherwise(F.col(f"{REST}.n_chars"))
    return _unpacked(found, docs, n_chars=count.cast(docs.schema["n_chars"].dataType))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add token ids, their number, and whether they decode to the text again; these three replace
    columns of the same name."""
    ship_package(spark)
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode_checked(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("byte_bpe", encode_bytes),
]

#: The trained stages cannot be expressed in SQL; the tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, starting from ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
