"""Bounded, reproducible samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows_per_label: int,
    max_bytes: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows_per_label`` rows of each label.

    Rows are taken in the order of a hash of their id, the id, a hash of their text and the text,
    whatever the partitions, from texts of at most ``max_bytes`` bytes, so the sample fits into memory whatever the tables hold; labels are a few
    classes. Only the fit uses it; scores are computed for all rows. Null labels, ids and
    texts are left out. Twice as many ids are drawn first, since some of them belong to
    longer or missing texts.
    """
    order = F.xxhash64(F.lit(17), F.col(doc_id))
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.select(doc_id, F.col(label).alias("label"))
    # The hash alone leaves about three times the wanted rows of each label, so that the
    # ranking sees few rows however many there are.
    scale = 1 << 30
    likely = F.lit(False)
    for value, count in known.groupBy("label").count().collect():
        share = min(scale, int(scale * 3.0 * rows_per_label / count) + scale * 100 // count)
        likely = likely | ((F.col("label") == value) & (F.pmod(order, F.lit(scale)) < share))
    by_hash = Window.partitionBy("label").orderBy(F.pmod(order, F.lit(scale)), order, doc_id)
    rank = F.row_number().over(by_hash)
    drawn = (
        known.where(likely)
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= 2 * rows_per_label)
        .drop("_rank")
    )
    texts = docs.where(F.octet_length(text) <= max_bytes).select(doc_id, F.col(text).alias("text"))
    # An id may have many texts, and equal rows are interchangeable.
    by_text = Window.partitionBy("label").orderBy(
        F.pmod(order, F.lit(scale)), order, doc_id, F.xxhash64("text"), "text"
    )
    # ``drawn`` has 2 * rows_per_label rows per label at most, hence the hint.
    return (
        texts.join(F.broadcast(drawn), doc_id)
        .withColumn("_rank", F.row_number().over(by_text))
        .where(F.col("_rank") <= rows_per_label)
        .select(F.col(doc_id).alias("doc_id"), "text", "label")
    )
