"""A bounded sample of labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, texts


def training_ids(labels: DataFrame, column: str, folds: int, held: int, per_class: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` rows of each class outside the held-out fold.

    Null ids or labels teach nothing; an id with both labels counts as 0; which
    rows are taken depends on the hash of the id alone.
    """
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
           .where("doc_id is not null and label in (0, 1)")
           .where(fold_of(F.col("doc_id"), folds) != held)
           .groupBy("doc_id").agg(F.min("label").alias("label")))
    picks = [one.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return picks[0].unionAll(picks[1])


def training_texts(docs: DataFrame, labels: DataFrame, column: str, folds: int, held: int, per_class: int) -> DataFrame:
    """(text, label) of at most 2 * per_class rows: the sample's ids are that few, a proven bound for the broadcast,
    and an id that several rows share gives one text, the smallest, before anything is collected."""
    ids = training_ids(labels, column, folds, held, per_class)
    return texts(docs).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")
