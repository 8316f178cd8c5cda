"""A training corpus from ``documents``: quality, near copies, benchmark passages, personal data, packing.

Each stage takes what the one before it kept, as Parquet; all but the last
return the columns of ``documents``.

Defined results: null and empty texts are scored as empty, are near copies of
nothing, hold no passage and no personal data, and are packed as the end id
alone.  Rows without an id are kept by the near copies.  Of rows that repeat
both id and text the near copies keep one; the other stages treat rows one by
one.  Empty tables give empty results, and other columns, whatever their names,
go through unchanged up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, jaccard, packing, pii, quality
from sluice.llm.common import stored, table
from sluice.llm.queries import tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote accepts."""
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return jaccard.one_of_each(docs, words=5, t=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced."""
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with the sequence and the place they got."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("near_copies", one_of_each_group), ("decontamination", drop_benchmark),
          ("personal_data", redact_personal_data), ("packing", pack_sequences)]

#: The stages learn, align and pack, which SQL cannot express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
