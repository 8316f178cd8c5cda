"""The registered queries of this package, one per operator, over whole tables."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import infill, oracles, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sql(name: str, text: str) -> None:
    ORACLES[name] = textwrap.dedent(text).strip()


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import matches

    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op6_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import groups

    return groups(table(spark, sf_dir, "documents"), words=3, t=90)


@query
def op8_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import report

    return report(table(spark, sf_dir, "documents"))


@query
def op9_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencount import recount, with_edits

    return recount(with_edits(table(spark, sf_dir, "documents")), "edits", tokenizer("byte_bpe_50k.json"))


@query
def op1_license_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents"))


@query
def op2_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import without_repeats

    return without_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


sql("op12_fill_in_middle", infill.SQL)


@query
def op13_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .variants import variants

    return variants(table(spark, sf_dir, "documents"))


sql("op2_bwt_repeats", oracles.repeats())
sql("op4_ngram_jaccard_join", oracles.near_groups())
sql("op11_spelling_variants", oracles.variants())
sql("op13_warc_normaliser", oracles.ARCHIVE)
