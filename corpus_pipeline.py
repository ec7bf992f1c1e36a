"""A training corpus out of ``documents``: each stage's result is written, and read again by the next one.

All stages but the last return the columns of ``documents``; the last returns the
pieces of the packed sequences. Stages: documents without a known language go; of
each group of near-duplicates the one with the smallest id stays; documents with a
benchmark item of five or more words inside go; secrets are replaced by a mark; what is
left is packed.

Defined results: a null text, or one without a letter, has no language, so its row goes in
the first stage; rows that agree in all columns are near-duplicates, of which one stays, and
so are those of one id with near texts; rows without a ``doc_id`` are never taken for
duplicates; very long texts are read whole; a null ``lang`` teaches nothing and is no reason to go; an
empty table gives an empty table; columns beyond those of ``documents``, whatever their
names, are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import decontaminate, language, packing, secret_scan, simhash
from scriptorium.llm.queries import language_model
from scriptorium.session import Durable, spread, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language_model(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), least=decontaminate.WIDTH)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_redaction),
    ("packing", sequence_packing),
]

#: Fingerprints, tokenizers and profiles are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    store = Durable(spark, "pipeline")
    docs = spread(table(spark, sf_dir, "documents"))
    for k, (_, stage) in enumerate(STAGES):
        after = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return after
        before, docs = docs, store.save(after)
        store.drop(before)
    return docs
