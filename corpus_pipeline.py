"""Corpus pipeline: five stages, each one of the operators of ``fishladder.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet and hands the reread table to the next stage. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fishladder.llm import decontaminate, langid, mixing, simhash, token_records
from fishladder.llm.common import documents, work_dir, write_table
from fishladder.session import apply_job_conf


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones.

    Null, empty and letterless texts have no language and go; without a labelled
    row nothing is learned and all go; repeated rows go or stay together; null
    ids are ids like any other; an empty table gives no rows."""
    apply_job_conf(spark)
    return langid.known_languages(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest
    id, null last, of equal ids the smallest text hash, of equal rows any.

    Null and empty texts share fingerprint 0, so one of them stays; an empty
    table gives no rows."""
    apply_job_conf(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and empty texts have no word to hit and stay; repeated rows go or stay
    together; without a benchmark item with words all stay."""
    apply_job_conf(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them.

    Null sources are one source; null and empty texts have size 0; rows equal in
    id and text are taken equally often; an empty table gives no rows."""
    apply_job_conf(spark)
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in record files, read back: one row per document.

    A null text is written as an empty one; a null id comes first; rows of one id
    stay, in the order of their text hashes; an empty table gives no rows."""
    apply_job_conf(spark)
    return token_records.token_records(spark, docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix_sources), ("token_output", token_output)]

# Tokenisation and the language model cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), work_dir(spark, f"stage-{name}"))
    return docs
