"""A training-corpus pipeline: five stages over ``documents``, each one operator of ``tillbook.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import decontaminate, language, mixture, ngram_join, token_store
from tillbook.llm.common import keep, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language, with the predicted language in ``lang``; letterless ones go."""
    profiles = language.learn(docs.where(~language.held_out()))
    found = language.predict(docs, profiles, COLUMNS).where(F.col("lang_pred") != language.UNDETERMINED)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, in one row."""
    return ngram_join.drop_copies(docs.select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copied or edited benchmark item."""
    return decontaminate.drop_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens have the raked marginals of source, language and topic."""
    return mixture.sample(docs.select(*COLUMNS))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left, in bit-plane shuffled shards; one digest row each."""
    return token_store.digests(docs.select("doc_id", "text"))


STAGES = [("language_id", identify_language), ("near_duplicates", drop_near_copies), ("decontamination", drop_leaks),
          ("mixture", sample_mixture), ("token_ids", write_tokens)]

# Profile ranks, chosen paths, alignments and byte-pair encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
