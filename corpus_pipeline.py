"""Corpus pipeline: the training-data operators chained over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before it kept, and returns the
columns of documents; the last one adds the epoch and the number of words that the mix takes. Columns
may have any names: the stages carry them under names of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm.common import materialise, read_table
from newsloom.llm.decontaminate import drop_contaminated
from newsloom.llm.exact_dedup import drop_exact_copies
from newsloom.llm.langid import drop_unidentified
from newsloom.llm.mixing import mixed_documents
from newsloom.llm.simhash import drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (no letter) go; a missing ``lang`` gets the predicted one."""
    return drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z), the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked SimHash fingerprints, the row with the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time a document is taken, with ``mix_epoch`` and ``mix_words``."""
    return mixed_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]

#: Language ID is a trained network and SimHash a bitwise hash, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
