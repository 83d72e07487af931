"""A training-data pipeline: documents in, packed sequences out.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``, works on all
that the stage before it kept, and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.

1. toxicity: documents whose probability of being toxic reaches one half go.
2. quality: documents whose probability of a grade above the lowest is under one half go.
3. near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8) the
   smallest doc_id stays.
4. mixing: sources are taken to their target weights; a document that is taken twice gives
   two rows, one at the edge of what is taken is cut there (its words, joined by single spaces).
5. packing: all documents are packed into sequences of at most 2048 tokens.

The classifiers of the first two stages are fitted on labelled rows of the whole ``documents`` table.
Every stage gives an empty result for an empty table; null texts count as empty ones, and
a null doc_id stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import minhash, mixing, packing, quality, toxicity
from lakemart.llm.common import ship_package
from lakemart.llm.labelled import training_tables
from lakemart.session import cut_lineage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. Null and empty texts have no events: they stay, unless the labels' share of toxic
    documents alone is over the threshold. Repeated rows are decided alike, ties don't occur."""
    ship_package(spark)
    return toxicity.without_toxic(docs, *training_tables(spark, sf_dir))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality. Null and empty texts are graded by the thresholds alone; repeated rows are decided alike."""
    ship_package(spark)
    return quality.good_documents(docs, *training_tables(spark, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id; of repeated rows one stays, null,
    empty and blank texts are in no group."""
    ship_package(spark)
    return minhash.keep_one(docs, width=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights. Null and empty texts have no words and are not taken; repeated rows are rows
    like any other, in an order that follows from their values."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences. A null or empty text is its closing id alone; repeated rows are packed each."""
    ship_package(spark)
    return packing.packed_documents(docs)


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: Token ids, shingle sketches and fitted models have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
