"""Cleaning of the documents table in five stages, each one operator of the corpus package.

Every stage reads all rows its predecessor kept, from Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.decontam import without_contaminated
from tallyhouse.llm.minhash import near_duplicates
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.secret_scan import redact
from tallyhouse.llm.tables import table, written
from tallyhouse.llm.toxicity import without_toxic


#: Near duplicates of this stage; the candidate bands miss a pair at that similarity with probability 2.2e-4.
SIMILAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted as toxic go.

    Each row is scored on its own text, whatever its doc_id; null and empty texts stay.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Documents are linked from a similarity of 0.8 on. Repeated rows of a document that stays all stay; documents
    without doc_id, without words or without text are never near duplicates. An empty table stays empty.
    """
    rejected = near_duplicates(docs, percent=SIMILAR_PERCENT).where("not kept").select("doc_id").distinct()
    # rejected ids grow with the documents: the same join at every size; a null doc_id is never rejected
    return docs.join(rejected.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, each row on its own; null and empty texts stay."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes a placeholder; the documents stay, with n_chars counted anew (null texts stay null)."""
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences; each row is packed, a null text as its end id, none of an empty table."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("packing", pack),
]

#: Learned scores, suffix arrays and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
