"""The corpus pipeline: documents in, packed training sequences out.

Each stage is a function of (session, documents, table folder) over one
operator of ``ledgerlens.llm``; its result is written as Parquet and read
again as the next one's documents. All but the last return the columns of
``documents``. Nulls, empty texts, repeated rows, an empty table and further
columns are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.common import store, table
from ledgerlens.llm.exact_dedup import drop_copies
from ledgerlens.llm.packing import pack_documents
from ledgerlens.llm.quality import keep_good
from ledgerlens.llm.secret_scan import redact
from ledgerlens.llm.simhash import drop_near_copies

#: SQL can express neither tokens nor the packing search; the tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or are probably bad go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, the one with the least doc_id stays."""
    return drop_near_copies(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences of at most 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
