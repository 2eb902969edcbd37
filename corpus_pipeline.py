"""A corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes every
stage's rows to the shared folder and reads them again for the next. All but the last return the columns
of ``documents``. A document that the mix takes several times is there as often, and is packed so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact, mixing, near, packing, toxicity
from ledgerloom.llm.common import table, tokenizer_file, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return toxicity.remove(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    return near.deduplicate(docs, similarity=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's target asks."""
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# The classifier's weights and the packing plan are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
