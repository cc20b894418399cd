"""From raw documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's documents. The stages before the last
return the columns of documents, with the rows they keep. A stage is judged on
what it is given: it trains, compares and counts over all of that, and nothing
else but the labels and the benchmark comes from ``sf_dir``.

Defined results: null and empty texts are documents like any other (they are
copies of each other; one stays); rows with a null doc_id pass by the same
rules; an empty table goes through all stages; extra columns are kept until
the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepfold.llm import decontamination, exact_dedup, packing, simhash_dedup, toxicity
from prepfold.llm.shared import free_name, table
from prepfold.session import shared_path

SCORE = "__toxicity"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, SCORE)
    return toxicity.scored(docs, model, score_col=score).filter(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash_dedup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Trained scores, XXH64 and token ids have no DuckDB form; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_path(spark, "pipeline", uuid.uuid4().hex)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
