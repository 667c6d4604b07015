"""From raw documents to packed sequences, stage by stage.

Each stage takes what its predecessor kept and gives rows with the columns of
``documents``; the last one gives packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import documents, labels, shared_folder
from gridloom.llm.line_dedup import deduped_documents
from gridloom.llm.minhash import without_copies
from gridloom.llm.mixing import mixed_documents
from gridloom.llm.packing import pack
from gridloom.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go."""
    return without_toxic(docs, labels(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines with 50 words or more go, and texts of which nothing is left."""
    return deduped_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken to their target weights: some documents go, some repeat."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All tokens, in sequences of at most 2048."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Packing and the models aren't SQL: tests/llm/test_llm_stages.py holds the whole pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages; each result is written and read again, in the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            delete(spark, f"{folder}/{k - 1}")
    return docs


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
