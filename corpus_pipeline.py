"""Corpus pipeline: from raw documents to packed sequences, stage by stage.

Each stage works on everything that the stage before it kept, written as
Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import decontaminate, neardup, packing, pii, quality
from starmill.llm.common import table, written
from starmill.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among them."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return neardup.drop_near_duplicates(docs.select(*COLUMNS))


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence, with their ids as packed little-endian uint32."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", keep_clean_of_benchmark),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline-packing")


#: The classifier, the tagger and the tokenizer can't be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None
