"""A corpus pipeline: language ID, near-duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is written as Parquet
and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.decontamination import drop_leaks
from loomlake.llm.language_id import language_of_documents
from loomlake.llm.mixing import mixed_documents
from loomlake.llm.near_dedup import drop_near_duplicates
from loomlake.llm.shared import stored
from loomlake.llm.token_files import token_index

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; rejected ones (and those without a letter) go."""
    return language_of_documents(docs.select(COLUMNS)).filter(~F.col("_language")["rejected"]).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of their domains; none is repeated."""
    return mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), repeat=False).select(COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token files."""
    return token_index(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_files", token_files),
]

#: Character models, signatures and tokenizers aren't expressible in SQL: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the whole of documents: (doc_id, start, n_tokens, ids_crc32) of the documents that are left.

    Null or repeated ids and copies of rows are told apart by a hash of id and text; null and empty texts go in the
    first stage (no letter, no language); an empty table gives no rows. The last stage's rows are in its files.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
