"""Exact dedup by content-defined chunk recipes (native).

A text is cut where its content says so: at the first anchor that is at least MIN_CHUNK characters after the last
cut, or after MAX_CHUNK characters without one. Anchors are rarer than MIN_CHUNK (certain last letters of a word before
certain first letters), so cuts fall in step again soon after an insertion. Each
chunk has a 64-bit identifier and a SHA-256. The catalogue of chunks shows whether any identifier stands for two
chunks; only then the recipes use the SHA-256 values. A document's recipe is its ordered list of verified
identifiers, and documents are equal when their recipes are: only recipes (about 1 % of the text) are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import stored, unused, with_group

MIN_CHUNK, MAX_CHUNK = 128, 4096
_CUT = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?[gkmpvwy][ ,.;:\\n]+(?=[bcdfmpw])|.{{1,{MAX_CHUNK}}}"


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_sha256, weak array<bigint>, strong array<string>): a text's chunk identifiers, in order.

    A null text counts as empty; an empty text has the empty recipe.
    """
    return (
        docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .withColumn("_chunks", F.regexp_extract_all("_text", F.lit(_CUT), F.lit(0)))
        .select(
            id_col,
            F.sha2("_text", 256).alias("text_sha256"),
            F.transform("_chunks", lambda c: F.xxhash64(c)).alias("weak"),
            F.transform("_chunks", lambda c: F.sha2(c, 256)).alias("strong"),
        )
    )


def ambiguous_chunks(recipes: DataFrame) -> DataFrame:
    """The 64-bit identifiers that stand for more than one chunk (expected: none below some 10^9 chunks)."""
    chunks = recipes.select(F.explode(F.arrays_zip("weak", "strong")).alias("c")).select("c.weak", "c.strong")
    return chunks.groupBy("weak").agg(F.min("strong").alias("a"), F.max("strong").alias("b")).filter("a <> b").select("weak")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, keep_id, group_size, kept, text_sha256).

    Of equal texts the largest id stays. Null texts equal empty ones. A null id never wins over another id; where
    all ids of a group are null, keep_id is null and the rows stay. Rows that repeat both id and text are the same
    document: each is counted in group_size, and all with the largest id are kept. No rows: no rows.
    """
    recipes = stored(chunk_recipes(docs, id_col, text_col), "recipes")
    verified = "strong" if ambiguous_chunks(recipes).head(1) else "weak"
    rows = recipes.select(id_col, "text_sha256", F.col(verified).alias("recipe"))
    values = {"_keep": (F.max(id_col), F.max("_keep")), "_size": (F.count(F.lit(1)), F.sum("_size"))}
    found = with_group(rows, ["recipe"], [id_col], values, F.col("_size") > 1)
    keep = F.when(F.col("_size").isNull(), F.col(id_col)).otherwise(F.col("_keep"))
    return found.select(
        id_col,
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col(id_col)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact_groups keeps, all columns."""
    sha, gone_id = unused(docs, "sha", "gone")
    gone = exact_groups(docs, id_col, text_col).filter(~F.col("kept")).select(F.col(id_col).alias(gone_id), F.col("text_sha256").alias("_hash")).distinct()
    keyed = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    match = keyed[id_col].eqNullSafe(gone[gone_id]) & (keyed[sha] == gone["_hash"])
    return keyed.join(gone, match, "left_anti").drop(sha)


def op8_exact_dedup(spark, sf_dir):
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       coalesce(max(doc_id) OVER g = doc_id, doc_id IS NULL AND max(doc_id) OVER g IS NULL) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
