"""Profiles that are kept up by batch: each batch leaves partial counts and sketches, and a profile is their sum.

Counts of rows and of values are exact. Distinct values come from HyperLogLog sketches (LG_K: a standard error of about
1.04 / 2^(LG_K/2)), quantiles of numbers from KLL sketches. A batch costs its own size, whatever is there already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.operators.flatten import MAX_PROFILED, walk_schema
from loomlake.sources.documents import exists

LG_K = 12
QUANTILES = (0.25, 0.5, 0.75)
_PARTIAL = "batch string, field_path string, detected_type string, depth int, total_rows long, occurrence_count long, least double, most double, distinct_sketch binary, number_sketch binary"


def partial_profiles(df: DataFrame, batch: str, most: int = MAX_PROFILED) -> DataFrame:
    """A row per batch and field of ``df``, batch being the name of a column; one pass, partly aggregated where the rows are.

    Fields of structs are fields; of arrays and maps only their presence counts. Rows without a batch are one batch, ''.
    """
    fields = [f for f in walk_schema(T.StructType([f for f in df.schema.fields if f.name != batch]))[:most]]
    aggs, entries = [], []
    for i, f in enumerate(fields):
        c, plain = F.col(f.column), isinstance(f.kind, T.AtomicType) and not isinstance(f.kind, T.VariantType)
        number = isinstance(f.kind, T.NumericType)
        aggs.append(F.count(c).alias(f"c{i}"))
        if plain:
            aggs.append(F.hll_sketch_agg(c.cast("string"), F.lit(LG_K)).alias(f"d{i}"))
        if number:
            x = c.cast("double")
            aggs += [F.min(x).alias(f"l{i}"), F.max(x).alias(f"m{i}"), F.kll_sketch_agg_double(x).alias(f"k{i}")]
        some = lambda name, there, kind: (F.col(name) if there else F.lit(None)).cast(kind)
        entries.append(F.struct(
            F.lit(f.path).alias("field_path"), F.lit(f.kind.simpleString()).alias("detected_type"), F.lit(f.depth).alias("depth"), F.col("n").alias("total_rows"), F.col(f"c{i}").alias("occurrence_count"),
            some(f"l{i}", number, "double").alias("least"), some(f"m{i}", number, "double").alias("most"), some(f"d{i}", plain, "binary").alias("distinct_sketch"), some(f"k{i}", number, "binary").alias("number_sketch"),
        ))
    if not fields:
        return df.sparkSession.createDataFrame([], _PARTIAL)
    counts = df.groupBy(F.coalesce(F.col(batch).cast("string"), F.lit("")).alias("batch")).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return counts.select("batch", F.inline(F.array(*entries)))


def merged_profile(partials: DataFrame) -> DataFrame:
    """A row per field: counts, percent of rows, least and most, estimates of distinct values and of QUANTILES. A field that
    has had several types is a row for each; rows of batches that didn't have a field count as rows without it."""
    batches = partials.groupBy("batch").agg(F.max("total_rows").alias("n")).agg(F.sum("n").alias("all_rows"))
    found = partials.groupBy("field_path", "detected_type").agg(
        F.min("depth").alias("depth"), F.sum("occurrence_count").alias("occurrence_count"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.bool_or(F.col("distinct_sketch").isNotNull()).alias("sketched"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("number_sketch").alias("number_sketch"),
    )
    rows = found.crossJoin(F.broadcast(batches))  # one row
    quantiles = F.when(F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("number_sketch", F.array(*[F.lit(q) for q in QUANTILES])))
    percent = F.when(F.col("all_rows") > 0, F.bround(F.col("occurrence_count") / F.col("all_rows") * 100, 2)).otherwise(F.lit(0.0))
    distinct = F.when(F.col("sketched"), F.hll_sketch_estimate("distinct_sketch"))
    return rows.select(
        "field_path", "detected_type", "depth", "occurrence_count", F.col("all_rows").alias("total_rows"), percent.alias("occurrence_percent"),
        "least", "most", distinct.alias("distinct_estimate"), quantiles.alias("quantiles"),
    )


class ProfileStore:
    """Partial profiles of a table's batches below ``path``, a folder for each; one that comes again replaces its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, df: DataFrame, batch: str) -> None:
        rows = partial_profiles(df, batch).repartition(1, "batch")  # a few rows for each batch
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path)

    def partials(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], _PARTIAL)
        return self.spark.read.schema(_PARTIAL).option("basePath", self.path).parquet(self.path)

    def read(self) -> DataFrame:
        return merged_profile(self.partials())
