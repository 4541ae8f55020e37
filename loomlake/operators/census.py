"""Which paths documents without a schema have, and with which types: counted level by level over variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.storage import discard, shared_path


def _kind(value: str) -> F.Column:
    """object, array, string, integer, number, boolean or null, and Spark's name for other kinds."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    known = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "BOOLEAN": "boolean", "VOID": "null"}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[name], F.lower(name))


def path_census(lines: DataFrame, column: str = "value") -> DataFrame:
    """(path, type, count, documents) over JSON texts: how often a path has a value of a type, and in how many documents.

    Paths are dotted, [] is a step into an array, and the document itself is $. A field whose name has other characters than
    letters, digits and _ is quoted. Texts that aren't JSON, and null ones, have the path $ and the type invalid. Levels
    are exploded one after the other, each counted where it is and only its objects and arrays written for the next, so
    depth is what documents have and only the counts leave the tasks. No lines: no rows.
    """
    spark, scratch, counted, n = lines.sparkSession, shared_path(lines.sparkSession, "census"), [], 0

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    try:
        parsed = lines.select(F.monotonically_increasing_id().alias("doc"), F.lit("$").alias("path"), F.try_parse_json(F.col(column)).alias("v"))
        level = kept(parsed.withColumn("type", F.when(F.col("v").isNull(), "invalid").otherwise(_kind("v"))), "0")
        while True:
            counted.append(kept(level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("count"), F.count_distinct("doc").alias("documents")), f"counts-{n}"))
            inner = level.filter("type IN ('object', 'array')")
            if not inner.head(1):
                break
            items = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("doc", F.col("path"), "key", "value")
            plain = F.when(F.col("key").rlike("^[A-Za-z0-9_]+$"), F.col("key")).otherwise(F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2))
            step = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).otherwise(F.concat_ws(".", "path", plain))
            n += 1
            level = kept(items.select("doc", step.alias("path"), F.col("value").alias("v")).withColumn("type", _kind("v")), str(n))
        total = reduce(DataFrame.unionByName, counted)
        result = shared_path(spark, "paths")
        total.write.parquet(result)
        return spark.read.schema(total.schema).parquet(result)
    finally:
        discard(spark, scratch)
