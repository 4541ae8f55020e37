"""Document files to nested tables: safe names at every depth, audit columns, content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import optional, record_hash
from loomlake.functions.names import quote, sanitize_column, sanitize_columns
from loomlake.operators.flatten import AUDIT_COLUMNS
from loomlake.sources.documents import ENVELOPE


def renamed_type(kind: T.DataType) -> T.DataType:
    """``kind`` with the fields of all structs in it renamed, also within arrays and maps."""
    if isinstance(kind, T.StructType):
        names = sanitize_columns(f.name for f in kind.fields)
        return T.StructType([T.StructField(names[f.name], renamed_type(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(renamed_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, renamed_type(kind.valueType), kind.valueContainsNull)
    return kind


def sanitized(df: DataFrame) -> DataFrame:
    """Safe names at every depth in one projection; a struct is cast field by field in its order."""
    names = sanitize_columns(df.columns)
    return df.select(*[F.col(quote(f.name)).cast(renamed_type(f.dataType)).alias(names[f.name]) for f in df.schema.fields])


def column_mappings(df: DataFrame, raw_object_key: str) -> DataFrame:
    """(raw_object_key, raw_field, bronze_field, reason) of the top-level columns whose names change."""
    names = sanitize_columns(df.columns)
    why = lambda c, n: ",".join([*(found := sanitize_column(c))[1], *["duplicate_sanitized_name"] * (found[0] != n)])
    rows = [(raw_object_key, c, n, why(c, n)) for c, n in names.items() if c != n]
    return df.sparkSession.createDataFrame(rows, "raw_object_key string, raw_field string, bronze_field string, reason string")


def bronze_table(docs: DataFrame, run_id: str, at: Column, bucket: str = "", object_key: Column | None = None) -> DataFrame:
    """Documents with envelope as a bronze table: sanitised, nested types kept, audit columns and content hash.

    The hash covers the business columns, so a document that is read again unchanged has the same one.
    """
    key = F.lit(None).cast("string") if object_key is None else object_key
    base = docs.withColumn("_raw_object_key", key)
    clean = sanitized(base.select(*[c for c in base.columns if c not in ENVELOPE and c not in ("dt", "hr", "_raw_object_key")]))
    names = sanitize_columns(c for c in docs.columns if c not in ENVELOPE and c not in ("dt", "hr"))
    changed = any(k != v for k, v in names.items())
    business = [F.col(quote(f.name)).cast(renamed_type(f.dataType)).alias(names[f.name]) for f in docs.schema.fields if f.name in names]
    audit = {
        "_bronze_ingested_at": at.cast("timestamp"), "_raw_bucket": F.lit(bucket), "_raw_object_key": F.col("_raw_object_key"),
        "_source_id": optional(docs, "__source_id"), "_source_name": optional(docs, "__source_name"), "_source_db": optional(docs, "__source_db"),
        "_source_collection": optional(docs, "__source_collection"), "_raw_run_id": F.lit(run_id), "_raw_file_id": F.md5("_raw_object_key"),
        "_schema_version": F.lit(_version(clean.schema)), "_column_sanitized": F.lit(changed), "_column_mapping_version": F.lit("v1"),
        "bronze_ingestion_date": at.cast("date"),
    }
    rows = base.select(*business, *[v.alias(k) for k, v in audit.items()])
    return rows.withColumn("_record_hash", record_hash(rows, AUDIT_COLUMNS))


def _version(schema: T.StructType) -> str:
    from loomlake.operators.profile import flat_schema, short_hash

    return short_hash([f"{n}:{k}" for n, k, _ in flat_schema(schema)])
