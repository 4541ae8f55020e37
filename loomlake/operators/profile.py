"""Profiles, quality metrics, schema drift and readiness scores."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import names as N
from loomlake.operators.flatten import AUDIT_COLUMNS, MAX_PROFILED, FlattenPlan, plan_flatten, walk_schema

# The states that are known in each domain.
ORDER_STATES = ("completed", "processing", "pending", "cancelled", "incremental_bronze_test", "incremental_test")
PAYMENT_STATES = ("captured", "authorized", "pending", "failed", "refunded")
SILVER_AUDIT = {"silver_record_hash", "silver_processed_at", "silver_ingestion_date"}


def field_facts(schema: T.StructType, plan: FlattenPlan | None = None, most: int = MAX_PROFILED) -> list[tuple]:
    """(path, type, depth, strategy, pii) of each field, from the schema alone."""
    plan = plan or plan_flatten(schema)
    extracted = {p for p, how in plan.columns.values() if how == "scalar"}

    def strategy(path: str, kind: T.DataType) -> str:
        if path in plan.children:
            return "child_table"
        if path in plan.raw_json:
            return "raw_json_fallback"
        return "column" if path in extracted else "container" if isinstance(kind, T.StructType) else "ignored"

    return [(f.path, f.kind.simpleString(), f.depth, strategy(f.path, f.kind), N.is_pii_path(f.path)) for f in walk_schema(schema)[:most]]


def field_profile(df: DataFrame, plan: FlattenPlan | None = None, most: int = MAX_PROFILED) -> DataFrame:
    """A row per field: path, type, depth, occurrences, percent, strategy, pii; all counted in one pass."""
    fields = walk_schema(df.schema)[:most]
    schema = "field_path string, detected_type string, depth int, occurrence_count long, total_rows long, flattening_strategy string, pii_detected boolean"
    if not fields:
        return df.sparkSession.createDataFrame([], schema).withColumn("occurrence_percent", F.lit(None).cast("double"))
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f.column)).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = [
        F.struct(F.lit(path).alias("field_path"), F.lit(kind).alias("detected_type"), F.lit(depth).alias("depth"), F.col(f"c{i}").alias("occurrence_count"),
                 F.col("n").alias("total_rows"), F.lit(strategy).alias("flattening_strategy"), F.lit(pii).alias("pii_detected"))
        for i, (path, kind, depth, strategy, pii) in enumerate(field_facts(df.schema, plan, most))
    ]
    rows = counts.select(F.inline(F.array(*entries)))
    return rows.withColumn("occurrence_percent", F.when(F.col("total_rows") > 0, F.bround(F.col("occurrence_count") / F.col("total_rows") * 100, 2)).otherwise(F.lit(0.0)))


def key_quality(df: DataFrame, key: Column) -> DataFrame:
    """total_rows, null_keys, distinct_keys, duplicate_keys (rows beyond the first of a key)."""
    got = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(key.isNull()).alias("null_keys"), F.countDistinct(key).alias("distinct_keys"))
    return got.withColumn("duplicate_keys", F.greatest(F.col("total_rows") - F.col("null_keys") - F.col("distinct_keys"), F.lit(0)))


def outside(c: Column, allowed: tuple[str, ...]) -> Column:
    """How many values are not among those allowed; null isn't."""
    return F.count_if(~c.isin(*allowed))


def bad_prices(c: Column) -> Column:
    return F.count_if(c.isNull() | (c < 0))


# Schemas


def flat_schema(schema: T.StructType) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def short_hash(parts: list[str]) -> str:
    return hashlib.md5("|".join(sorted(parts)).encode()).hexdigest()[:12]


def schema_drift(spark: SparkSession, old: T.StructType | None, new: T.StructType) -> DataFrame:
    """One row: change_type (initial, unchanged, changed), new_fields, removed_fields, schema_hash."""
    now = {f"{n}:{k}" for n, k, _ in flat_schema(new)}
    past = {f"{n}:{k}" for n, k, _ in flat_schema(old)} if old else set()
    change = "initial" if old is None else "unchanged" if now == past else "changed"
    added, gone = (sorted(now - past), sorted(past - now)) if old is not None else (sorted(now), [])
    schema = "change_type string, new_fields array<string>, removed_fields array<string>, schema_hash string"
    return spark.createDataFrame([(change, added, gone, short_hash(list(now)))], schema)


def schema_paths(schema: T.DataType, prefix: str = "") -> set[str]:
    """Dotted paths of all fields; [] marks a step into an array."""
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{prefix}[]") | ({f"{prefix}[]"} if prefix else set())
    if isinstance(schema, T.StructType):
        out: set[str] = set()
        for f in schema.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            out |= {path} | schema_paths(f.dataType, path)
        return out
    return set()


def metadata_signature(value: dict) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


# Readiness


def _clamped(x: float) -> float:
    return max(0.0, min(100.0, x))


def _complex(kind: str) -> bool:
    return kind.startswith(("struct", "array", "map"))


def layer_difference(bronze: T.StructType, silver: T.StructType) -> dict:
    """How the clean table differs from its source, and whether it looks like a mere copy."""
    b = {n: k for n, k, _ in flat_schema(bronze) if n not in AUDIT_COLUMNS}
    s = {n: k for n, k, _ in flat_schema(silver)}
    own = set(s) - SILVER_AUDIT - set(AUDIT_COLUMNS)
    overlap = len(set(b) & own) / max(len(b), 1)
    nested_before, nested_after = sum(map(_complex, b.values())), sum(map(_complex, s.values()))
    signals = {
        "fewer_nested_structures": nested_after < nested_before,
        "sanitized_or_flattened_names": any("_" in n and n not in b for n in own),
        "raw_json_fallbacks": any(n.endswith("_raw_json") for n in s),
        "clean_metadata_added": SILVER_AUDIT <= set(s),
    }
    copied = bool(b) and overlap > 0.9 and nested_after >= nested_before and not any(signals.values())
    return {"overlap_ratio": round(overlap, 3), "bronze_complex_columns": nested_before, "silver_complex_columns": nested_after, "signals": signals, "copy_suspected": copied}


def type_warnings(schema: T.StructType) -> list[tuple[str, str]]:
    """Columns whose type contradicts their name."""
    out = []
    for name, kind, _ in flat_schema(schema):
        low = name.lower()
        if low.endswith(("_at", "_date", "_timestamp")) and kind == "string":
            out.append((name, "temporal name with text type"))
        if any(m in low for m in ("amount", "price", "total", "balance")) and kind == "string":
            out.append((name, "measure name with text type"))
        if low.startswith(("is_", "has_")) and kind != "boolean":
            out.append((name, "flag name without boolean type"))
    return out


def readiness(bronze: T.StructType, silver: T.StructType, table: str, collection: str = "") -> dict:
    """Sub-scores of a clean table from its schema, weighed into BI and analytics readiness."""
    fields = flat_schema(silver)
    names = [n for n, _, _ in fields]
    kind = N.classify_table_for_audit(table, collection, names)
    raw = [n for n in names if n.endswith("_raw_json")]
    nested = [n for n, k, _ in fields if _complex(k) and n not in raw]
    invalid = [n for n in names if N.sanitize_column(n)[0] != n]
    doubles = len(names) - len({n.lower() for n in names})
    types, pii = type_warnings(silver), [n for n in names if N.is_pii_column(n)]
    some = bool(names)
    flattening = max(0.0, 100 - 24.0 * len(nested) - len(raw) * (1.5 if kind in ("dynamic_config_like", "log_like") else 3.0))
    safety = _clamped(100 - 25 * (len(invalid) + doubles)) * some
    typed = _clamped(100 - 18 * len(types)) * some
    protected = _clamped(100 - 8 * len(pii)) * some
    changed = 55.0 if layer_difference(bronze, silver)["copy_suspected"] else 100.0
    independent = _clamped(100 - len(raw) / max(len(names), 1) * 100)
    usable = _clamped(safety - 10 * len(nested) - 0.4 * max(0, len(names) - 250))
    bi = round(0.35 * flattening + 0.25 * usable + 0.2 * typed + 0.2 * independent, 1)
    analytics = round(0.3 * flattening + 0.25 * usable + 0.2 * typed + 0.15 * protected + 0.1 * changed, 1)
    scores = {"flattening": flattening, "column_safety": safety, "type_quality": typed, "pii_safety": protected, "transformation": changed,
              "raw_json_independence": independent, "sql_usability": usable, "bi_readiness": bi, "analytics_readiness": analytics}
    status = "failed" if not names or bi < 50 else "ready" if bi >= 85 else "warning"
    reasons = ["no columns"] * (not names) + [f"nested: {n}" for n in nested] + [f"invalid name: {n}" for n in invalid] + [f"{n}: {why}" for n, why in types]
    return {"table": table, "classification": kind, "suitability": N.bi_suitability(kind, bi), "status": status, "reasons": reasons, **scores}


def missing_child_tables(bronze: T.StructType, table: str, existing: set[str]) -> list[str]:
    return sorted(set(plan_flatten(bronze, table).children.values()) - existing)
