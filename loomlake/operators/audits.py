"""Audits as tables that are rebuilt whole, and summaries over quality, boards and layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import names as N
from loomlake.operators.flatten import plan_flatten, walk_schema
from loomlake.operators.keyed import KeyedTable

_OF = "database string, collection string, table_name string"
SCHEMAS = {
    "pii": f"{_OF}, column_name string, field_path string, pii_type string, rule string, confidence double, view_name string, protection string, severity string",
    "children": f"{_OF}, child_table string, field_path string, reason string, row_count long",
    "raw_json": f"{_OF}, column_name string, field_path string, reason string, bi_impact string, needs_custom_transform boolean",
}


def pii_rows(schema: T.StructType, view_columns: list[str] | None) -> list[tuple]:
    """A row per field with personal data: column, path, kind, rule, confidence, and what the safe view does with it."""
    found = [f.path for f in walk_schema(schema) if N.is_pii_path(f.path) or N.is_pii_column(f.path.split(".")[-1])]
    out = []
    for path in found:
        column = N.safe_identifier(path.replace(".", "_"), 110)
        protection = N.pii_protection(column, view_columns)
        out.append((column, path, N.pii_type(path), N.pii_rule(path), N.pii_confidence(path), protection, "blocking" if protection == "exposed" else "warning"))
    return out


def audit(spark: SparkSession, sources: dict[tuple[str, str], T.StructType], views: dict[str, list[str]], rows: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """The three audits of collections: (database, collection) -> schema. views: columns by safe view; rows: of child tables.

    A column counts once for each kind of personal data.
    """
    pii, children, raw = [], [], []
    for (database, collection), schema in sources.items():
        table = N.clean_table_name(database, collection)
        view, plan, of = N.view_name(table), plan_flatten(schema, table), (database, collection, table)
        pii += [(*of, c, p, kind, rule, sure, view, protection, severity) for c, p, kind, rule, sure, protection, severity in pii_rows(schema, views.get(view))]
        kinds = {f.path: f.kind.simpleString() for f in walk_schema(schema)}
        for path, child in plan.children.items():
            children.append((*of, child, path, N.child_reason("repeated struct" if "struct" in kinds.get(path, "") else None), (rows or {}).get(child)))
        columns = {path: name for name, (path, how) in plan.columns.items() if how == "json"}
        for path, why in plan.raw_json.items():
            reason = N.raw_json_reason(why)
            impact = N.raw_json_impact(reason)
            raw.append((*of, columns.get(path), path, reason, impact, impact == "custom_transform_recommended"))
    found = {"pii": pii, "children": children, "raw_json": raw}
    frames = {k: spark.createDataFrame(found[k], SCHEMAS[k]) for k in SCHEMAS}
    return frames | {"pii": frames["pii"].dropDuplicates(["table_name", "column_name", "pii_type"])}


def refresh(spark: SparkSession, path: str, audits: dict[str, DataFrame]) -> dict[str, KeyedTable]:
    """Each audit as a new version of its table: what was there is replaced whole, readers see the old or the new."""
    tables = {k: KeyedTable(spark, f"{path.rstrip('/')}/{k}") for k in audits}
    for k, df in audits.items():
        tables[k].write(df.withColumn("checked_at", F.current_timestamp()))
    return tables


# Summaries


def quality_summary(rows: DataFrame) -> DataFrame:
    """One row: mean scores, counts by status, what blocks, and the status of all; ``unknown`` without rows.

    rows: status, blocking, bi_suitability, is_child_table, nested_columns, readiness, flattening.
    """
    of = lambda s: F.count_if(F.col("status") == s)
    mean = lambda c: F.coalesce(F.bround(F.sum(F.coalesce(c, F.lit(0.0))) / F.count(F.lit(1)), 1), F.lit(0.0))
    got = rows.agg(
        F.count(F.lit(1)).alias("tables"), of("passed").alias("passed"), of("warning").alias("warning"), of("failed").alias("failed"),
        F.count_if("blocking").alias("blocking"), F.count_if(F.col("bi_suitability") == "bi_ready").alias("bi_ready"),
        F.count_if(F.col("bi_suitability") == "needs_custom_transform").alias("custom"), F.count_if("is_child_table").alias("children"),
        F.coalesce(F.sum("nested_columns"), F.lit(0)).alias("nested"), mean("readiness").alias("readiness"), mean("flattening").alias("flattening"),
    )
    bad, weak = (F.col("blocking") > 0) | (F.col("readiness") < 70), (F.col("readiness") < 85) | (F.col("warning") > 0) | (F.col("failed") > 0)
    return got.withColumn("status", F.when(F.col("tables") == 0, "unknown").when(bad, "failed").when(weak, "warning").otherwise("passed"))


def board_overview(datasets: DataFrame, boards: DataFrame, charts: DataFrame, loads: DataFrame) -> DataFrame:
    """One row of counts over boards and what they are made of. Each table is read once.

    datasets and charts: status; boards: status, last_refresh_at, generation_ms; loads: status, duration_ms.
    """
    ok, n = F.count_if(F.col("status") == "ok"), F.count(F.lit(1))
    parts = [
        datasets.agg(n.alias("datasets_total"), ok.alias("datasets"), (n - ok).alias("failed_datasets")),
        boards.agg(n.alias("boards_total"), ok.alias("boards"), F.count_if(F.col("status") == "error").alias("failed_boards"),
                   F.max("last_refresh_at").alias("last_refresh"), F.coalesce(F.avg("generation_ms"), F.lit(0.0)).alias("generation_ms")),
        charts.agg(n.alias("charts_total"), ok.alias("charts"), F.count_if(F.col("status") == "error").alias("failed_charts")),
        loads.agg((n - ok).alias("failed_loads"), F.coalesce(F.avg("duration_ms"), F.lit(0.0)).alias("load_ms")),
    ]
    out = parts[0]
    for one in parts[1:]:
        out = out.crossJoin(one)  # a row each
    return out


def layer_rows(states: DataFrame) -> DataFrame:
    """parent_rows, child_rows, total_rows over the states of clean tables (row_count, is_child_table)."""
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return states.agg(
        sum_of(F.when(~F.col("is_child_table"), F.col("row_count"))).alias("parent_rows"), sum_of(F.when(F.col("is_child_table"), F.col("row_count"))).alias("child_rows"),
        sum_of("row_count").alias("total_rows"),
    )


def usual_columns(matches: DataFrame, field: str, most: int = 12) -> DataFrame:
    """The columns that a field of this name was matched to before, the surest and most used first.

    matches: field_name, source_column, confidence. Names are compared by their letters and digits.
    """
    plain = lambda c: F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]+", ""))
    same = matches.filter(F.col("source_column").isNotNull() & (plain(F.col("field_name")) == plain(F.lit(field))))
    found = same.groupBy("source_column").agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("used"))
    return found.orderBy(F.desc("confidence"), F.desc("used"), "source_column").limit(most)


def view_report(checks: DataFrame, now: Column, stale_minutes: int = 1440) -> DataFrame:
    """One row per view: whether it is there, fresh, without personal data and as long as its source; status is the
    first of missing, exposed, row_mismatch, stale that holds, else ok.

    checks: view_name, live, exposed, view_rows, source_rows, validated_at.
    """
    old = F.col("validated_at").isNull() | (F.col("validated_at") < now - F.make_dt_interval(mins=F.lit(stale_minutes)))
    differs = ~F.col("view_rows").eqNullSafe(F.col("source_rows"))
    status = F.when(~F.col("live"), "missing").when(F.col("exposed") != "", "exposed").when(differs, "row_mismatch").when(old, "stale").otherwise("ok")
    return checks.select("view_name", "live", (F.col("exposed") == "").alias("pii_safe"), (~differs).alias("same_rows"), (~old).alias("fresh"), "view_rows", "source_rows", status.alias("status"))
