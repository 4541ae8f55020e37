"""Safe views: what analysts may see of a clean table. Personal data are hashed, JSON is left out."""

from __future__ import annotations

import datetime
import time
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import pii_hash
from loomlake.functions.names import is_pii_column, is_unsafe_json, quote, unique_names, view_name
from loomlake.operators.merge import replace_keys
from loomlake.operators.sets import reconcile

STALE_MINUTES = 1440


@dataclass
class ViewPlan:
    """passed and hashed: output name -> source column."""

    passed: dict[str, str] = field(default_factory=dict)
    hashed: dict[str, str] = field(default_factory=dict)
    blocked: list[str] = field(default_factory=list)


def plan_view(columns: list[str], certified: tuple[str, ...] = ()) -> ViewPlan:
    """JSON columns are blocked unless certified, then personal data become <column>_hash, all else passes. A hash
    never takes the name of a column that passes."""
    plan = ViewPlan(blocked=[c for c in columns if is_unsafe_json(c, certified)])
    left = [c for c in columns if c not in plan.blocked]
    secret = [c for c in left if is_pii_column(c)]
    plan.passed = {c: c for c in left if c not in secret}
    plan.hashed = dict(zip(unique_names([f"{c}_hash" for c in secret], plan.passed), secret, strict=True))
    return plan


def canonical_text(df: DataFrame, column: str) -> Column:
    """A value as text that doesn't depend on how an engine prints numbers."""
    c, kind = F.col(quote(column)), df.schema[column].dataType
    if isinstance(kind, T.DoubleType | T.FloatType):
        return c.try_cast("decimal(38,6)").cast("string")
    return c.cast("string")


def safe_projection(df: DataFrame, salt: str, certified: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a safe view in the order of the table; a placeholder where nothing may be shown."""
    plan = plan_view(df.columns, certified)
    source = {v: (k, False) for k, v in plan.passed.items()} | {v: (k, True) for k, v in plan.hashed.items()}
    out = [
        (pii_hash(canonical_text(df, c), salt) if secret else F.col(quote(c))).alias(name)
        for c in df.columns
        if c in source
        for name, secret in [source[c]]
    ]
    return df.select(*out or [F.lit(None).cast("string").alias("safe_view_placeholder")])


def register_views(spark: SparkSession, tables: dict[str, DataFrame], salt: str, certified: tuple[str, ...] = ()) -> DataFrame:
    """Creates or replaces a view for each clean table; returns their metadata."""
    rows = []
    for table, df in tables.items():
        plan, name = plan_view(df.columns, certified), view_name(table)
        safe_projection(df.alias(table), salt, certified).createOrReplaceTempView(name)
        rows.append((name, table, list(plan.passed), list(plan.hashed), plan.blocked, "ok", not any(map(is_pii_column, plan.passed))))
    schema = "view_name string, source_table string, passed array<string>, hashed array<string>, blocked array<string>, status string, pii_safe boolean"
    return spark.createDataFrame(rows, schema).withColumn("validated_at", F.current_timestamp())


def reconcile_views(metadata: DataFrame, tables: DataFrame, visible: DataFrame, now: Column, stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """(view_name, status) of all views that are expected or visible: present, missing, orphan or stale.

    tables: (table_name) of clean tables; visible: (view_name); metadata: (view_name, validated_at).
    """
    expected = tables.filter(F.col("table_name").endswith("_clean")).select(F.concat(F.regexp_replace("table_name", "_clean$", ""), F.lit("_analytics")).alias("view_name"))
    found = reconcile(expected, visible.select("view_name"), "view_name")
    old = F.col("validated_at").isNull() | (F.col("validated_at") < now - F.make_dt_interval(mins=F.lit(stale_minutes)))
    checked = found.join(metadata.select("view_name", "validated_at"), "view_name", "left")
    return checked.select("view_name", F.when((F.col("status") == "present") & old, "stale").otherwise(F.col("status")).alias("status"))


def drop_orphans(spark: SparkSession, found: DataFrame, allowed: bool = False) -> list[str]:
    """Names of orphan views; they are dropped only where that is allowed."""
    names = [r["view_name"] for r in found.filter("status = 'orphan'").select("view_name").collect()]
    for name in names if allowed else ():
        spark.catalog.dropTempView(name)
    return names


def eligible(metadata: DataFrame, visible: DataFrame, sources: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """Views that may be queried: validated, safe, they and their source there, and answering where that was tried.

    visible: (view_name); sources: (table_name); live: (view_name, live).
    """
    got = metadata.filter("status = 'ok' AND pii_safe").join(visible.select("view_name"), "view_name", "left_semi")
    got = got.join(sources.select(F.col("table_name").alias("source_table")), "source_table", "left_semi").select(metadata.columns)
    return got if live is None else got.join(live.filter("live").select("view_name"), "view_name", "left_semi").select(metadata.columns)


def renew_views(spark: SparkSession, tables: dict[str, DataFrame], metadata: DataFrame | None, salt: str, now: Column, stale_minutes: int = STALE_MINUTES) -> tuple[DataFrame, list[str]]:
    """Registers what is missing or stale among the views of ``tables``; returns all metadata as of now, and the orphans.

    metadata: of an earlier registration, None at first. Views that are fresh are left alone.
    """
    visible = spark.createDataFrame([(t.name,) for t in spark.catalog.listTables() if t.name.endswith("_analytics")], "view_name string")
    known = metadata if metadata is not None else register_views(spark, {}, salt)
    found = reconcile_views(known, spark.createDataFrame([(t,) for t in tables], "table_name string"), visible, now, stale_minutes).collect()
    again = {r["view_name"] for r in found if r["status"] in ("missing", "stale")}
    fresh = register_views(spark, {t: df for t, df in tables.items() if view_name(t) in again}, salt).withColumn("validated_at", now)
    return replace_keys(known, fresh, ["view_name"]), sorted(r["view_name"] for r in found if r["status"] == "orphan")


def check_view(view: DataFrame, source: DataFrame) -> DataFrame:
    """view_rows, source_rows, same_rows, exposed: columns with personal data that the view shows."""
    counted = view.agg(F.count(F.lit(1)).alias("view_rows")).crossJoin(source.agg(F.count(F.lit(1)).alias("source_rows")))
    exposed = [c for c in view.columns if is_pii_column(c)]
    return counted.select("view_rows", "source_rows", (F.col("view_rows") == F.col("source_rows")).alias("same_rows"), F.lit(",".join(exposed)).alias("exposed"))


def view_groups(metadata: DataFrame, states: DataFrame) -> DataFrame:
    """Per database and collection its views, and how many are safe and how many aren't ready.

    states: (table_name, database, collection, row_count).
    """
    joined = metadata.join(states, metadata["source_table"] == states["table_name"])
    return joined.groupBy("database", "collection").agg(
        F.array_sort(F.collect_list("view_name")).alias("views"), F.count(F.lit(1)).alias("n_views"), F.count_if("pii_safe").alias("n_safe"),
        F.count_if(F.col("status") != "ok").alias("n_not_ready"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
    )


PREVIEW = 25
_PERFORMANCE = "view_name string, status string, rows long, preview_rows int, nulls map<string,long>, seconds double, error string, at timestamp"


def measured(df: DataFrame, rows: int = PREVIEW) -> tuple[list[Row], int, dict[str, int]]:
    """A preview of ``df`` (the rows with the least hashes: the same each time), and its number of rows and of nulls by column,
    all taken by the one job that makes the preview."""
    seen = Observation()
    nulls = [F.count_if(F.col(quote(c)).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    order = F.xxhash64(F.to_json(F.struct(*[F.col(quote(c)) for c in df.columns])))
    got = df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).orderBy(order).limit(rows).collect()
    return got, seen.get["rows"], {c: seen.get[f"n{i}"] for i, c in enumerate(df.columns)}


def performance(spark: SparkSession, names: list[str], path: str) -> DataFrame:
    """Runs every view once, and appends what it took to the history at ``path``: rows, nulls, seconds, or the error. One job
    a view; what is there is never written again. Gives the whole history."""
    for name in names:
        began, at = time.monotonic(), datetime.datetime.now()
        try:
            preview, rows, nulls = measured(spark.table(name))
            row = (name, "ok", rows, len(preview), nulls, time.monotonic() - began, None, at)
        except PySparkException as e:
            row = (name, "failed", None, None, None, time.monotonic() - began, str(e)[:500], at)
        spark.createDataFrame([row], _PERFORMANCE).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(_PERFORMANCE).parquet(path)
