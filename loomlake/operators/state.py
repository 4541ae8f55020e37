"""Run state as tables: runs, batches, files, fingerprints, events. Rows are merged with the kernel of merge.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlake.functions.columns import percent, seconds_between
from loomlake.operators.merge import greatest, insert_ignore, keep_new, merge, replace_keys

#: Which states a batch may go to.
TRANSITIONS = {
    "queued": ("running", "cancelled", "skipped"),
    "running": ("success", "failed", "skipped", "cancelled"),
    "retrying": ("success", "failed", "skipped", "cancelled"),
    "failed": ("retrying", "cancelled"),
    "interrupted": ("retrying", "cancelled"),
}
#: Weight of a report run's stages, in percent.
REPORT_STAGES = {"queued": 0, "matching": 12, "ranking": 35, "validating": 60, "creating": 80, "previewing": 92, "done": 100}


def advance(batches: DataFrame, changes: DataFrame) -> DataFrame:
    """Batches (batch_id, status, rows, retry_count) after the wanted changes (batch_id, status, rows); changes that
    the transitions don't allow are left out. A retry adds to retry_count."""
    allowed = F.lit(False)
    for old, new in TRANSITIONS.items():
        allowed = allowed | ((F.col("b.status") == old) & F.col("c.status").isin(*new))
    joined = batches.alias("b").join(changes.alias("c"), F.col("b.batch_id") == F.col("c.batch_id"), "left")
    pick = lambda new, old: F.when(allowed, new).otherwise(old)
    return joined.select(
        "b.batch_id", pick(F.col("c.status"), F.col("b.status")).alias("status"), pick(F.coalesce("c.rows", "b.rows"), F.col("b.rows")).alias("rows"),
        (F.col("b.retry_count") + (F.coalesce(allowed, F.lit(False)) & (F.col("c.status") == "retrying")).cast("int")).alias("retry_count"),
    )


def interrupted(batches: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """Running batches that began too long ago become failed and may be retried."""
    late = (F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(mins=F.lit(minutes)))
    return batches.withColumns({"retryable": F.when(late, True).otherwise(F.col("retryable")), "status": F.when(late, "failed").otherwise(F.col("status"))})


def run_progress(batches: DataFrame) -> DataFrame:
    """Per run: counts by state, rows, percent done."""
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    states = ("queued", "running", "success", "failed", "skipped", "cancelled")
    got = batches.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"), *map(of, states), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return got.withColumn("percent", percent(F.col("success") + F.col("failed") + F.col("skipped") + F.col("cancelled"), F.col("total")))


def merge_runs(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """Counters never go back, texts keep their last known value."""
    rules = {c: greatest if dict(updates.dtypes)[c] in ("bigint", "int", "double") else keep_new for c in updates.columns if c != "run_id"}
    return merge(runs, updates, ["run_id"], None, resolve=rules).drop("_action")


def pending(files: DataFrame, states: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Files without a successful state (or, without retry_failed, without any state)."""
    done = states.filter("status = 'success'") if retry_failed else states
    return files.join(done.select("file_id").distinct(), "file_id", "left_anti")


def file_state(states: DataFrame, attempts: DataFrame) -> DataFrame:
    """States after new attempts (file_id, status, rows): success isn't undone, rows never fall back to 0."""
    both = merge(states, attempts, ["file_id"], None, resolve={
        "status": lambda old, new: F.when(old == "success", old).otherwise(new),
        "rows": lambda old, new: F.when(F.coalesce(new, F.lit(0)) == 0, old).otherwise(new),
    })
    return both.drop("_action")


def new_batches(batches: DataFrame, fingerprints: DataFrame, keys: list[str]) -> DataFrame:
    """Batches whose fingerprint hasn't been seen, one per fingerprint."""
    return insert_ignore(fingerprints, batches, keys)


def column_mappings(old: DataFrame, new: DataFrame) -> DataFrame:
    """The mappings of a raw object replace those it had."""
    return replace_keys(old, new, ["raw_object_key"])


def stage_timings(events: DataFrame) -> DataFrame:
    """Seconds of each stage of a run: from its event to the next."""
    following = F.lead("at").over(Window.partitionBy("run_id").orderBy("at", "stage"))
    return events.select("run_id", "stage", "at", seconds_between(F.col("at"), following).alias("seconds"))


def history_summary(history: DataFrame, slow_ms: int = 3000) -> DataFrame:
    """total, slow, failed, blocked, average_ms of queries."""
    return history.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("duration_ms") >= slow_ms).alias("slow"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "blocked").alias("blocked"), F.coalesce(F.avg("duration_ms"), F.lit(0.0)).alias("average_ms"),
    )


def due(schedules: DataFrame, now: Column) -> DataFrame:
    """Collections to be read now: a collection's schedule overrides its database's; manual ones are never due."""
    every = F.coalesce("collection_minutes", "database_minutes")
    mode = F.coalesce("collection_mode", "database_mode")
    waited = F.col("last_run_at").isNull() | (seconds_between(F.col("last_run_at"), now) >= every * 60)
    return schedules.filter((mode != "manual_only") & waited)
