"""What happened: an append-only log of events of runs, attempts at files, and the progress of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlake.functions.columns import masked, remaining_seconds
from loomlake.operators.state import REPORT_STAGES
from loomlake.sources.documents import exists

SCHEMA = "run_id string, event_type string, status string, message string, details string, at timestamp"


class EventLog:
    """Events of runs, with secrets in messages masked. Appends never touch what is there, so writers don't clash."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, events: DataFrame) -> None:
        """events: columns of SCHEMA; those that are missing are null, a missing ``at`` is now."""
        of = dict(events.dtypes)
        values = [(F.col(n) if n in of else F.current_timestamp() if n == "at" else F.lit(None)).cast(k).alias(n) for n, k in (c.split() for c in SCHEMA.split(", "))]
        rows = events.select(*values).withColumns({"message": masked(F.col("message")), "details": masked(F.col("details"))})
        rows.write.mode("append").parquet(self.path)

    def add(self, run_id: str, event_type: str, status: str | None = None, message: str | None = None) -> None:
        self.append(self.spark.createDataFrame([(run_id, event_type, status, message)], "run_id string, event_type string, status string, message string").coalesce(1))

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], SCHEMA)


def attempts(events: DataFrame) -> DataFrame:
    """Each attempt at a file (file_id, status, at) with its number, and whether it is the last."""
    order = Window.partitionBy("file_id").orderBy("at", "status")
    numbered = events.withColumn("attempt", F.row_number().over(order))
    return numbered.withColumn("last", F.lead("attempt").over(order).isNull())


def report_progress(events: DataFrame, now: Column) -> DataFrame:
    """Per run of a report its stage (the furthest there is), percent, and the seconds that are likely left.

    events: run_id, stage, at. Stages have fixed shares of the work; others count nothing.
    """
    percent = F.lit(0)
    for stage, share in REPORT_STAGES.items():
        percent = F.when(F.col("stage") == stage, share).otherwise(percent)
    far = F.struct(percent.alias("percent"), "at", "stage")
    got = events.groupBy("run_id").agg(F.max(far).alias("far"), F.min("at").alias("began"))
    elapsed = F.unix_timestamp(now) - F.unix_timestamp("began")
    return got.select("run_id", "far.stage", "far.percent", remaining_seconds(elapsed, F.col("far.percent")).alias("remaining_seconds"))


def flow(events: DataFrame) -> DataFrame:
    """Per run: its steps in order with their last status, how many items each has, and the status of the run: failed if
    a step failed, running if one runs, else success."""
    steps = events.groupBy("run_id", "event_type").agg(F.max_by("status", "at").alias("status"), F.count(F.lit(1)).alias("items"), F.min("at").alias("at"))
    some = lambda s: F.count_if(F.col("status") == s) > 0
    return steps.groupBy("run_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type", "status"))), lambda x: F.concat_ws(":", x["event_type"], x["status"])), ",").alias("steps"),
        F.sum("items").alias("items"), F.when(some("failed"), "failed").when(some("running"), "running").otherwise("success").alias("status"),
    )
