"""Streams over arriving files: every file is read once, every batch is applied once, late and repeated rows are merged.

The checkpoint holds the position in the source; the ledger holds which batches have been applied, so a batch that ran
but wasn't committed is not applied twice. Late rows need no bound: the merge compares hashes, not times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomlake.functions.columns import stable_hash
from loomlake.operators.keyed import KeyedTable
from loomlake.operators.merge import latest
from loomlake.sources.documents import exists
from loomlake.streaming.seen import BITS, PARTS, SeenKeys


def read_files(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_batch).parquet(folder)


class Ledger:
    """(batch_id, rows, inserted, updated) of the batches that were applied, as an append-only table."""

    SCHEMA = "batch_id long, rows long, inserted long, updated long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], self.SCHEMA)

    def has(self, batch_id: int) -> bool:
        return bool(self.read().filter(F.col("batch_id") == batch_id).head(1))

    def add(self, batch_id: int, rows: int, metrics: dict[str, int]) -> None:
        row = [(batch_id, rows, metrics.get("inserted", 0), metrics.get("updated", 0))]
        self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def upsert_stream(stream: DataFrame, table: KeyedTable, ledger: Ledger, keys: list[str], checkpoint: str, order: list[str], transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merges all that is there into ``table`` and stops: of several rows of a key in a batch the last by ``order``
    counts, and a row with the same content as the table's changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(batch_id):
            return
        rows = transform(batch) if transform else batch
        hashed = rows.withColumn("_hash", stable_hash(*[F.col(c) for c in rows.columns]))
        last = latest(hashed.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)), keys, [*[F.col(c).desc_nulls_last() for c in order], F.col("_hash")])
        metrics = table.upsert(last, keys, "_hash")
        ledger.add(batch_id, batch.count(), metrics)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str, bits: int = BITS, parts: int = PARTS) -> StreamingQuery:
    """Appends rows whose keys haven't been seen, without a bound on lateness (see seen.py): old keys are read only in the
    parts where a batch has a hit. A batch that runs again replaces its rows."""
    seen = SeenKeys(stream.sparkSession, path, keys, bits, parts)
    return stream.writeStream.foreachBatch(seen.append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
