"""Which keys have been seen: bitmaps of key hashes first, the keys themselves only where a bit says maybe.

A key's hash sets a bit. A key whose bit isn't set is new for certain, without a look at history; the others are compared
with the old keys, of which only the parts are read that a hit falls into. Bits may collide: that costs a comparison, never
a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.functions.names import quote
from loomlake.operators.keyed import KeyedTable
from loomlake.sources.documents import exists
from loomlake.storage import discard, shared_path

#: Bits in all (a power of two), of which one bitmap row holds _ROW; and folders that the rows of a batch are dealt to.
BITS, PARTS = 1 << 27, 16
_ROW = 1 << 15


class SeenKeys:
    """Rows below <path>/batch=<id>/part=<n>, each key once, and the bitmaps of their keys below <path>/_seen."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], bits: int = BITS, parts: int = PARTS):
        self.spark, self.path, self.keys, self.bits, self.parts = spark, path.rstrip("/"), keys, bits, parts
        self.bitmaps = KeyedTable(spark, f"{self.path}/_seen", buckets=PARTS)

    def _hash(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(quote(k)) for k in self.keys]), F.lit(self.bits))

    def hits(self, rows: DataFrame) -> DataFrame:
        """``rows`` with _row and _bit (where a key's bit lies), part, and _maybe: whether it is set."""
        placed = rows.withColumn("_h", self._hash())
        placed = placed.withColumns({"_row": F.floor(F.col("_h") / _ROW), "_bit": (F.col("_h") % _ROW).cast("int"), "part": (F.col("_h") % self.parts).cast("int")}).drop("_h")
        if not self.bitmaps.exists():
            return placed.withColumn("_maybe", F.lit(False))
        byte = F.conv(F.hex(F.substring("_map", F.expr("_bit div 8 + 1"), F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("getbit", byte, F.col("_bit") % 8) == 1
        return placed.join(self.bitmaps.read().select("_row", "_map"), "_row", "left").withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_map")

    def old_keys(self, parts: list[int], batch_id: int) -> DataFrame:
        """Keys of other batches that lie in ``parts``: the only folders that are read."""
        old = self.spark.read.option("basePath", self.path).parquet(self.path)
        return old.filter((F.col("batch") != batch_id) & F.col("part").isin(parts)).select(*[quote(k) for k in self.keys])

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Adds the rows whose keys are new, one for each; a batch that comes again replaces what it wrote. A key with a null
        is compared with none and is new in each batch."""
        scratch = shared_path(self.spark, "seen")
        try:
            self.hits(batch.dropDuplicates(self.keys)).write.parquet(f"{scratch}/rows")
            rows = self.spark.read.parquet(f"{scratch}/rows")
            parts = sorted(r["part"] for r in rows.filter("_maybe").select("part").distinct().collect())  # at most self.parts
            fresh = rows
            if parts and exists(self.spark, self.path):
                fresh = rows.filter("NOT _maybe").unionByName(rows.filter("_maybe").join(self.old_keys(parts, batch_id), self.keys, "left_anti"), allowMissingColumns=False)
            fresh.select("_row", "_bit", *rows.drop("_row", "_bit", "_maybe").columns).write.parquet(f"{scratch}/fresh")
            fresh = self.spark.read.parquet(f"{scratch}/fresh")
            fresh.drop("_row", "_bit").repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/batch={batch_id}")
            self._note(fresh)
        finally:
            discard(self.spark, scratch)

    def _note(self, fresh: DataFrame) -> None:
        """Sets the bits of ``fresh``: only the bitmap rows that they fall into are read and written."""
        new = fresh.groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_map"))
        if self.bitmaps.exists():
            old = self.bitmaps.read().join(new.select("_row"), "_row", "left_semi")
            new = new.unionByName(old).groupBy("_row").agg(F.bitmap_or_agg("_map").alias("_map"))
        self.bitmaps.upsert(new, ["_row"], None)
