"""Scratch tables in the shared folder, row-local shingles, and group lookups that survive hot keys."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.storage import shared_path as scratch

#: Ways, at least, into which the rows of one group are dealt before they are aggregated or joined.
SALTS = 64


def stored(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder (below ``within``, a path there) and read back: lineage ends here,
    lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{within}/{name}-{uuid.uuid4().hex}" if within else scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A path for the tables of one job, deleted when it ends: what is to stay is stored elsewhere before."""
    path = scratch(spark, name)
    try:
        yield path
    finally:
        discard(spark, path)


def sweep(spark: SparkSession) -> None:
    """Lets go of shuffles that no table refers to any more, now and not when the driver next collects its garbage: in a
    long job their files would fill the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tidy() -> None:
    """Gives what a Python worker has freed back to the system: workers wait between tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    return [next(c for c in ("_" * i + name for i in range(len(taken) + 2)) if c.lower() not in taken) for name in names]


def as_text(df: DataFrame, *ids: str) -> DataFrame:
    """``df`` with whole-number columns as decimal texts. Beside a null pandas gets longs as doubles, in which those beyond
    2^53 become others: ids go through it as texts and come back by ``as_long``."""
    return df.withColumns({c: F.col(c).cast("string") for c in ids})


def as_long(df: DataFrame, *ids: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in ids})


def salts(spark: SparkSession) -> int:
    """Ways to deal the rows of a group: as many as a shuffle has partitions, so that no group is held by a few."""
    return max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path that no later result reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def word_array(text: str = "text", outside: str = r"[^\\p{L}\\p{N}]+") -> str:
    """SQL for the lower-cased words of a text: runs of characters that ``outside`` doesn't match."""
    return f"filter(split(lower(coalesce({text}, '')), '{outside}'), w -> w <> '')"


def shingle_hashes(words: str, *widths: int) -> Column:
    """array<bigint>: xxhash64 of each k consecutive words for each width k, in order; none of more words than there are.

    The words are bound once by transform(array(..)). The column can't be null: a filter for that would compute it twice.
    """

    def of(k: int) -> str:
        parts = ", ".join(f"get(w, i + {j})" for j in range(k))
        return f"if(size(w) < {k}, cast(array() as array<bigint>), transform(sequence(0, size(w) - {k}), i -> xxhash64({parts})))"

    each = f"concat({', '.join(map(of, widths))})" if len(widths) > 1 else of(widths[0])
    return F.expr(f"coalesce(transform(array(transform({words}, x -> xxhash64(x))), w -> {each})[0], cast(array() as array<bigint>))")


def with_group(
    rows: DataFrame, keys: list[str], spread: list[str], values: dict[str, tuple[Column, Column]], keep: Column
) -> DataFrame:
    """``rows`` with the aggregates of their group, for groups that ``keep`` holds for (else null).

    values: name -> (aggregate over rows, aggregate that merges partial values of that name). keys must not be
    null. A group's rows are dealt over salts() parts by a hash of ``spread`` for the aggregation and for the
    join back, and its values are copied only to the parts it has: a third of all rows in one group stays spread.
    """
    parted = rows.withColumn("_part", F.pmod(F.xxhash64(*spread), F.lit(salts(rows.sparkSession))).cast("int"))
    partial = parted.groupBy(*keys, "_part").agg(*[first.alias(n) for n, (first, _) in values.items()])
    merged = partial.groupBy(*keys).agg(*[then.alias(n) for n, (_, then) in values.items()], F.collect_set("_part").alias("_parts"))
    groups = merged.filter(keep).select(*keys, *values, F.explode("_parts").alias("_part"))
    return parted.join(groups, [*keys, "_part"], "left").drop("_part")


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)
