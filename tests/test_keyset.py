"""The stream over a growing table: nothing twice, nothing missed, rows without a cursor, and what a batch reads."""

import datetime
import json

import pytest
from pyspark.sql import types as T

from loomlake.sources.keyset import KeysetReader, KeysetSource

SCHEMA = "k long, at timestamp_ntz, v string"


def at(h):
    return None if h is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)


def deliver(spark, path, rows, mode="append"):
    spark.createDataFrame([(k, at(h), f"v{k}") for k, h in rows], SCHEMA).coalesce(1).write.mode(mode).parquet(path)


def run(spark, path, out, mark):
    stream = spark.readStream.format("keyset").options(path=path, cursor="at", id="k").schema(SCHEMA).load()
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return sorted(r["k"] for r in spark.read.schema(SCHEMA).parquet(out).collect())


def test_a_growing_table_is_read_once(spark, tmp_path):
    spark.dataSource.register(KeysetSource)
    path, out, mark = (f"file://{tmp_path}/{x}" for x in ("t", "out", "mark"))
    deliver(spark, path, [(3, 1), (1, 2), (2, 2), (7, None)])
    assert run(spark, path, out, mark) == [1, 2, 3, 7]
    assert run(spark, path, out, mark) == [1, 2, 3, 7]
    deliver(spark, path, [(4, 2), (5, 9), (8, None), (6, 3)])
    deliver(spark, path, [(9, None)])
    assert run(spark, path, out, mark) == list(range(1, 10))
    assert run(spark, path, out, mark) == list(range(1, 10))
    deliver(spark, path, [(0, 2), (10, 1)])  # at or before the position: an incremental read doesn't see them
    assert run(spark, path, out, mark) == list(range(1, 10))


@pytest.mark.parametrize("cursor", ["at", "s"])
def test_only_row_groups_of_the_range_are_read(spark, tmp_path, cursor):
    for f in range(6):
        rows = [(10 * f + i, at(10 * f + i), f"{10 * f + i:05d}" if i or f != 3 else None) for i in range(10)]
        spark.createDataFrame(rows, "k long, at timestamp_ntz, s string").coalesce(1).write.parquet(f"{tmp_path}/t/part={f}")
    reader = KeysetReader(f"file://{tmp_path}/t", cursor, "k", ["k"])
    start, end = reader.initialOffset(), reader.latestOffset()
    assert json.loads(end["id"]) == 59 and json.loads(end["undated"]) == (30 if cursor == "s" else None)
    whole = reader.partitions(start, end)
    assert len(whole) == 6 and sorted(k for p in whole for b in reader.read(p) for k in b["k"].to_pylist()) == list(range(60))
    middle = {**end, "id": "35", "cursor": json.dumps((35 * 3600 + 19723 * 86400) * 10**6 if cursor == "at" else "00035")}
    later = reader.partitions(middle, end)
    assert len(later) == 3 and sorted(k for p in later for b in reader.read(p) for k in b["k"].to_pylist()) == list(range(36, 60))
    assert reader.partitions(end, end) == []


def test_a_table_without_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/t")
    reader = KeysetReader(f"{tmp_path}/t", "at", "k", T._parse_datatype_string(SCHEMA).names)
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
