"""Keys that were seen: exact whatever the bits say, and what is read of history."""

import random

import pytest
from pyspark.sql import functions as F

from loomlake.streaming.seen import SeenKeys

SCHEMA = "k long, s string, v int"


def rows_of(spark, path):
    return sorted((r["k"], r["s"]) for r in spark.read.schema(SCHEMA + ", batch int, part int").option("basePath", path).parquet(path).collect() if r["k"] is not None)


@pytest.mark.parametrize("bits", [1 << 27, 64, 1])
def test_exact_with_collisions(spark, tmp_path, bits):
    rng, path, want = random.Random(bits), f"file://{tmp_path}/t", {}
    for batch in range(4):
        rows = [(rng.randrange(60), rng.choice("ab"), batch) for _ in range(40)]
        for again in range(2 if batch == 2 else 1):  # a batch that runs again
            SeenKeys(spark, path, ["k", "s"], bits, 4).append(spark.createDataFrame(rows, SCHEMA), batch)
        for k, s, _ in rows:
            want.setdefault((k, s), batch)
        assert rows_of(spark, path) == sorted(want)
    found = {(r["k"], r["s"]): r["v"] for r in spark.read.option("basePath", path).parquet(path).collect()}
    assert found == want


def test_history_is_read_only_where_there_are_hits(spark, tmp_path, monkeypatch):
    path, asked = f"file://{tmp_path}/t", []
    old = SeenKeys.old_keys
    monkeypatch.setattr(SeenKeys, "old_keys", lambda self, parts, b: asked.append(parts) or old(self, parts, b))
    seen = SeenKeys(spark, path, ["k"], parts=8)
    seen.append(spark.range(100).selectExpr("id AS k"), 0)
    seen.append(spark.range(200, 300).selectExpr("id AS k"), 1)
    assert asked == []
    seen.append(spark.createDataFrame([(5,), (900,), (None,)], "k long"), 2)
    assert len(asked) == 1 and len(asked[0]) == 1
    read = old(seen, asked[0], 2)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert {f"part={asked[0][0]}/" in r[0] for r in read.select(F.input_file_name()).distinct().collect()} == {True}
    seen.append(spark.createDataFrame([(None,), (5,)], "k long"), 3)
    got = [r["k"] for r in spark.read.option("basePath", path).parquet(path).collect()]
    assert len(got) == 203 and got.count(None) == 2 and sorted(k for k in got if k is not None) == [*range(100), *range(200, 300), 900]
