"""Profiles by batch, paths of documents, and tables compared by content."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomlake.operators import census, contents, partials, profile
from loomlake.storage import shared_path


def test_merged_profiles_count_as_one_over_the_whole(spark):
    rows = [(i, None if i % 3 else float(i), {"a": "x" if i % 2 else None}, [i], i % 5 if i % 10 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v double, s struct<a:string>, xs array<long>, b int")
    store = partials.ProfileStore(spark, shared_path(spark, "p"))
    assert store.read().count() == 0
    for part in ("b IN (0, 1) OR b IS NULL", "b >= 2", "b = 3"):  # the last batch again
        store.add(df.filter(part), "b")
    got = {r["field_path"]: r for r in store.read().collect()}
    whole = {r["field_path"]: r for r in profile.field_profile(df.drop("b")).collect()}
    assert set(got) == set(whole)
    for path, r in got.items():
        assert (r["occurrence_count"], r["total_rows"], r["occurrence_percent"], r["detected_type"]) == tuple(whole[path][c] for c in ("occurrence_count", "total_rows", "occurrence_percent", "detected_type"))
    assert abs(got["id"]["distinct_estimate"] - 500) < 25 and got["id"]["least"] == 0 and got["id"]["most"] == 499 and abs(got["id"]["quantiles"][1] - 250) < 25
    assert got["xs"]["distinct_estimate"] is None and got["s.a"]["distinct_estimate"] == 1 and got["s.a"]["quantiles"] is None
    store.add(spark.createDataFrame([(1, "new", "9")], "id long, v string, b string"), "b")
    got = {(r["field_path"], r["detected_type"]): r for r in store.read().collect()}
    assert got["v", "string"]["occurrence_count"] == 1 and got["v", "double"]["total_rows"] == 501


def plain_paths(docs):
    out = {}

    def walk(i, path, v):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}[type(v)]
        out.setdefault((path, kind), []).append(i)
        for k, x in v.items() if isinstance(v, dict) else ():
            walk(i, f"{path}.{k}" if k.replace("_", "a").isalnum() and k.isascii() else f"{path}.{json.dumps(k, ensure_ascii=False)}", x)
        for x in v if isinstance(v, list) else ():
            walk(i, f"{path}[]", x)

    for i, d in enumerate(docs):
        walk(i, "$", d)
    return {(p, k, len(v), len(set(v))) for (p, k), v in out.items()}


def test_paths_of_documents(spark):
    docs = [{"a": 1, "b": [1, "x", [], [2.5, None]]}, {"a": "s", "c": {}, "b": {"a b": {"ü": [{"d": True}] * 3}}}, [], 7, "text", None, {"a": None, "deep": [[[[[{"z": 1}]]]]]}]
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{bad",), (None,)], "value string")
    got = {tuple(r) for r in census.path_census(lines).collect()}
    assert got == plain_paths(docs) | {("$", "invalid", 2, 2)}
    assert census.path_census(lines.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [5000, 3])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_differences_equal_a_plain_comparison(spark, monkeypatch, leaf, kind):
    monkeypatch.setattr(contents, "LEAF", leaf)
    monkeypatch.setattr(contents, "FAN", 8)
    rng = random.Random(leaf)
    left = [(rng.choice([None, *range(-300, 300)]), rng.choice("abc")) for _ in range(900)] + [((1 << 63) - 1, "z"), (-(1 << 63), "z")]
    right = [(k, v if rng.random() > 0.02 else "d") for k, v in left if rng.random() > 0.02] + [(7, "a"), (10**12, "n")]
    left += [(5555, "m")]
    frames = [spark.createDataFrame(r, "k long, v string").withColumn("k", F.col("k").cast(kind)).repartition(3) for r in (left, right)]
    got = {(r["key"], r["left_rows"], r["right_rows"]): r["status"] for r in contents.differences(*frames, "k").collect()}
    want, by = {}, [{}, {}]
    for b, rows in zip(by, (left, right), strict=True):
        for k, v in rows:
            b.setdefault(k if kind == "long" or k is None else str(k), []).append(v)
    for k in {*by[0], *by[1]}:
        x, y = (sorted(b.get(k, [])) for b in by)
        if x != y:
            want[k, len(x), len(y)] = "missing" if not y else "extra" if not x else "repeated" if set(x) == set(y) and len(set(x)) <= 2 else "changed"
    assert {k: v for k, v in got.items() if want.get(k) != v} == {} == {k: v for k, v in want.items() if k not in got}
    assert {"missing", "extra", "changed"} <= set(got.values())
    assert contents.differences(frames[0], frames[0].orderBy("v"), "k").count() == 0
    assert contents.differences(frames[0].limit(0), frames[0].limit(0), "k").count() == 0


def test_only_ranges_that_differ_are_read_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contents, "LEAF", 50)
    path = f"file://{tmp_path}/t"
    spark.range(100_000).withColumn("v", F.col("id") * 2).repartitionByRange(50, "id").write.parquet(path)
    one = spark.read.parquet(path)
    other = spark.range(100_000).withColumn("v", F.when(F.col("id") == 77_777, 1).otherwise(F.col("id") * 2))
    found = contents.differences(one, other, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and [tuple(r) for r in found.collect()] == [(77_777, "changed", 1, 1)]
