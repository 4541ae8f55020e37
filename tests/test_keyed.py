"""Bucketed tables: what a delivery reads and writes, writers that meet, versions that go."""

import os

import pytest
from pyspark.sql import functions as F

from loomlake.operators import keyed, merge
from loomlake.operators.keyed import KeyedTable, Refused


def files(root) -> dict[str, int]:
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def rows(spark, ids, mark):
    return spark.createDataFrame([(i, f"v{i} {mark}" * 20, f"h{i}{mark}") for i in ids], "id long, v string, h string")


def test_a_small_delivery_rewrites_its_buckets_only(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", buckets=200)
    t.write(rows(spark, range(4000), "a"), ["id"])
    before = files(f"{tmp_path}/t")
    assert len(before) == 200
    got = t.upsert(rows(spark, [5, 17, 3999, 4000], "b"), ["id"], "h")
    assert got == {"inserted": 1, "updated": 3, "kept": 3997, "changed": 4, "total": 4001}
    fresh = {f: n for f, n in files(f"{tmp_path}/t").items() if f not in before}
    assert len(fresh) <= 4 and sum(fresh.values()) < sum(before.values()) / 25 and set(before) <= set(files(f"{tmp_path}/t"))
    assert {r["id"]: r["h"] for r in t.read().collect()} == {i: f"h{i}{'b' if i in (5, 17, 3999, 4000) else 'a'}" for i in range(4001)}
    assert t.read(1).count() == 4000 and t.rows() == 4001
    again = t.upsert(rows(spark, [5, 17], "b"), ["id"], "h")
    assert again["changed"] == 0 and t.numbers() == [1, 2] and len(files(f"{tmp_path}/t")) == len(before) + len(fresh)
    assert t.history().filter("number = 2").head()["buckets_written"] == len(fresh)
    plan = t._rows(t.version(), {next(iter(t.version().parts))}).inputFiles()
    assert len(plan) == 1


def test_metrics_and_rows_are_those_of_a_merge(spark, tmp_path):
    old, new = rows(spark, range(60), "a"), rows(spark, range(40, 90), "b").union(rows(spark, range(50, 55), "a")).withColumn("more", F.col("id") * 2)
    t = KeyedTable(spark, f"file://{tmp_path}/t", buckets=7)
    t.write(old, ["id"])
    got = t.upsert(new, ["id"], "h")
    merged = merge.merge(old, new, ["id"], "h")
    assert got == merge.merge_metrics(merged).head().asDict()
    assert sorted(map(tuple, t.read().collect())) == sorted(map(tuple, merged.drop("_action").collect()))
    assert t.resize(3) and len(t.version().parts) <= 3 and sorted(map(tuple, t.read().collect())) == sorted(map(tuple, merged.drop("_action").collect()))
    assert t.upsert(spark.createDataFrame([(None, "x", "y")], "id long, v string, h string"), ["id"], "h")["changed"] == 0
    with pytest.raises(ValueError):
        t.upsert(new, ["v"], "h")


def test_a_merge_shuffles_rows_once_and_keeps_what_only_the_table_has(spark, tmp_path):
    old = rows(spark, range(30), "a").withColumn("mine", F.col("id") + 0.5)
    new = rows(spark, [*range(20, 40), 25, 25], "b").union(rows(spark, range(10, 15), "a"))
    bucket = {"_bucket": keyed.bucket_of(["id"], 4)}
    for hashed in ("h", None):
        want, got = merge.merge(old, new, ["id"], hashed), merge.merge_distinct(old, new, ["id"], hashed, None, bucket)
        assert sorted(map(repr, got.drop("_bucket").collect())) == sorted(map(repr, want.collect()))
        assert got._jdf.queryExecution().sparkPlan().toString().count("Window") == 1
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    t = KeyedTable(spark, f"file://{tmp_path}/t", buckets=4)
    t.write(old, ["id"])
    t.upsert(new, ["id"], "h")
    assert {r["id"]: r["mine"] for r in t.read().collect()} == {i: i + 0.5 if i < 30 else None for i in range(40)}


def test_types_that_change_reach_every_bucket(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", buckets=9)
    t.write(spark.createDataFrame([(str(i), i, "a") for i in range(30)], "id string, n int, h string"), ["id"])
    assert t.upsert(spark.createDataFrame([("3", 2**40, "b")], "id string, n long, h string"), ["id"], "h")["changed"] == 1
    assert {r["id"]: r["n"] for r in t.read().collect()} == {str(i): 2**40 if i == 3 else i for i in range(30)} and dict(t.read().dtypes)["n"] == "bigint"


@pytest.mark.parametrize("same", [True, False])
def test_of_two_writers_one_is_refused_and_tries_again(spark, tmp_path, monkeypatch, same):
    path = f"file://{tmp_path}/t"
    KeyedTable(spark, path, buckets=50).write(rows(spark, range(100), "a"), ["id"])
    mine, other, refused = [1], [1] if same else [2], []
    commit = KeyedTable._commit

    def late(self, new):
        if self is first and not refused:
            refused.append(new.number)
            assert KeyedTable(spark, path).upsert(rows(spark, other, "other").withColumn("h", F.concat("h", F.lit("x"))), ["id"], "h")["updated"] == 1
            with pytest.raises(Refused):
                commit(self, new)
            raise Refused
        commit(self, new)

    monkeypatch.setattr(KeyedTable, "_commit", late)
    first = KeyedTable(spark, path)
    merged = []
    monkeypatch.setattr(keyed, "merge_distinct", lambda *a: merged.append(1) or merge.merge_distinct(*a))
    assert first.upsert(rows(spark, mine, "mine"), ["id"], "h")["updated"] == 1
    got = {r["id"]: r["h"] for r in first.read().collect()}
    assert got[1] == "h1mine" and (same or got[2] == "h2otherx") and len(got) == 100
    assert first.numbers() == [1, 2, 3] and len(merged) == (3 if same else 2)


def test_versions_beyond_the_last_few_go(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", buckets=5, keep=2)
    for k in range(5):
        t.upsert(rows(spark, range(k, k + 3), f"m{k}"), ["id"], "h")
    assert t.numbers() == [4, 5] and t.read().count() == 7 and t.read(4).count() == 6
    live = {f"_write={w}/_bucket={b}" for n in (4, 5) for b, w in t.version(n).parts.items()}
    assert {"/".join(f.split("/")[-3:-1]) for f in files(f"{tmp_path}/t")} == live
    os.makedirs(f"{tmp_path}/t/data/_write=dead/_bucket=1")
    assert t.vacuum(hours=1) == 0 and t.vacuum(hours=-1) == 1 and t.read().count() == 7
