"""Scopes, catalog, loops over batches, audits, log lines."""

import json
import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import logs
from loomlake.operators import audits, catalog, events, loops, scopes
from loomlake.operators import flatten as FL
from loomlake.plans import gate, operations
from loomlake.sources import cursors
from loomlake.storage import shared_path


@pytest.mark.parametrize(("text", "want"), [("a.b", ("a", "b")), ("a__b", ("a", "b")), ("b", (None, "b")), ("", (None, None)), (None, (None, None)), (".b", (None, "b")), ("a.", ("a", None)), ("a.b__c", ("a", "b__c"))])
def test_table_refs(text, want):
    assert scopes.table_ref(text) == want


def test_scopes_and_filters(spark):
    t = spark.createDataFrame([("d", "x"), ("d", "y"), ("e", "x"), (None, None)], "database string, collection string")
    count = lambda **k: scopes.in_scope(t, **k).count()
    assert [count(scope=None), count(scope="collection"), count(scope="database", table="d.x"), count(scope="table", table="d.x"), count(scope="table", table="d.x", collection="y"), count(scope="file", table="x")] == [4, 4, 2, 1, 1, 2]
    rows = spark.createDataFrame([(1, "f1", "k1"), (2, "f2", None), (3, None, "k3")], "id long, _RAW_FILE_ID string, _raw_object_key string")
    ids = lambda *a: sorted(r["id"] for r in scopes.of_batches(rows, *a).collect())
    assert ids() == ids([], []) == [1, 2, 3] and ids(["f1"], ["k3"]) == [1, 3] and ids(["f2"]) == [2]
    assert scopes.of_batches(rows.select("id"), ["f1"]).count() == 3


def test_data_sizes(spark):
    rows = spark.createDataFrame([(x,) for x in (0, 1, 1023, 1024, 1536, 2560, 1 << 20, 3 << 30)], "b long").select("b", catalog.data_size(F.col("b")).alias("s")).collect()
    assert [r["s"] for r in rows] == ["1B", "1B", "1023B", "1KB", "2KB", "2KB", "1MB", "3GB"]


def test_data_sizes_of_large_keys(spark, tmp_path):
    """The cube of a key beyond 2,097,151 is no long."""
    spark.createDataFrame([(1,), (1025,), (2097152,), (9000000,), (100000000,)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    got = {r["o_orderkey"]: r["size"] for r in operations.data_sizes(spark, str(tmp_path)).collect()}
    assert got == {1: "1B", 1025: "1GB", 2097152: "8589934592GB", 9000000: f"{round(9000000**3 / 2**30)}GB", 100000000: f"{round(100000000**3 / 2**30)}GB"}


def test_registered_tables_follow_their_folder(spark):
    paths = [shared_path(spark, "t") for _ in range(2)]
    for n, p in enumerate(paths):
        spark.range(n + 3).write.parquet(p)
    assert catalog.register_table(spark, "follows", paths[0]) and not catalog.register_table(spark, "follows", paths[0])
    assert spark.table("follows").count() == 3
    assert not catalog.register_table(spark, "follows", paths[1])
    assert spark.table("follows").count() == 4
    assert spark.read.parquet(paths[0]).count() == 3  # the files stay
    assert catalog._plain("s3a://b/x/") == catalog._plain("s3://b/x") == "s3://b/x".replace("//", "/")


def test_clean_loop_goes_on_after_a_failure(spark):
    root = shared_path(spark, "lake")
    docs = spark.createDataFrame([(str(i), f"f{i % 3}", "x" if i != 4 else "bad", [i, i]) for i in range(9)], "_id string, _raw_file_id string, amount string, tags array<int>")
    target, log = loops.Target("shop", "notes", root), events.EventLog(spark, f"{root}/log")
    fail = lambda rows: FL.clean_table(rows.withColumn("amount", F.when(F.col("amount") == "bad", F.raise_error(F.lit("token=abc"))).otherwise(F.col("amount"))), "shop__notes_clean")
    first = loops.process(spark, target, docs, ["f0", "f1", "f2"], "r1", 1, transform=fail, log=log)
    assert (first.status, first.processed, first.failed, first.rows) == ("failed", 2, 1, 6)
    state = loops.clean_states(spark, root).read().filter("status = 'failed'").collect()
    assert [r["file_id"] for r in state] == ["f1"] and "abc" not in state[0]["error"]
    then = loops.process(spark, target, docs, ["f0", "f1", "f2"], "r2", log=log)
    assert (then.status, then.processed, then.skipped, then.children) == ("success", 1, 2, 6)
    assert target.kept(spark).read().count() == 9 == then.total_rows
    assert target.kept(spark, "shop__notes_clean_quality").read().head()["distinct_keys"] == 9
    profile = {r["field_path"]: (r["occurrence_count"], r["total_rows"]) for r in target.kept(spark, "shop__notes_clean_profile").read().collect()}
    assert profile["amount"] == (9, 9) and profile["tags"] == (9, 9)
    assert {r["status"] for r in log.read().collect()} == {"success", "failed"}


def test_clean_loop_reads_a_group_once(spark):
    seen, schema = spark.sparkContext.accumulator(0), "_id string, xs array<string>, _raw_file_id string"

    def passing(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(f"i{i}", ["a", "b"], str(i % 2)) for i in range(40)], schema).mapInPandas(passing, schema)
    target = loops.Target("shop", "things", shared_path(spark, "lake"))
    got = loops.process(spark, target, rows, ["0", "1"], "r", 2)
    assert (got.status, got.processed, got.rows, got.children) == ("success", 2, 40, 80) and seen.value == 40


def test_raw_loop_of_a_source_without_cursor(spark):
    root, plan, at = shared_path(spark, "lake"), cursors.CursorPlan(cursors.SNAPSHOT, "_id"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    docs = spark.createDataFrame([(i, "x") for i in range(5)], "_id long, t string")
    got = [loops.collect(spark, docs, plan, root, "d", "c", f"r{i}", at) for i in range(2)]
    assert [(g.batches, g.rows, g.skipped) for g in got] == [(1, 5, 0), (0, 0, 1)]
    assert loops.collect(spark, docs.limit(0), plan, root, "d", "none", "r", at).batches == 0


def test_fields_beyond_the_column_limit_stay_as_json(spark):
    df = spark.createDataFrame([(1, 2, (3, 4))], "a int, b int, c struct<d:int,e:int>")
    plan = FL.plan_flatten(df.schema, max_columns=1)
    assert set(plan.raw_json) == {"b", "c"}
    row = FL.flatten(df, plan).head()
    assert row["b_raw_json"] == "2" and json.loads(row["c_raw_json"]) == {"d": 3, "e": 4}


def test_audits_of_nothing(spark):
    found = audits.audit(spark, {}, {})
    assert all(df.count() == 0 for df in found.values())
    schema = T._parse_datatype_string("status string, blocking boolean, bi_suitability string, is_child_table boolean, nested_columns int, readiness double, flattening double")
    assert audits.quality_summary(spark.createDataFrame([], schema)).head()["status"] == "unknown"


def test_log_lines():
    record = logging.LogRecord("x", logging.INFO, "f", 1, "open %s password=hunter2", ("mongodb://a:b@h/",), None, "load")
    record.layer = {"api_key": "k", "rows": 3}
    line = json.loads(logs.JsonFormatter("svc").format(record))
    assert line["message"] == "open mongodb://***:***@h/ password=***" and line["layer"] == {"api_key": "***", "rows": 3} and line["service"] == "svc"


def test_schema_prefix_is_taken_from_names_only(spark):
    spark.range(2).createOrReplaceTempView("px__t_analytics")
    rows = gate.gated(spark, "SELECT 'delta.silver.px__t_analytics' AS x, a.id FROM delta.silver.px__t_analytics a JOIN silver.\"px__t_analytics\" b ON a.id = b.id", {"px__t_analytics"}).collect()
    assert [r["x"] for r in rows] == ["delta.silver.px__t_analytics"] * 2
