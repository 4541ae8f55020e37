"""From source documents to clean tables: cursors, files, bronze names, flattening, child tables, upserts."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.operators import flatten as FL
from loomlake.operators import profile as P
from loomlake.operators.keyed import KeyedTable
from loomlake.sources import bronze, cursors, documents

OID = ["%024x" % i for i in range(5)]
T1, T2 = datetime.datetime(2024, 1, 1, 10), datetime.datetime(2024, 1, 2, 10)


@pytest.mark.parametrize(("rows", "schema", "configured", "strategy", "field", "warns"), [
    ([(OID[0], T1), (OID[1], T2)], "_id string, updatedAt timestamp", "AUTO", cursors.TIMESTAMP, "updatedAt", False),
    ([(OID[0], T1)], "_id string, createdAt timestamp", "updatedAt", cursors.TIMESTAMP, "createdAt", "updatedAt"),
    ([(OID[0],), (OID[1],)], "_id string", "AUTO", cursors.OBJECT_ID, "_id", False),
    ([("a",), ("b",)], "_id string", "AUTO", cursors.SNAPSHOT, None, "no cursor"),
    ([(OID[0], "2024-01-01T10:00:00"), (OID[1], None)], "_id string, updatedAt string", "updatedAt", cursors.TIMESTAMP, "updatedAt", "lack"),
    ([(OID[0], "soon")], "_id string, updatedAt string", "updatedAt", cursors.OBJECT_ID, "_id", "updatedAt"),
    ([], "_id string, updatedAt timestamp", "AUTO", cursors.SNAPSHOT, None, "no documents"),
])
def test_cursor_detection(spark, rows, schema, configured, strategy, field, warns):
    plan = cursors.detect_cursor(spark.createDataFrame(rows, schema), configured)
    assert (plan.strategy, plan.field) == (strategy, field)
    assert bool(plan.warnings) == bool(warns) and (not warns or warns in " ".join(plan.warnings))


def test_tokens():
    plan = cursors.CursorPlan(cursors.TIMESTAMP, "at")
    assert cursors.decode_token(cursors.encode_token(plan, "2024-01-01T00:00:00", "7")) == ("2024-01-01T00:00:00", "7")
    assert cursors.decode_token("2024-01-01") == ("2024-01-01", None) and cursors.decode_token(None) == (None, None) and cursors.decode_token("{bad") == ("{bad", None)
    assert cursors.encode_token(cursors.CursorPlan(cursors.OBJECT_ID, "_id"), None, OID[0]) == OID[0]


def test_pages_cover_everything_once(spark):
    rows = [(i, datetime.datetime(2024, 1, 1 + i // 7)) for i in range(40)] + [(99, None)]
    docs = spark.createDataFrame(rows, "_id long, at timestamp_ntz")
    plan, token, seen = cursors.CursorPlan(cursors.TIMESTAMP, "at"), None, []
    while page := cursors.next_page(docs.filter("at IS NOT NULL"), plan, token, 9).withColumn("t", cursors.token_column(plan)).collect():
        seen += [r["_id"] for r in page]
        token = page[-1]["t"]
    assert seen == list(range(40))
    assert [r["_id"] for r in cursors.without_cursor(docs, plan).collect()] == [99]
    assert cursors.batch_count(0) == 1 and cursors.batch_count(2505, 1000) == 3
    assert cursors.numbered(docs.filter("at IS NOT NULL"), ["at", "_id"], 9).groupBy("batch_no").count().count() == 5


def test_numbers_fit_where_shuffles_are_merged_anew(spark):
    """A wide table: sorted once with its texts and once without them, its partitions would be merged in other ways."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"/{i}")), 256) for i in range(20)])
    docs = spark.range(6000).select(((F.col("id") * 7919) % 6000).alias("_id"), text.alias("v"))
    least = "spark.sql.shuffle.partitions"
    before = spark.conf.get(least)
    try:
        spark.conf.set(least, "32")
        got = cursors.numbered(docs, ["_id"], 100).select("_id", "batch_no", F.length("v")).collect()
    finally:
        spark.conf.set(least, before)
    assert sorted((r["_id"], r["batch_no"]) for r in got) == [(i, i // 100 + 1) for i in range(6000)]


def test_fingerprints_follow_content(spark):
    docs = spark.createDataFrame([(i, T1, f"v{i}", i // 2) for i in range(4)], "_id long, at timestamp_ntz, v string, b int")
    plan = cursors.CursorPlan(cursors.TIMESTAMP, "at")
    one = {r["b"]: r for r in cursors.fingerprints(docs, plan, ["b"]).collect()}
    two = {r["b"]: r for r in cursors.fingerprints(docs.withColumn("v", F.when(F.col("_id") == 3, "new").otherwise(F.col("v"))).repartition(3), plan, ["b"]).collect()}
    assert one[0] == two[0] and one[1]["checksum"] != two[1]["checksum"] and one[1]["row_count"] == 2
    assert cursors.decode_token(one[0]["min_cursor"])[1] == "0" and cursors.decode_token(one[0]["max_cursor"])[1] == "1"


def test_raw_files(spark, tmp_path):
    at, path = F.lit("2024-05-06 07:08:09").cast("timestamp"), f"file://{tmp_path}/db/coll"
    docs = documents.enveloped(spark.createDataFrame([(1, "a\nb"), (2, None)], "_id long, x string"), "s", "S", "db", "coll", at)
    assert not documents.exists(spark, path)
    documents.write_raw(docs, path, at)
    back = documents.read_raw(spark, path).collect()
    assert {(r["_id"], r["x"], r["__source_db"], str(r["dt"]), int(r["hr"])) for r in back} == {(1, "a\nb", "db", "2024-05-06", 7), (2, None, "db", "2024-05-06", 7)}
    assert documents.reusable(spark, path, 2) and not documents.reusable(spark, path, 3)
    (tmp_path / "db/coll/dt=2024-05-06/hr=07/bad.txt").write_text('{"a": 1}\nnot json\n')
    assert documents.verify_raw(spark, path).agg(F.sum("bad_lines")).head()[0] == 1
    found = documents.discover_tables(spark, f"file://{tmp_path}").collect()
    assert [(r["database"], r["collection"]) for r in found] == [("db", "coll")]
    known = spark.createDataFrame([("db", "coll", "p1"), ("db", "other", "p2")], "database string, collection string, path string")
    assert {(r["collection"], r["origin"]) for r in documents.merged_discovery(known, documents.discover_tables(spark, f"file://{tmp_path}")).collect()} == {("coll", "metadata+files"), ("other", "metadata")}
    files = lambda rows: spark.createDataFrame(rows, "file string, row_count long")
    got = documents.reconcile_files(files([("a", 1), ("b", 2), ("c", 3)]), files([("b", 2), ("c", 4), ("d", 1)]))
    assert dict(tuple(r) for r in got.collect()) == {"a": "missing", "b": "ok", "c": "row_count_differs", "d": "orphan"}
    assert documents.folder_stats(spark, f"file://{tmp_path}").head()["database"] == "db"


def test_observed_paths(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": {"c": [1, 2]}}',), ('{"a": "x", "d": [{"e": 1}]}',)], "value string")
    assert documents.observed_paths(lines) >= {"a", "b", "b.c", "d", "d[].e"}


def test_nested_names(spark):
    df = spark.sql("SELECT 1 AS `a.b`, named_struct('x y', 2, 'x-y', array(named_struct('1', 3))) AS `n n`, map('k k', named_struct('q r', 1)) AS m")
    out = bronze.sanitized(df)
    assert out.columns == ["a_b", "n_n", "m"] and out.schema["n_n"].dataType.names == ["x_y", "x_y_2"]
    assert out.select("n_n.x_y_2.col_1").head()[0] == [3]
    assert {r["bronze_field"]: r["reason"] for r in bronze.column_mappings(df, "k").collect()}["a_b"].startswith("invalid_characters")


def test_record_hash_follows_content(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "_id long, v string")
    now = F.current_timestamp()
    one = bronze.bronze_table(docs, "r1", now).select("_id", "_record_hash").collect()
    two = bronze.bronze_table(docs.select("v", "_id"), "r2", now).select("_id", "_record_hash").collect()
    assert dict(map(tuple, one)) == dict(map(tuple, two)) and len({r[1] for r in one}) == 2


NESTED = "struct<_id:string,a:struct<b:struct<c:struct<d:struct<e:int>>>>,items:array<struct<sku:string,qty:int,tags:array<string>>>,tags:array<string>,m:map<string,int>,email:string,a_b:int>"


def test_flatten_plan(spark):
    schema = T._parse_datatype_string(NESTED)
    plan = FL.plan_flatten(schema, "shop__x_clean", depth=3)
    assert plan.children == {"items": "shop__x_items_clean", "tags": "shop__x_tags_clean"} and set(plan.raw_json) == {"a.b.c", "m"} and plan.pii == ["email"]
    assert list(plan.columns) == ["_id".strip("_"), "a_b_c_raw_json", "items_count", "tags_count", "m_raw_json", "email", "a_b"]
    assert FL.plan_flatten(schema, max_columns=2).raw_json and plan.complexity == 8 * 2 + 3 * 2 and plan.readiness() == 92
    df = spark.createDataFrame([("1", ((((5,),),),), [("s", 1, ["t"]), None, ("u", 2, None)], None, {"k": 1}, " e ", 3), ("2", None, [], ["p", None], None, None, None)], schema)
    rows = FL.flatten(df, plan).orderBy("id").collect()
    assert rows[0]["items_count"] == 3 and rows[0]["email"] == "e" and rows[0]["m_raw_json"] == '{"k":1}' and rows[1]["a_b_c_raw_json"] is None
    items = FL.child_table(df, "items", F.col("_id")).orderBy("child_index").collect()
    assert [(r["parent_record_id"], r["child_index"], r["sku"], r["tags_count"]) for r in items] == [("1", 0, "s", 1), ("1", 2, "u", None)]
    tags = FL.child_table(df, "tags", F.col("_id")).collect()
    assert [(r["child_index"], r["value"]) for r in tags] == [(0, "p")]
    need = {"child_record_id", "parent_record_id", "parent_record_hash", "source_db", "source_collection", "source_table", "child_path", "child_index"}
    assert need <= set(items[0].asDict()) and set(FL.child_tables(df, F.col("_id"), "shop__x_clean")) == set(plan.children.values())
    assert P.missing_child_tables(schema, "shop__x_clean", {"shop__x_tags_clean"}) == ["shop__x_items_clean"]


def test_schema_evolution_and_upserts(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/users")
    day1 = spark.createDataFrame([("1", "a", "h1"), ("2", "b", "h2"), (None, "x", "h0"), ("1", "a", "h1")], "id string, v string, h string")
    assert not table.exists() and table.upsert(day1, ["id"], "h")["inserted"] == 2
    assert table.upsert(day1, ["id"], "h") == {"inserted": 0, "updated": 0, "kept": 2, "changed": 0, "total": 2}
    day2 = spark.createDataFrame([("2", "B", "h3", True), ("3", "c", "h4", None)], "id string, v string, h string, consent boolean")
    assert table.upsert(day2, ["id"], "h")["changed"] == 2
    assert {tuple(r) for r in table.read().select("id", "v", "consent").collect()} == {("1", "a", None), ("2", "B", True), ("3", "c", None)}
    assert table.upsert(day2.limit(0), ["id"], "h")["total"] == 3


def test_domain_tables_miss_nothing(spark):
    only = spark.createDataFrame([("1",)], "_id string")
    for name in ("users", "orders", "products", "payments"):
        row = FL.transform(only, name, f"shop__{name}_clean").head().asDict()
        assert list(row.values())[0] == "1" and row["silver_record_hash"]
    kinds = FL.transform(spark.sql("SELECT '1' AS _id, ' Ae ' AS country, ' X@Y ' AS email"), "users", "t").head()
    assert (kinds["country_code"], kinds["country_name"], kinds["email"]) == ("AE", "United Arab Emirates", "x@y")


def test_drift(spark):
    a, b = T._parse_datatype_string("x int, y string"), T._parse_datatype_string("x int, z string")
    assert P.schema_drift(spark, None, a).head()["change_type"] == "initial" and P.schema_drift(spark, a, a).head()["change_type"] == "unchanged"
    row = P.schema_drift(spark, a, b).head()
    assert (row["new_fields"], row["removed_fields"], len(row["schema_hash"])) == (["z:string"], ["y:string"], 12)
    assert P.schema_paths(T._parse_datatype_string("a array<struct<b: array<int>>>")) >= {"a", "a[].b"}
