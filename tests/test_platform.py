"""Matching and reports, charts, lineage, streams, run state: rules on small inputs."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.operators import charts, lineage, matching, reports, state, views
from loomlake.operators import profile as P
from loomlake.operators.keyed import KeyedTable
from loomlake.streaming import incremental

VIEWS = {
    "crm__applications_analytics": "application_id string, company_approved_name string, created_at timestamp, application_status string, submitted_by_email_hash string, "
    "visa_used int, waiting_time bigint, silver_row_id string",
    "crm__stakeholders_analytics": "stakeholder_name_hash string, designation string, nationality string, dob string, status string",
}


def schemas():
    return {k: T._parse_datatype_string(v) for k, v in VIEWS.items()}


def scored(spark, labels, **kw):
    asked = matching.field_table(spark, [(x, True) for x in labels])
    rows = matching.ranked(matching.score(asked, matching.column_table(spark, schemas()), **kw)).filter("rank = 1").collect()
    return {r["field"]: r for r in rows}


def test_tiers(spark):
    got = scored(spark, ["application_id", "Application ID", "Application Number", "Company Name", "Designation", "Submitted By Email", "DOB", "Waiting", "zzzz qqqq"])
    kinds = {k: (r["column"], r["match_type"]) for k, r in got.items()}
    assert kinds["application_id"] == ("application_id", "exact") and kinds["Application ID"] == ("application_id", "normalized")
    assert kinds["Application Number"] == ("application_id", "normalized") and kinds["Company Name"] == ("company_approved_name", "business_alias")
    assert kinds["Designation"] == ("designation", "exact") and kinds["DOB"] == ("dob", "exact")
    assert kinds["Submitted By Email"][0] == "submitted_by_email_hash" and got["Submitted By Email"]["confidence"] <= 0.91 and "a hashed column" in got["Submitted By Email"]["warnings"]
    assert kinds["Waiting"][0] == "waiting_time" and got["Waiting"]["confidence"] < got["Designation"]["confidence"]
    assert "zzzz qqqq" not in got or got["zzzz qqqq"]["confidence"] < 0.5


def test_history_counts(spark):
    used = spark.createDataFrame([("freshlabel", "visaused")], "field_norm string, column_norm string")
    plain = scored(spark, ["Fresh Label"]).get("Fresh Label")
    assert plain is None or plain["match_type"] in ("fuzzy", "weak", "token")
    asked, columns = matching.field_table(spark, [("Visa Fresh Label", True)]), matching.column_table(spark, schemas())
    norm = spark.createDataFrame([("visafreshlabel", "visaused")], used.schema)
    best = matching.ranked(matching.score(asked, columns, norm)).filter("rank = 1").head()
    assert (best["column"], best["match_type"]) == ("visa_used", "historical")


def test_reports(spark):
    frames = {k: spark.createDataFrame([], s) for k, s in schemas().items()}
    template = reports.match_template(spark, "My Report", [("Application Number", True), ("Company Name", True), ("Application Status", True), ("Remark", False)], schemas())
    chosen = {m.label: m.column for m in template.mappings}
    assert chosen["Application Number"] == "application_id" and chosen["Application Status"] == "application_status" and chosen["Remark"] is None
    assert not [t for level, t in reports.validate(template, schemas()) if level == "error"]
    made = reports.generate(spark, template, frames)
    assert made["view"] == "report_my_report_analytics" and made["preview"].columns == [m.label for m in template.mappings]
    assert made["nulls"].head()["Remark"] == 0
    with pytest.raises(FileExistsError):
        reports.generate(spark, template, frames)
    assert reports.generate(spark, template, frames, replace_existing=True)
    spark.catalog.dropTempView(made["view"])


def test_auto_fix(spark):
    a, b = VIEWS
    broken = reports.Template("x", [reports.Mapping("Application Number", True, a, "application_id"), reports.Mapping("Status", True, b, "status"), reports.Mapping("Waiting Time", True, a, "gone")])
    assert [t for level, t in reports.validate(broken, schemas()) if level == "error"]
    fixed = reports.auto_fix(spark, broken, schemas())
    assert {m.view for m in fixed.mappings} == {a} and [m.column for m in fixed.mappings] == ["application_id", "application_status", "waiting_time"] and fixed.notes
    empty = reports.Template("x", [reports.Mapping("zzzz", True, None, None)])
    with pytest.raises(ValueError):
        reports.generate(spark, empty, {k: spark.createDataFrame([], s) for k, s in schemas().items()})


def test_charts(spark):
    df = spark.createDataFrame([("1", "2024-01-01T05:00:00Z", "new", 2.0), ("2", "2024-01-01T23:00:00Z", "old", 3.0), ("3", "never", "new", None)], "id string, createdAt string, status string, amount double")
    plan = charts.plan_charts("shop__orders_analytics", df.schema)
    assert [(c.kind, c.column) for c in plan] == [("count", "id"), ("trend", "createdAt"), ("breakdown", "status"), ("total", "amount")]
    data = [charts.chart_data(df, c).collect() for c in plan]
    assert data[0][0]["records"] == 3 and [(r["period"].date().isoformat(), r["records"]) for r in data[1]] == [("2024-01-01", 2)]
    assert [tuple(r) for r in data[2]] == [("new", 2), ("old", 1)] and data[3][0][0] == 5.0
    assert [c.kind for c in charts.plan_charts("v", T._parse_datatype_string("x_hash string"))] == ["count", "sample"] and charts.plan_charts("v", T.StructType()) == []
    assert charts.chart_payload(plan[2], "v")["groupby"] == ["status"]
    m = [charts.metric("n", "COUNT", "id"), charts.metric("s", expression="sum(amount) * 2")]
    assert tuple(df.agg(*m).head()) == (3, 10.0)


def test_lineage(spark):
    graph = lineage.edges(spark, {("shop", "orders"): T._parse_datatype_string("_id string, items array<struct<a:int>>")}, {"daily": "shop__orders_analytics"})
    kinds = {r["asset"]: (r["upstreams"], r["downstreams"]) for r in lineage.assets(graph).collect()}
    assert kinds["silver.shop__orders_clean"] == (1, 2) and kinds["report.daily"] == (1, 0)
    up = {r["asset"] for r in lineage.reachable(graph, "report.daily", down=False).collect()}
    assert "source.shop.orders" in up and "silver.shop__orders_items_clean" not in up


def test_lineage_of_a_thousand_steps(spark):
    n = 1000
    chain = spark.range(n).select(F.concat(F.lit("a"), F.col("id")).alias("upstream"), F.concat(F.lit("a"), F.col("id") + 1).alias("downstream"))
    cycle = spark.createDataFrame([("a5", "a3"), ("a3", "b"), ("x", "y"), ("a1", "a900"), ("b", "b")], "upstream string, downstream string")
    got = {r["asset"]: r["distance"] for r in lineage.reachable(chain.union(cycle), "a0").collect()}
    assert got == {f"a{i}": min(i, 2 + abs(i - 900) if i >= 900 else i) for i in range(n + 1)} | {"b": 4}
    assert {r["asset"]: r["distance"] for r in lineage.reachable(chain, "a2", down=False).collect()} == {"a2": 0, "a1": 1, "a0": 2}
    assert [tuple(r) for r in lineage.reachable(chain, "nowhere").collect()] == [("nowhere", 0)]


def test_lineage_of_columns(spark):
    t = spark.createDataFrame([(1, "a", [1, 2], 5)], "id int, name string, xs array<int>, w int")
    t.createOrReplaceTempView("lt")
    t.withColumnRenamed("id", "key").createOrReplaceTempView("lu")
    other = "SELECT 1 AS z"
    made = {
        "plain": spark.sql("SELECT id, upper(name) AS name, w + id AS s, w AS v FROM lt WHERE xs IS NOT NULL"),
        "joined": spark.sql("SELECT a.id, b.key AS k, coalesce(a.w, b.w) AS w FROM lt a JOIN lu b ON a.id = b.key"),
        "stacked": spark.sql("SELECT id, w FROM lt UNION ALL SELECT key, key + 1 FROM lu"),
        "grouped": spark.sql("WITH c AS (SELECT name, id FROM lt) SELECT name, count(DISTINCT id) AS n FROM c GROUP BY name"),
        "burst": spark.sql("SELECT id, x FROM lt LATERAL VIEW explode(xs) e AS x"),
        "ranked": spark.sql("SELECT id, rank() OVER (PARTITION BY name ORDER BY w) AS r FROM lt"),
        "nested": spark.sql("SELECT id, (SELECT max(w) FROM lu WHERE lu.key = lt.id) AS m FROM lt"),
        "outside": spark.sql(f"SELECT z FROM ({other})"),
        "cubed": spark.sql("SELECT name, sum(w) AS w FROM lt GROUP BY CUBE (name)"),
    }
    got = {}
    for r in lineage.column_edges(spark, made, {"lt", "lu"}).collect():
        got.setdefault((r["downstream"], r["downstream_column"]), set()).add((f"{r['upstream']}.{r['upstream_column']}", r["derived"]))
    assert got == {
        ("plain", "id"): {("lt.id", False)}, ("plain", "name"): {("lt.name", True)}, ("plain", "s"): {("lt.w", True), ("lt.id", True)}, ("plain", "v"): {("lt.w", False)},
        ("joined", "id"): {("lt.id", False)}, ("joined", "k"): {("lu.key", False)}, ("joined", "w"): {("lt.w", True), ("lu.w", True)},
        ("stacked", "id"): {("lt.id", False), ("lu.key", False)}, ("stacked", "w"): {("lt.w", False), ("lu.key", True)},
        ("grouped", "name"): {("lt.name", False)}, ("grouped", "n"): {("lt.id", True)},
        ("burst", "id"): {("lt.id", False)}, ("burst", "x"): {("lt.xs", True)},
        ("ranked", "id"): {("lt.id", False)}, ("ranked", "r"): {("lt.name", True), ("lt.w", True)},
        ("nested", "id"): {("lt.id", False)}, ("nested", "m"): {("lu.w", True), ("lt.id", True)},
        ("cubed", "name"): got["cubed", "name"], ("cubed", "w"): {("lt.w", True)},
    }
    assert {x for x, _ in got["cubed", "name"]} >= {"lt.name"}


def test_orphan_views_are_dropped_only_if_allowed(spark):
    spark.range(1).createOrReplaceTempView("old_analytics")
    found = spark.createDataFrame([("old_analytics", "orphan"), ("x_analytics", "present")], "view_name string, status string")
    assert views.drop_orphans(spark, found) == ["old_analytics"] and spark.catalog.tableExists("old_analytics")
    assert views.drop_orphans(spark, found, allowed=True) and not spark.catalog.tableExists("old_analytics")
    assert views.safe_projection(spark.createDataFrame([("x",)], "raw_json string"), "s").columns == ["safe_view_placeholder"]


def test_pii_hashes_join_and_hide(spark):
    df = spark.createDataFrame([("a@b", 1.5), (" ", 2.0), (None, 1e7)], "email string, phone double")
    rows = views.safe_projection(df, "s1").collect()
    assert rows[1]["email_hash"] is None and rows[2]["email_hash"] is None and len(rows[0]["email_hash"]) == 64
    assert views.safe_projection(df, "s2").head()["email_hash"] != rows[0]["email_hash"]


def test_streams_apply_each_batch_once(spark, tmp_path):
    schema, folder = "id long, v string, at timestamp_ntz", f"file://{tmp_path}/in"
    day = lambda d: datetime.datetime(2024, 1, d)
    table, ledger = KeyedTable(spark, f"file://{tmp_path}/t"), incremental.Ledger(spark, f"file://{tmp_path}/l")

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    def run(mark="c"):
        stream = incremental.read_files(spark, folder, T._parse_datatype_string(schema))
        incremental.upsert_stream(stream, table, ledger, ["id"], f"file://{tmp_path}/{mark}", ["at"]).awaitTermination()
        return {r["id"]: r["v"] for r in table.read().collect()}

    deliver([(1, "a", day(1)), (2, "b", day(1)), (1, "a2", day(2))])
    assert run() == {1: "a2", 2: "b"} and run() == {1: "a2", 2: "b"}
    deliver([(2, "b", day(1)), (3, "late", day(1)), (None, "x", day(1))])
    assert run() == {1: "a2", 2: "b", 3: "late"}
    assert [(r["batch_id"], r["rows"]) for r in ledger.read().orderBy("batch_id").collect()] == [(0, 3), (1, 3)]
    assert ledger.has(1) and not ledger.has(2)
    out = f"file://{tmp_path}/new"
    for _ in range(2):
        stream = incremental.read_files(spark, folder, T._parse_datatype_string(schema))
        incremental.append_new(stream, out, ["id", "v"], f"file://{tmp_path}/c2").awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_state_rules(spark):
    batches = spark.createDataFrame([(1, "queued", 5, 0), (2, "failed", 5, 1), (3, "success", 9, 0)], "batch_id int, status string, rows int, retry_count int")
    changes = spark.createDataFrame([(1, "success", 7), (2, "retrying", None), (3, "failed", 0)], "batch_id int, status string, rows int")
    got = {r["batch_id"]: tuple(r)[1:] for r in state.advance(batches, changes).collect()}
    assert got == {1: ("queued", 5, 0), 2: ("retrying", 5, 2), 3: ("success", 9, 0)}
    runs = spark.createDataFrame([("r", 10, "x")], "run_id string, rows long, note string")
    update = spark.createDataFrame([("r", 7, None), ("s", 1, "n")], "run_id string, rows long, note string")
    assert {tuple(r) for r in state.merge_runs(runs, update).collect()} == {("r", 10, "x"), ("s", 1, "n")}
    old = spark.createDataFrame([("k1", "a"), ("k2", "b")], "raw_object_key string, m string")
    assert {tuple(r) for r in state.column_mappings(old, old.filter("raw_object_key = 'k1'").withColumn("m", F.lit("z"))).collect()} == {("k1", "z"), ("k2", "b")}


def test_readiness(spark):
    flat, nested = T._parse_datatype_string("id string, amount decimal(18,2), created_at timestamp"), T._parse_datatype_string("id string, a struct<x:int>, amount string")
    good, bad = P.readiness(nested, flat, "orders"), P.readiness(nested, nested, "orders")
    assert good["status"] == "ready" and bad["bi_readiness"] < good["bi_readiness"] and P.layer_difference(nested, nested)["copy_suspected"]
    assert P.readiness(nested, T.StructType(), "x")["status"] == "failed"
    assert P.type_warnings(T._parse_datatype_string("paid_at string, amount string, is_x int, ok_date date"))[2][0] == "is_x"
