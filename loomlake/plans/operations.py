"""Queries on running the platform: scopes, catalog, loops over batches, audits, summaries, events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.functions import logs
from loomlake.operators import audits, catalog, events, loops, scopes, views
from loomlake.operators import flatten as FL
from loomlake.operators.keyed import KeyedTable
from loomlake.plans.analytics import SALT
from loomlake.plans.registry import query, table
from loomlake.plans.tables import _ENUM, _ITEMS, order_documents
from loomlake.sources import cursors
from loomlake.storage import shared_path

# Scopes and filters


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("r"), "n_regionkey").alias("database"), F.concat(F.lit("n"), "n_nationkey").alias("collection"))


@query("""
WITH t AS (SELECT 'r' || n_regionkey AS database, 'n' || n_nationkey AS collection FROM nation)
SELECT 'all' AS scope, * FROM t UNION ALL SELECT 'database', * FROM t WHERE database = 'r1' UNION ALL SELECT 'table', * FROM t WHERE database = 'r1' AND collection = 'n2'
UNION ALL SELECT 'file', * FROM t WHERE collection = 'n3'
""")
def scope_filter(spark, sf_dir):
    """Scopes of a run; references in both spellings, a name alone, and an unknown scope."""
    t = _places(spark, sf_dir)
    asked = {"all": ("anything", "r1.n2"), "database": ("Database", "r1__n2"), "table": ("table", "r1__n2"), "file": ("file", "n3")}
    parts = [scopes.in_scope(t, scope, table=ref).select(F.lit(name).alias("scope"), "database", "collection") for name, (scope, ref) in asked.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey % 7)::VARCHAR IN ('1', '2') OR 'k' || (o_custkey % 5) = 'k3'")
def batch_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    bronze = o.select("o_orderkey", (F.col("o_orderkey") % 7).alias("_raw_file_id"), F.concat(F.lit("k"), F.col("o_custkey") % 5).alias("_raw_object_key"))
    return scopes.of_batches(bronze, ["1", "2"], ["k3"]).select("o_orderkey")


@query("SELECT event_id FROM events WHERE event_type = 'click' AND (value > 50) AND user_id >= 0")
def optional_filters(spark, sf_dir):
    """Values for a column and for a flag as text; a blank, a null and an unknown name filter nothing."""
    e = table(spark, sf_dir, "events").withColumn("large", F.col("value") > 50)
    found = scopes.asked(e, {"type": "event_type", "user": "user_id", "large": "large", "day": "ts"}, {"type": "click", "user": "", "large": "Yes", "day": None, "drop": "x"})
    return found.filter("user_id >= 0").select("event_id")


@query("SELECT count(*) AS rows, greatest(1, ceil(count(*) / 1000))::BIGINT AS batches FROM events WHERE event_type <> 'error'")
def batch_estimate(spark, sf_dir):
    """How many batches a filtered read will be."""
    n = table(spark, sf_dir, "events").filter("event_type <> 'error'").agg(F.count(F.lit(1)).alias("rows"))
    return n.withColumn("batches", F.greatest(F.lit(1), F.ceil(F.col("rows") / cursors.BATCH)).cast("long"))


# Catalog


@query("SELECT table_name, column_name, ordinal_position::INTEGER AS ordinal FROM information_schema.columns WHERE table_name IN ('orders', 'part', 'events')")
def column_listing(spark, sf_dir):
    schemas = {n: table(spark, sf_dir, n).schema for n in ("orders", "part", "events", "nation")}
    return catalog.list_columns(spark, schemas, ("orders", "part", "events")).drop("data_type")


@query("SELECT 'shop_' || n_name || '_listing' AS name, true AS is_view FROM nation WHERE n_nationkey < 3")
def table_listing(spark, sf_dir):
    """What the catalog lists, by names that this query registers."""
    n = table(spark, sf_dir, "nation")
    for r in n.filter("n_nationkey < 3").select("n_name").collect():
        n.createOrReplaceTempView(f"shop_{r['n_name'].replace(' ', '_').replace('#', '_')}_listing")
    found = catalog.list_tables(spark).filter("name LIKE 'shop\\_%\\_listing'")
    names = n.filter("n_nationkey < 3").select(F.concat(F.lit("shop_"), "n_name", F.lit("_listing")).alias("name"))
    return names.join(found, F.lower(F.translate(names["name"], " #", "__")) == F.lower(found["name"])).select(names["name"], "is_view")


@query("""
SELECT 'n' || n_nationkey AS name, n_nationkey % 2 = 0 AS is_active, 'known' AS origin FROM nation WHERE n_nationkey < 5
UNION ALL SELECT 'n' || n_nationkey, false, 'inserted' FROM nation WHERE n_nationkey >= 5 AND n_nationkey < 20
""")
def database_discovery(spark, sf_dir):
    """New databases become inactive sources, known ones stay; system, demo and unwanted ones are left out."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("n"), "n_nationkey").alias("name"))
    seen = n.select("name").union(spark.createDataFrame([("admin",), ("Local",), ("demo_shop",), ("n5",)], "name string"))
    known = n.filter("n_nationkey < 5").select("name", (F.col("n_nationkey") % 2 == 0).alias("is_active"))
    return catalog.discovered(seen, known, [f"n{i}" for i in range(20)] + ["admin", "demo_shop"])


@query("SELECT count(*) AS rows, sum(p_size) AS size, true AS fresh, false AS again FROM part")
def registered_table(spark, sf_dir):
    """An external table over a folder, registered twice."""
    path = shared_path(spark, "part")
    table(spark, sf_dir, "part").write.parquet(path)
    name = "loomlake_part_" + path[-8:]
    fresh, again = catalog.register_table(spark, name, path), catalog.register_table(spark, name, path)
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum("p_size").alias("size")).select("rows", "size", F.lit(fresh).alias("fresh"), F.lit(again).alias("again"))


_BYTES = "(o_orderkey::BIGINT * o_orderkey * o_orderkey)"


@query(f"""
SELECT o_orderkey, CASE WHEN b >= 1073741824 THEN greatest(1, round_even(b / 1073741824, 0))::BIGINT || 'GB' WHEN b >= 1048576 THEN greatest(1, round_even(b / 1048576, 0))::BIGINT || 'MB'
  WHEN b >= 1024 THEN greatest(1, round_even(b / 1024, 0))::BIGINT || 'KB' ELSE greatest(1, b) || 'B' END AS size FROM (SELECT o_orderkey, {_BYTES} AS b FROM orders)
""")
def data_sizes(spark, sf_dir):
    k = F.col("o_orderkey").cast("decimal(38,0)")  # cubes of keys beyond 2,097,151 are no longs
    return table(spark, sf_dir, "orders").select("o_orderkey", catalog.data_size(k * k * k).alias("size"))


# Views


_STATUS = "CASE WHEN t = 'part' THEN 'stale' WHEN t = 'supplier' THEN 'row_mismatch' ELSE 'ok' END"


@query(f"""
WITH c AS (SELECT 'nation' AS t, count(*) AS n FROM nation UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'orders', count(*) FROM orders)
SELECT 'vl__' || t || '_analytics' AS view_name, true AS live, true AS pii_safe, t <> 'supplier' AS same_rows, t <> 'part' AS fresh, n AS view_rows,
  CASE WHEN t = 'supplier' THEN 0 ELSE n END AS source_rows, {_STATUS} AS status FROM c
UNION ALL SELECT 'vl__gone_analytics', false, true, true, true, NULL, NULL, 'missing'
""")
def view_lifecycle(spark, sf_dir):
    """Views are registered, found stale or missing, renewed where asked, probed and checked against their sources."""
    now, old = F.lit("2024-01-02 12:00:00").cast("timestamp"), F.lit("2023-12-01 00:00:00").cast("timestamp")
    names = ("nation", "part", "supplier", "orders")
    tables = {f"vl__{n}_clean": FL.flatten(table(spark, sf_dir, n)) for n in names}
    first = views.register_views(spark, {k: tables[k] for k in ("vl__nation_clean", "vl__part_clean")}, SALT).withColumn("validated_at", old)
    metadata, _ = views.renew_views(spark, tables, first, SALT, now)
    live = catalog.live_views(spark, [f"vl__{n}_analytics" for n in (*names, "gone")])
    counts = [
        spark.table(f"vl__{n}_analytics").agg(F.lit(f"vl__{n}_analytics").alias("view_name"), F.count(F.lit(1)).alias("view_rows"))
        .crossJoin((tables[f"vl__{n}_clean"] if n != "supplier" else tables["vl__supplier_clean"].limit(0)).agg(F.count(F.lit(1)).alias("source_rows")))
        for n in names
    ]
    rows = counts[0].union(counts[1]).union(counts[2]).union(counts[3])
    late = F.when(F.col("view_name") == "vl__part_analytics", old).otherwise(F.coalesce("validated_at", now))
    checks = live.join(rows, "view_name", "left").join(metadata.select("view_name", "validated_at"), "view_name", "left")
    return audits.view_report(checks.withColumns({"exposed": F.lit(""), "validated_at": late}), now)


@query("SELECT 'ev__' || t || '_analytics' AS view_name FROM (VALUES ('nation')) v(t)")
def eligible_views(spark, sf_dir):
    """Of four validated views one is left: the others are unsafe, without their source, or don't answer."""
    n = table(spark, sf_dir, "nation")
    views.register_views(spark, {f"ev__{x}_clean": n for x in ("nation", "broken", "orphaned")}, SALT)
    spark.catalog.dropTempView("ev__broken_analytics")
    metadata = spark.createDataFrame([(f"ev__{x}_analytics", f"ev__{x}_clean", "ok", x != "unsafe") for x in ("nation", "broken", "orphaned", "unsafe")], "view_name string, source_table string, status string, pii_safe boolean")
    sources = spark.createDataFrame([("ev__nation_clean",), ("ev__broken_clean",), ("ev__unsafe_clean",)], "table_name string")
    live = catalog.live_views(spark, ["ev__nation_analytics", "ev__broken_analytics", "ev__orphaned_analytics"])
    return views.eligible(metadata, metadata.select("view_name"), sources, live).select("view_name")


# Loops


_UNDATED = "event_id % 5 < 2"


@query(f"""
WITH s AS (SELECT greatest(1, ceil(count(*) / 9))::BIGINT AS size FROM events),
n AS (SELECT event_id, {_UNDATED} AS undated, row_number() OVER (PARTITION BY {_UNDATED} ORDER BY CASE WHEN {_UNDATED} THEN NULL ELSE ts END, event_id) - 1 AS place FROM events),
p AS (SELECT count(*) FILTER (WHERE NOT undated) AS dated FROM n)
SELECT (CASE WHEN undated THEN ceil(dated / size) ELSE 0 END + place // size + 1)::INTEGER AS batch, count(*) AS rows, sum(event_id)::BIGINT AS ids,
  'paused' AS first_run, 'success' AS then_run, 0::BIGINT AS again FROM n, s, p GROUP BY 1
""")
def raw_loop(spark, sf_dir):
    """A source is read into raw files, page by page: paused after the first page, taken up again in one pass, and asked once
    more. Two fifths of the rows, several pages, have no cursor value."""
    docs = table(spark, sf_dir, "events").select(F.col("event_id").alias("_id"), F.when(~F.expr(_UNDATED), F.col("ts")).alias("ts"), "event_type", "user_id")
    root, plan = shared_path(spark, "lake"), cursors.CursorPlan(cursors.TIMESTAMP, "ts")
    size, at = max(1, -(-docs.count() // 9)), F.lit("2024-03-01 05:30:00").cast("timestamp")
    asked = iter(["run", "pause"])
    read = lambda run, control, ahead=None: loops.collect(spark, docs, plan, root, "shop", "events", run, at, size, control=control, ahead=ahead)
    first, then = read("r1", lambda: next(asked), 1), read("r2", loops.go_on)
    again = read("r3", loops.go_on)
    rows = spark.read.option("basePath", f"{root}/raw/shop/events").schema("_id long, batch int").json(f"{root}/raw/shop/events")
    counted = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.sum("_id").alias("ids"))
    return counted.select("batch", "rows", "ids", F.lit(first.status).alias("first_run"), F.lit(then.status).alias("then_run"), F.lit(again.rows).cast("long").alias("again"))


@query(f"""{_ITEMS}, g AS (SELECT id, count(*) AS n FROM i GROUP BY id)
SELECT o_orderkey::VARCHAR AS silver_row_id, o_custkey::VARCHAR AS customerid, {_ENUM.format('o_orderstatus')} AS status, g.n::INTEGER AS items_count,
  coalesce(g.n, 0) AS child_rows, '2 cancelled' AS first_run, '4 success' AS then_run, '0 6' AS again FROM orders LEFT JOIN g ON id = o_orderkey::VARCHAR
""")
def clean_loop(spark, sf_dir):
    """Raw batches of documents merged into a clean table and its child table: cancelled after one group of two files,
    taken up again, and asked once more."""
    bronze = order_documents(spark, sf_dir).withColumn("_raw_file_id", (F.col("_id").cast("long") % 6).cast("string"))
    target = loops.Target("shop", "purchases", shared_path(spark, "lake"))
    asked, files = iter(["run", "cancel"]), [str(i) for i in range(6)]
    first = loops.process(spark, target, bronze, files, "r1", 2, lambda: next(asked))
    then = loops.process(spark, target, bronze, files, "r2", 4)
    again = loops.process(spark, target, bronze, files, "r3", 4)
    child = target.kept(spark, "shop__purchases_items_clean").read().groupBy(F.col("parent_record_id").alias("silver_row_id")).agg(F.count(F.lit(1)).alias("n"))
    clean = target.kept(spark).read().join(child, "silver_row_id", "left")
    said = {"first_run": f"{first.processed} {first.status}", "then_run": f"{then.processed} {then.status}", "again": f"{again.processed} {again.skipped}"}
    return clean.select("silver_row_id", "customerid", "status", "items_count", F.coalesce("n", F.lit(0)).cast("long").alias("child_rows"), *[F.lit(v).alias(k) for k, v in said.items()])


# Audits and summaries


def _sources(spark: SparkSession, sf_dir: str) -> dict:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("x").alias("email"), F.create_map(F.lit("a"), F.lit(1)).alias("preferences"))
    return {("shop", "purchases"): order_documents(spark, sf_dir).schema, ("shop", "clients"): c.schema}


def _audited(spark: SparkSession, sf_dir: str) -> dict[str, KeyedTable]:
    """Written twice: a refresh replaces all that was there."""
    path = shared_path(spark, "audits")
    found = audits.audit(spark, _sources(spark, sf_dir), {"shop__clients_analytics": ["c_custkey", "c_name", "email_hash"]}, {"shop__purchases_items_clean": 7})
    audits.refresh(spark, path, found)
    return audits.refresh(spark, path, found)


@query("""
SELECT * FROM (VALUES ('shop__clients_clean', 'c_name', 'personal_identifier', 'column_name_contains_personal_identifier', 0.9::DOUBLE, 'exposed', 'blocking'),
  ('shop__clients_clean', 'email', 'email', 'column_name_contains_email', 0.98, 'hashed', 'warning')) v(table_name, column_name, pii_type, rule, confidence, protection, severity)
""")
def pii_audit_table(spark, sf_dir):
    return _audited(spark, sf_dir)["pii"].read().select("table_name", "column_name", "pii_type", "rule", "confidence", "protection", "severity")


@query("SELECT 'shop__purchases_items_clean' AS child_table, 'items' AS field_path, 'repeated struct' AS reason, 7::BIGINT AS row_count")
def child_audit_table(spark, sf_dir):
    return _audited(spark, sf_dir)["children"].read().select("child_table", "field_path", "reason", "row_count")


@query("SELECT 'shop__clients_clean' AS table_name, 'preferences_raw_json' AS column_name, 'map/config-like object' AS reason, 'limited_filtering' AS bi_impact, false AS needs_custom_transform")
def raw_json_audit_table(spark, sf_dir):
    return _audited(spark, sf_dir)["raw_json"].read().select("table_name", "column_name", "reason", "bi_impact", "needs_custom_transform")


_QUALITY = """(SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'warning' ELSE 'passed' END AS status, event_type = 'error' AND value > 90 AS blocking,
  CASE WHEN user_id % 3 = 0 THEN 'bi_ready' WHEN user_id % 3 = 1 THEN 'needs_custom_transform' ELSE 'limited' END AS bi, event_id % 4 = 0 AS child, event_id % 3 AS nested,
  (event_id % 101)::DOUBLE AS readiness, (user_id % 101)::DOUBLE AS flattening FROM events)"""


@query(f"""
SELECT count(*) AS tables, count(*) FILTER (WHERE status = 'passed') AS passed, count(*) FILTER (WHERE status = 'warning') AS warning, count(*) FILTER (WHERE status = 'failed') AS failed,
  count(*) FILTER (WHERE blocking) AS blocking, count(*) FILTER (WHERE bi = 'bi_ready') AS bi_ready, count(*) FILTER (WHERE bi = 'needs_custom_transform') AS custom,
  count(*) FILTER (WHERE child) AS children, sum(nested)::BIGINT AS nested, round_even(sum(readiness) / count(*), 1) AS readiness, round_even(sum(flattening) / count(*), 1) AS flattening, 'failed' AS status
FROM {_QUALITY}
""")
def quality_overview(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("user_id") % 3
    rows = e.select(
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "warning").otherwise("passed").alias("status"),
        ((F.col("event_type") == "error") & (F.col("value") > 90)).alias("blocking"), F.when(k == 0, "bi_ready").when(k == 1, "needs_custom_transform").otherwise("limited").alias("bi_suitability"),
        (F.col("event_id") % 4 == 0).alias("is_child_table"), (F.col("event_id") % 3).alias("nested_columns"), (F.col("event_id") % 101).cast("double").alias("readiness"),
        (F.col("user_id") % 101).cast("double").alias("flattening"),
    )
    return audits.quality_summary(rows)


@query("""
SELECT d.*, b.*, c.*, l.* FROM (SELECT count(*) AS datasets_total, count(*) FILTER (WHERE p_size > 10) AS datasets, count(*) FILTER (WHERE p_size <= 10) AS failed_datasets FROM part) d,
(SELECT count(*) AS boards_total, count(*) FILTER (WHERE o_orderstatus = 'O') AS boards, count(*) FILTER (WHERE o_orderstatus <> 'O') AS failed_boards, max(o_orderdate)::TIMESTAMP AS last_refresh,
  avg(o_custkey) AS generation_ms FROM orders) b,
(SELECT count(*) AS charts_total, count(*) FILTER (WHERE s_nationkey < 12) AS charts, count(*) FILTER (WHERE s_nationkey >= 12) AS failed_charts FROM supplier) c,
(SELECT count(*) FILTER (WHERE event_type = 'error') AS failed_loads, avg(event_id % 5000) AS load_ms FROM events) l
""")
def board_overview(spark, sf_dir):
    status = lambda c: F.when(c, "ok").otherwise("error").alias("status")
    p, o, s, e = (table(spark, sf_dir, n) for n in ("part", "orders", "supplier", "events"))
    boards = o.select(status(F.col("o_orderstatus") == "O"), F.col("o_orderdate").alias("last_refresh_at"), F.col("o_custkey").alias("generation_ms"))
    loads = e.select(status(F.col("event_type") != "error"), (F.col("event_id") % 5000).alias("duration_ms"))
    return audits.board_overview(p.select(status(F.col("p_size") > 10)), boards, s.select(status(F.col("s_nationkey") < 12)), loads)


@query("""
SELECT coalesce(sum(l_quantity::BIGINT) FILTER (WHERE l_linenumber = 1), 0)::BIGINT AS parent_rows, coalesce(sum(l_quantity::BIGINT) FILTER (WHERE l_linenumber <> 1), 0)::BIGINT AS child_rows,
  sum(l_quantity::BIGINT)::BIGINT AS total_rows FROM lineitem
""")
def layer_rows(spark, sf_dir):
    states = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("long").alias("row_count"), (F.col("l_linenumber") != 1).alias("is_child_table"))
    return audits.layer_rows(states)


@query("""
SELECT 'c' || user_id AS source_column, max(event_id % 100) / 100 AS confidence, count(*) AS used FROM events WHERE event_type = 'click'
GROUP BY user_id ORDER BY confidence DESC, used DESC, source_column LIMIT 12
""")
def usual_columns(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    named = F.when(F.col("event_type") == "click", "Order No.").otherwise("Order")
    matches = e.select(named.alias("field_name"), F.concat(F.lit("c"), "user_id").alias("source_column"), (F.col("event_id") % 100 / 100).alias("confidence"))
    return audits.usual_columns(matches, "order_no")


# Events


@query("""
SELECT user_id::VARCHAR AS run_id, event_type, 'ok' AS status, 'read mongodb://***:***@host/' || event_id || ' token=*** done' AS message, ts AS at FROM events
UNION ALL SELECT 'r0', 'started', NULL, NULL, NULL
""")
def event_log(spark, sf_dir):
    """Two appends; secrets in messages are masked."""
    log, e = events.EventLog(spark, shared_path(spark, "events")), table(spark, sf_dir, "events")
    text = F.concat(F.lit("read mongodb://me:pw@host/"), "event_id", F.lit(" token=abc done"))
    log.append(e.select(F.col("user_id").alias("run_id"), "event_type", F.lit("ok").alias("status"), text.alias("message"), F.col("ts").cast("timestamp").alias("at")))
    log.add("r0", "started")
    return log.read().select("run_id", "event_type", "status", "message", F.when(F.col("run_id") != "r0", F.col("at")).cast("timestamp_ntz").alias("at"))


@query("""
SELECT user_id AS file_id, event_id, row_number() OVER w AS attempt, lead(event_id) OVER w IS NULL AS last FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def file_attempts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("file_id"), F.struct("ts", "event_id").alias("at"), F.col("event_type").alias("status"), "event_id")
    return events.attempts(e).select("file_id", "event_id", "attempt", "last")


_STAGE = "CASE event_id % 6 WHEN 0 THEN 'matching' WHEN 1 THEN 'ranking' WHEN 2 THEN 'validating' WHEN 3 THEN 'creating' WHEN 4 THEN 'previewing' ELSE 'other' END"


@query(f"""
WITH s AS (SELECT user_id, ts, {_STAGE} AS stage FROM events),
p AS (SELECT *, CASE stage WHEN 'matching' THEN 12 WHEN 'ranking' THEN 35 WHEN 'validating' THEN 60 WHEN 'creating' THEN 80 WHEN 'previewing' THEN 92 ELSE 0 END AS percent FROM s),
g AS (SELECT user_id AS run_id, arg_max(stage, (percent, ts, stage)) AS stage, max(percent) AS percent, epoch(TIMESTAMP '2030-01-01')::BIGINT - epoch(date_trunc('second', min(ts)))::BIGINT AS elapsed FROM p GROUP BY 1)
SELECT run_id, stage, percent, CASE WHEN percent > 0 AND percent < 100 THEN elapsed * (100 - percent) / percent END AS remaining_seconds FROM g
""")
def report_progress(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stages = F.array(*[F.lit(s) for s in ("matching", "ranking", "validating", "creating", "previewing", "other")])
    rows = e.select(F.col("user_id").alias("run_id"), F.get(stages, (F.col("event_id") % 6).cast("int")).alias("stage"), F.col("ts").cast("timestamp").alias("at"))
    return events.report_progress(rows, F.lit("2030-01-01 00:00:00").cast("timestamp"))


@query("""
WITH s AS (SELECT user_id AS run_id, event_type, arg_max(CASE WHEN event_id % 40 = 0 THEN 'failed' ELSE 'success' END, (ts, event_id)) AS status, count(*) AS n, min((ts, event_id)) AS began FROM events GROUP BY 1, 2)
SELECT run_id, string_agg(event_type || ':' || status, ',' ORDER BY began) AS steps, sum(n)::BIGINT AS items, CASE WHEN bool_or(status = 'failed') THEN 'failed' ELSE 'success' END AS status FROM s GROUP BY 1
""")
def run_flow(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 40 == 0, "failed").otherwise("success")
    return events.flow(e.select(F.col("user_id").alias("run_id"), "event_type", status.alias("status"), F.struct("ts", "event_id").alias("at")))


@query("SELECT c_custkey, '***' AS api_token, CASE WHEN c_nationkey > 5 THEN '***' END AS db_password, 'x secret=*** y' AS note FROM customer")
def masked_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return logs.masked_fields(c.select("c_custkey", F.col("c_name").alias("api_token"), F.when(F.col("c_nationkey") > 5, F.lit("pw")).alias("db_password"), F.lit("x secret=abc y").alias("note")))
