"""Queries on upserts, joins, sets, windows and run state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import columns as C
from loomlake.operators import merge as M
from loomlake.operators import sets, state
from loomlake.operators.keyed import KeyedTable
from loomlake.plans.registry import query, table
from loomlake.sources.keyset import KeysetSource
from loomlake.storage import shared_path
from loomlake.streaming import batches, incremental

_CUT, _FROM = "1999-01-01", "1998-01-01"


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What a table held before the cut, and a later delivery that overlaps it: all orders since _FROM, those before
    the cut that were open are now final."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    hashed = lambda df: df.withColumn("h", C.stable_hash(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")))
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    target = o.filter(F.col("o_orderdate") < day(_CUT))
    final = F.when((F.col("o_orderdate") < day(_CUT)) & (F.col("o_orderstatus") == "O"), "F").otherwise(F.col("o_orderstatus"))
    source = o.filter(F.col("o_orderdate") >= day(_FROM)).withColumn("o_orderstatus", final)
    return hashed(target), hashed(source)


_STATUS = f"CASE WHEN o_orderdate >= TIMESTAMP '{_FROM}' AND o_orderdate < TIMESTAMP '{_CUT}' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END"
_ACTION = f"CASE WHEN o_orderdate >= TIMESTAMP '{_CUT}' THEN 'insert' WHEN o_orderdate >= TIMESTAMP '{_FROM}' AND o_orderstatus = 'O' THEN 'update' ELSE 'keep' END"


@query(f"SELECT o_orderkey, o_custkey, {_STATUS} AS o_orderstatus, {_ACTION} AS action FROM orders")
def merge_upsert(spark, sf_dir):
    target, source = _versions(spark, sf_dir)
    return M.merge(target, source, ["o_orderkey"], "h").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("_action").alias("action"))


_METRICS = f"""SELECT count(*) FILTER (WHERE a = 'insert') AS inserted, count(*) FILTER (WHERE a = 'update') AS updated, count(*) FILTER (WHERE a = 'keep') AS kept,
  count(*) FILTER (WHERE a <> 'keep') AS changed, count(*) AS total FROM (SELECT {_ACTION} AS a FROM orders)"""


@query(_METRICS)
def merge_metrics(spark, sf_dir):
    target, source = _versions(spark, sf_dir)
    return M.merge_metrics(M.merge(target, source, ["o_orderkey"], "h"))


@query(f"SELECT o_orderkey, {_STATUS} AS o_orderstatus, 0::BIGINT AS changed_again FROM orders")
def versioned_upsert(spark, sf_dir):
    """The same through versions on disk; the delivery comes twice, the second time nothing changes."""
    target, source = _versions(spark, sf_dir)
    kept = KeyedTable(spark, shared_path(spark, "orders"))
    kept.write(target, ["o_orderkey"])
    kept.upsert(source, ["o_orderkey"], "h")
    again = kept.upsert(source, ["o_orderkey"], "h")["changed"]
    return kept.read().select("o_orderkey", "o_orderstatus", F.lit(again).cast("long").alias("changed_again"))


_FEW = "o_orderkey % 1000 = 7"


@query(f"""
SELECT 1::BIGINT AS number, count(*) AS rows, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS kept, true AS pruned FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'
UNION ALL
SELECT 2, count(*) FILTER (WHERE old OR {_FEW}), count(*) FILTER (WHERE NOT old AND {_FEW}), count(*) FILTER (WHERE old AND {_FEW}),
  count(*) FILTER (WHERE old AND NOT {_FEW}), true FROM (SELECT o_orderkey, o_orderdate < TIMESTAMP '{_CUT}' AS old FROM orders)
HAVING count(*) FILTER (WHERE {_FEW}) > 0
""")
def keyed_history(spark, sf_dir):
    """A delivery of a thousandth of the keys to a table of 512 buckets: its record, and that it wrote no other buckets."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    kept = KeyedTable(spark, shared_path(spark, "orders"), buckets=512)
    kept.write(o.filter(F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")).withColumn("h", F.lit("old")), ["o_orderkey"])
    kept.upsert(o.filter(_FEW).withColumn("h", F.lit("new")), ["o_orderkey"], "h")
    pruned = (F.col("number") == 1) | (F.col("buckets_written") <= F.col("changed"))
    return kept.history().select("number", "rows", "inserted", "updated", "kept", pruned.alias("pruned"))


@query(f"""
WITH a AS (SELECT o_custkey AS k, count(*) AS n, max(o_orderdate) AS d, min(o_orderpriority) AS p FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}' GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS n, max(o_orderdate) AS d, min(o_orderpriority) AS p FROM orders WHERE o_orderdate >= TIMESTAMP '{_CUT}' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS o_custkey, coalesce(a.n, 0) + coalesce(b.n, 0) AS n, greatest(a.d, b.d) AS last, coalesce(a.p, b.p) AS first_priority FROM a FULL JOIN b ON a.k = b.k
""")
def merge_counters(spark, sf_dir):
    """Counters add up, the last time only grows, the first known value stays."""
    o = table(spark, sf_dir, "orders")
    side = lambda f: o.filter(f).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last"), F.min("o_orderpriority").alias("first_priority"))
    cut = F.lit(_CUT).cast("timestamp_ntz")
    rules = {"n": M.add, "last": M.greatest, "first_priority": M.keep_old}
    return M.merge(side(F.col("o_orderdate") < cut), side(F.col("o_orderdate") >= cut), ["o_custkey"], None, resolve=rules).drop("_action")


@query(f"""
SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{_CUT}' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}')
""")
def insert_ignore(spark, sf_dir):
    o, cut = table(spark, sf_dir, "orders"), F.lit(_CUT).cast("timestamp_ntz")
    return M.insert_ignore(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut).select("o_custkey"), ["o_custkey"])


@query("""
SELECT n_regionkey AS region, 'old' AS origin, count(*) AS n FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%') GROUP BY 1
UNION ALL SELECT r_regionkey, 'new', 0 FROM region WHERE r_name LIKE 'A%'
""")
def replace_keys(spark, sf_dir):
    old = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("n")).withColumn("origin", F.lit("old"))
    new = table(spark, sf_dir, "region").filter(F.col("r_name").startswith("A")).select(F.col("r_regionkey").alias("region"), F.lit(0).cast("long").alias("n"), F.lit("new").alias("origin"))
    return M.replace_keys(old, new, ["region"])


# Joins and sets


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending_anti_join(spark, sf_dir):
    """Customers as files, final orders as their successful states."""
    files = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file_id"), "c_name")
    states = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"))
    return state.pending(files, states).select(F.col("file_id").alias("c_custkey"), "c_name")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%')")
def semi_join_exists(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").startswith("1"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("""
WITH r AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS id, s_name AS name, s_nationkey AS found FROM supplier)
SELECT s_suppkey AS id, s_name AS name, found FROM supplier LEFT JOIN r ON r.id = s_suppkey OR (r.id IS NULL AND r.name = s_name)
""")
def theta_or_join(spark, sf_dir):
    """States known by id, or by name where they have no id: an OR as two equal joins."""
    s = table(spark, sf_dir, "supplier")
    right = s.select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("found"))
    return sets.either_key_join(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), right, "id", "name")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name FROM lineitem JOIN supplier ON s_suppkey IN (l_suppkey, l_partkey)
""")
def any_column_join(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return sets.any_column_join(left, table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", ["l_suppkey", "l_partkey"]).drop("s_suppkey")


@query("""
SELECT r_name, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS nations, count(*) AS n
FROM region LEFT JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name
""")
def json_agg_collections(spark, sf_dir):
    """Sources with their collections as a JSON list in order; none gives []."""
    joined = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    item = F.when(F.col("n_nationkey").isNotNull(), F.struct("n_nationkey", "n_name"))
    return joined.groupBy("r_name").agg(F.to_json(F.array_sort(F.collect_list(item))).alias("nations"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT n_name, o_orderkey, o_orderdate FROM nation LEFT JOIN (SELECT c_nationkey, o_orderkey, o_orderdate,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM customer JOIN orders ON o_custkey = c_custkey) x ON c_nationkey = n_nationkey AND r = 1
""")
def latest_row_join(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    best = rows.groupBy("c_nationkey").agg(F.max_by(F.struct("o_orderkey", "o_orderdate"), F.struct("o_orderdate", -F.col("o_orderkey"))).alias("x"))
    return table(spark, sf_dir, "nation").join(best, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", "x.o_orderkey", "x.o_orderdate")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def latest_per_user(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return M.latest(e, ["user_id"], [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_id", "event_type")


@query("""
SELECT coalesce(n_nationkey, s_nationkey) AS key, CASE WHEN s_nationkey IS NULL THEN 'missing' WHEN n_nationkey IS NULL THEN 'orphan' ELSE 'present' END AS status
FROM (SELECT n_nationkey FROM nation WHERE n_regionkey < 4) FULL JOIN (SELECT DISTINCT s_nationkey FROM supplier) ON n_nationkey = s_nationkey
""")
def set_reconciliation(spark, sf_dir):
    expected = table(spark, sf_dir, "nation").filter("n_regionkey < 4").select(F.col("n_nationkey").alias("key"))
    return sets.reconcile(expected, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key")), "key")


@query("SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT s_suppkey FROM supplier UNION SELECT user_id FROM events")
def union_ids(spark, sf_dir):
    sources = (("orders", "o_custkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("events", "user_id"))
    return sets.union_ids(*[table(spark, sf_dir, t).select(F.col(c).alias("id")) for t, c in sources])


@query("SELECT c_custkey AS id, true AS both FROM customer INTERSECT SELECT o_custkey, true FROM orders")
def intersect_ids(spark, sf_dir):
    side = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("id"), F.lit(True).alias("both"))
    return side("customer", "c_custkey").intersect(side("orders", "o_custkey"))


@query("""
SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS final, count(*) FILTER (WHERE o_orderstatus = 'O') AS open,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS partial, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS price FROM orders GROUP BY 1
""")
def filter_pivot_counts(spark, sf_dir):
    of = lambda s: F.count_if(F.col("o_orderstatus") == s)
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price")
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("total"), of("F").alias("final"), of("O").alias("open"), of("P").alias("partial"), price)


@query("""
SELECT o_orderkey, coalesce(list_sum(list_transform(i, lambda x: x.q)), 0)::BIGINT AS quantity, len(i)::INTEGER AS n FROM orders
LEFT JOIN (SELECT l_orderkey, list({'q': l_quantity::BIGINT}) AS i FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
""")
def array_count_fold(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").cast("long").alias("q"))).alias("i"))
    joined = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    total = F.aggregate(F.coalesce("i", F.array().cast("array<struct<q:bigint>>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["q"], F.lit(0)))
    return joined.select("o_orderkey", total.alias("quantity"), F.size("i").alias("n"))


@query("""
SELECT o_orderkey, rank::BIGINT AS place FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END,
  o_orderdate DESC NULLS LAST, o_orderkey) AS rank FROM orders) WHERE rank <= 5
""")
def case_ranked_topk(spark, sf_dir):
    """The five most urgent orders of each customer, by a listed order of states."""
    place = F.array_position(F.array(F.lit("P"), F.lit("O")), F.col("o_orderstatus"))
    order = [F.when(place == 0, 3).otherwise(place), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order)).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", rank.alias("place")).filter("place <= 5")


# Run state. Events stand for batches, users for runs.

_NOW = "2024-01-08 00:00:00"
#: Just after the last event: ages differ by users.
_LATE = "2024-01-31 00:00:00"
_STATES = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'running' WHEN 'click' THEN 'success' ELSE 'queued' END"


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    named = {"error": "failed", "purchase": "success", "signup": "running", "click": "success"}
    status = F.lit("queued")
    for k, v in named.items():
        status = F.when(F.col("event_type") == k, v).otherwise(status)
    return e.select(F.col("event_id").alias("batch_id"), F.col("user_id").alias("run_id"), status.alias("status"), (F.col("event_id") % 50).alias("rows"), F.lit(0).alias("retry_count"), F.col("ts").alias("started_at"), F.lit(False).alias("retryable"))


@query(f"""
WITH b AS (SELECT user_id AS run_id, {_STATES} AS s, event_id % 50 AS r FROM events)
SELECT run_id, count(*) AS total, count(*) FILTER (WHERE s = 'queued') AS queued, count(*) FILTER (WHERE s = 'running') AS running, count(*) FILTER (WHERE s = 'success') AS success,
  count(*) FILTER (WHERE s = 'failed') AS failed, 0::BIGINT AS skipped, 0::BIGINT AS cancelled, sum(r)::BIGINT AS rows,
  round(count(*) FILTER (WHERE s IN ('success', 'failed')) / count(*) * 100, 2) AS percent FROM b GROUP BY run_id
""")
def run_progress(spark, sf_dir):
    return state.run_progress(_batches(spark, sf_dir))


@query(f"""
WITH b AS (SELECT event_id, ts, {_STATES} AS s FROM events)
SELECT event_id AS batch_id, CASE WHEN s = 'running' AND ts < TIMESTAMP '{_NOW}' - INTERVAL 30 MINUTE THEN 'failed' ELSE s END AS status,
  s = 'running' AND ts < TIMESTAMP '{_NOW}' - INTERVAL 30 MINUTE AS retryable FROM b
""")
def interrupted_batches(spark, sf_dir):
    return state.interrupted(_batches(spark, sf_dir), F.lit(_NOW).cast("timestamp_ntz")).select("batch_id", "status", "retryable")


@query(f"""
WITH b AS (SELECT event_id, {_STATES} AS s, event_id % 50 AS r FROM events)
SELECT event_id AS batch_id, CASE WHEN s = 'failed' THEN 'retrying' ELSE s END AS status, r AS rows, (s = 'failed')::INTEGER AS retry_count FROM b
""")
def batch_transitions(spark, sf_dir):
    """A wanted retry of every batch; only failed ones may go there."""
    b = _batches(spark, sf_dir)
    return state.advance(b, b.select("batch_id", F.lit("retrying").alias("status"), F.lit(None).cast("long").alias("rows")))


@query(f"""
WITH b AS (SELECT user_id AS f, {_STATES} AS s, event_id % 50 AS r, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS z FROM events)
SELECT x.f AS file_id, CASE WHEN x.s = 'success' THEN 'success' ELSE y.s END AS status, CASE WHEN y.r = 0 THEN x.r ELSE y.r END AS rows
FROM b x JOIN b y ON x.f = y.f AND x.a = 1 AND y.z = 1
""")
def file_states(spark, sf_dir):
    """First and last attempt of each file: success stays, rows don't fall back to 0."""
    b = _batches(spark, sf_dir).select(F.col("run_id").alias("file_id"), "status", "rows", "started_at", "batch_id")
    first = M.latest(b, ["file_id"], [F.asc("started_at"), F.asc("batch_id")]).select("file_id", "status", "rows")
    last = M.latest(b, ["file_id"], [F.desc("started_at"), F.asc("batch_id")]).select("file_id", "status", "rows")
    return state.file_state(first, last)


@query(f"""
SELECT user_id, CASE WHEN epoch(TIMESTAMP '{_LATE}' - m) / 60 > 1440 THEN 'stale' WHEN epoch(TIMESTAMP '{_LATE}' - m) / 60 > 120 THEN 'delayed' ELSE 'fresh' END AS freshness
FROM (SELECT user_id, date_trunc('second', max(ts)) AS m FROM events GROUP BY 1)
""")
def freshness_states(spark, sf_dir):
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("m"))
    return last.select("user_id", C.freshness(F.col("m"), F.lit(_LATE).cast("timestamp"), F.lit(120), F.lit(1440)).alias("freshness"))


@query("""
SELECT user_id AS run_id, event_type AS stage, event_id, epoch(date_trunc('second', lead(ts) OVER w))::BIGINT - epoch(date_trunc('second', ts))::BIGINT AS seconds
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def stage_timings(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.struct("event_id", "event_type").alias("stage"), F.col("ts").cast("timestamp").alias("at"))
    return state.stage_timings(e).select("run_id", "stage.event_type", "stage.event_id", "seconds").withColumnRenamed("event_type", "stage")


@query(f"""
WITH s AS (SELECT user_id, max(ts) AS last, user_id % 5 AS k FROM events GROUP BY 1)
SELECT user_id FROM s WHERE k <> 0 AND epoch(TIMESTAMP '{_LATE}')::BIGINT - epoch(date_trunc('second', last))::BIGINT >= (CASE WHEN k = 1 THEN 60 ELSE 1440 END) * 60
""")
def due_collections(spark, sf_dir):
    """Own schedules override the database's; manual ones are never due."""
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("last_run_at"))
    k = F.col("user_id") % 5
    s = last.withColumns({"collection_minutes": F.when(k == 1, 60), "database_minutes": F.lit(1440), "collection_mode": F.when(k == 0, "manual_only"), "database_mode": F.lit("scheduled")})
    return state.due(s, F.lit(_LATE).cast("timestamp")).select("user_id")


@query("""
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id
""")
def stream_upsert(spark, sf_dir):
    """Events as a stream of files, merged into the last event of each user; read twice, applied once."""
    schema = table(spark, sf_dir, "events").schema
    root, folder = shared_path(spark, "stream"), f"{sf_dir}"
    kept, ledger = KeyedTable(spark, f"{root}/table"), incremental.Ledger(spark, f"{root}/ledger")
    for _ in range(2):
        stream = incremental.read_files(spark, folder, schema, "events.parquet").select("user_id", "event_id", "event_type")
        incremental.upsert_stream(stream, kept, ledger, ["user_id"], f"{root}/checkpoint", ["event_id"]).awaitTermination()
    return kept.read().select("user_id", "event_id", "event_type")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_append_new(spark, sf_dir):
    """A stream whose repeated keys are left out, without a bound on lateness."""
    root, schema = shared_path(spark, "stream"), table(spark, sf_dir, "events").schema
    stream = incremental.read_files(spark, sf_dir, schema, "events.parquet").select("user_id", "event_type")
    incremental.append_new(stream, f"{root}/rows", ["user_id", "event_type"], f"{root}/checkpoint").awaitTermination()
    return spark.read.option("basePath", f"{root}/rows").schema(T._parse_datatype_string("user_id long, event_type string, batch int, part int")).parquet(f"{root}/rows").drop("batch", "part")


_LATER = "TIMESTAMP '2024-02-15'"


@query("SELECT event_type, event_id % 5 = 0 AS undated, count(*) AS rows, sum(event_id)::BIGINT AS ids, 0::BIGINT AS again FROM events GROUP BY 1, 2")
def keyset_stream(spark, sf_dir):
    """A table that grows, as a stream by cursor and id: two deliveries, a run after each, and one with nothing new."""
    spark.dataSource.register(KeysetSource)
    root = shared_path(spark, "keyset")
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ts"), "event_type")
    e = e.withColumn("late", F.coalesce(F.col("ts") >= F.expr(_LATER), F.col("event_id") > 1000))

    def run() -> int:
        stream = spark.readStream.format("keyset").options(path=f"{root}/table", cursor="ts", id="event_id").schema("event_id long, ts timestamp_ntz, event_type string").load()
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/mark").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{root}/out").count()

    for late in (False, True):
        e.filter(F.col("late") == late).drop("late").write.mode("append").parquet(f"{root}/table")
        last = run()
    again = run() - last
    rows = spark.read.parquet(f"{root}/out").groupBy("event_type", (F.col("event_id") % 5 == 0).alias("undated"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).withColumn("again", F.lit(again).cast("long"))


_WANTED = {"view": "running", "click": "success", "error": "failed", "purchase": "retrying", "signup": "skipped"}


@query(f"""
WITH RECURSIVE e AS (SELECT user_id, epoch_ms(ts) AS t, CASE WHEN event_type <> 'view' THEN event_id END AS counted,
    CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _WANTED.items())} END AS wanted,
    row_number() OVER (PARTITION BY user_id // 3 ORDER BY epoch_ms(ts), event_id) AS n, user_id // 3 AS batch FROM events WHERE event_type <> 'signup' OR user_id % 7 = 0),
f AS (SELECT batch, 0::BIGINT AS n, 'queued' AS status, NULL::BIGINT AS rows, 0 AS retry_count, false AS retryable, NULL::BIGINT AS since FROM (SELECT DISTINCT batch FROM e)
  UNION ALL
  SELECT batch, n, CASE WHEN ok THEN wanted ELSE s END, CASE WHEN ok THEN coalesce(counted, rows) ELSE rows END, retry_count + (ok AND wanted = 'retrying')::INTEGER,
    CASE WHEN ok AND wanted IN ('running', 'retrying') THEN false ELSE retryable OR late END,
    CASE WHEN ok THEN CASE WHEN wanted IN ('running', 'retrying') THEN t END WHEN late THEN NULL ELSE since END
  FROM (SELECT *, coalesce((s = 'queued' AND wanted IN ('running', 'skipped')) OR (s IN ('running', 'retrying') AND wanted IN ('success', 'failed', 'skipped')) OR (s = 'failed' AND wanted = 'retrying'), false) AS ok
    FROM (SELECT e.batch, e.n, e.t, e.wanted, e.counted, f.rows, f.retry_count, f.retryable, f.since, coalesce(e.t > f.since + 1800000, false) AS late,
      CASE WHEN e.t > f.since + 1800000 THEN 'failed' ELSE f.status END AS s FROM f JOIN e ON e.batch = f.batch AND e.n = f.n + 1)))
SELECT batch::VARCHAR AS batch_id, CASE WHEN late THEN 'failed' ELSE status END AS status, rows, retry_count, retryable OR late AS retryable
FROM (SELECT *, coalesce((SELECT max(t) FROM e) > since + 1800000, false) AS late, row_number() OVER (PARTITION BY batch ORDER BY n DESC) AS r FROM f) WHERE r = 1
""")
def batch_state_stream(spark, sf_dir):
    """Events as those of batches, on a stream: each batch's state, and which were interrupted after half an hour."""
    key, root = "spark.sql.streaming.stateStore.providerClass", shared_path(spark, "states")
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        e = incremental.read_files(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet").filter("event_type <> 'signup' OR user_id % 7 = 0")
        wanted = F.create_map(*[F.lit(x) for kv in _WANTED.items() for x in kv])[F.col("event_type")]
        rows = e.select(F.expr("user_id div 3").alias("batch_id"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), wanted.alias("status"), F.when(F.col("event_type") != "view", F.col("event_id")).alias("rows"))
        put = lambda df, i: df.write.mode("overwrite").parquet(f"{root}/said/run={i}")
        batches.batch_states(rows).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", f"{root}/mark").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return batches.latest_states(spark.read.parquet(f"{root}/said"))
