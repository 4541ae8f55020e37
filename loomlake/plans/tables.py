"""Queries on documents and clean tables: flattening, normalisation, child tables, typed tables, profiles, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions import columns as C
from loomlake.operators import audits, census, contents, partials
from loomlake.operators import flatten as FL
from loomlake.operators import profile as P
from loomlake.plans.registry import query, table
from loomlake.sources import bronze, cursors, documents
from loomlake.storage import shared_path

_ENUM = r"lower(regexp_replace(trim({}), '[\s-]+', '_', 'g'))"


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested documents: items as an array of structs in a fixed order."""
    item = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("sku"), F.col("l_quantity").cast("long").alias("qty"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    o = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    extra = F.struct(F.col("o_orderpriority").alias("channel"), (F.col("o_orderstatus") == "F").alias("giftWrap"), F.lit(" High-Touch ").alias("priority"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_custkey").cast("string").alias("customerId"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalAmount"), F.lit(" usd").alias("currency"), "items", extra.alias("extraFields"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("createdAt"),
    )


@query(f"""
SELECT o_orderkey, o_custkey, {_ENUM.format('o_orderstatus')} AS o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, trim(o_orderpriority) AS o_orderpriority FROM orders
""")  # fmt: skip
def flatten_normalize_orders(spark, sf_dir):
    return FL.flatten(table(spark, sf_dir, "orders"))


@query(f"SELECT p_partkey, {_ENUM.format('p_type')} AS p_type, {_ENUM.format('p_brand')} AS brand, upper(trim(p_name)) AS name FROM part")
def enum_normalize_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", C.enum_text(F.col("p_type")).alias("p_type"), C.enum_text(F.col("p_brand")).alias("brand"), C.upper_code(F.col("p_name")).alias("name"))


@query("SELECT o_orderkey, sha256(concat_ws('||', coalesce(o_orderkey::VARCHAR, ''), coalesce(o_custkey::VARCHAR, ''), coalesce(o_orderstatus, ''))) AS h FROM orders")
def stable_hash_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.stable_hash(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")).alias("h"))


_ITEMS = """WITH i AS (SELECT l_orderkey::VARCHAR AS id, l_linenumber AS line, l_partkey::VARCHAR AS sku, l_quantity::BIGINT AS qty,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey::VARCHAR, l_quantity::BIGINT) - 1 AS idx
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(f"""{_ITEMS}
SELECT sha256(id || '||items||' || idx || '||{{"_element":{{"line":' || line || ',"sku":"' || sku || '","qty":' || qty || '}}}}') AS child_record_id,
       id AS parent_record_id, NULL::VARCHAR AS parent_record_hash, NULL::VARCHAR AS source_db, NULL::VARCHAR AS source_collection,
       'shop__orders_clean' AS source_table, 'items' AS child_path, idx::INTEGER AS child_index, line, sku, qty FROM i
""")  # fmt: skip
def child_explode_lineitems(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    return FL.child_table(docs, "items", F.col("_id"), "shop__orders_clean")


@query(f"""{_ITEMS}, g AS (SELECT id, count(*)::INTEGER AS n, sum(qty)::INTEGER AS q FROM i GROUP BY id)
SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id, {_ENUM.format('o_orderstatus')} AS order_status,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, 'USD' AS currency_code, n AS item_count, q AS total_quantity,
  NULL::VARCHAR AS customer_email, NULL::VARCHAR AS customer_phone, {_ENUM.format('o_orderpriority')} AS channel, o_orderstatus = 'F' AS gift_wrap,
  NULL::VARCHAR AS checkout_experiment, 'high_touch' AS priority, NULL::VARCHAR AS promo_code, strftime(o_orderdate, '%Y-%m-%d') AS created_on
FROM orders LEFT JOIN g ON id = o_orderkey::VARCHAR
""")  # fmt: skip
def domain_orders(spark, sf_dir):
    rows = FL.orders(order_documents(spark, sf_dir))
    return rows.withColumn("created_on", F.date_format("created_at", "yyyy-MM-dd")).drop("created_at", "updated_at")


@query(f"""{_ITEMS}
SELECT sha256(id || '||' || idx || '||' || trim(sku)) AS order_item_key, id AS order_id, idx::INTEGER AS item_index, trim(sku) AS sku, qty::INTEGER AS quantity FROM i
""")  # fmt: skip
def domain_order_items(spark, sf_dir):
    return FL.order_items(order_documents(spark, sf_dir))


@query(f"""
SELECT p_partkey::VARCHAR AS product_id, p_brand AS sku, trim(p_name) AS product_name, {_ENUM.format('p_type')} AS category, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
  split_part(p_name, ' ', 1) AS attribute_color, NULL::VARCHAR AS attribute_material, p_size::BIGINT AS attribute_dimensions_w, NULL::BIGINT AS attribute_dimensions_h,
  NULL::BIGINT AS attribute_lumens, p_size > 25 AS attribute_smart, NULL::BIGINT AS attribute_capacityml, NULL::BOOLEAN AS attribute_insulated,
  NULL::VARCHAR AS compatibility, replace(p_name, ' ', ',') AS tags, NULL::VARCHAR AS supplier_id, NULL::VARCHAR AS contract_tier FROM part
""")  # fmt: skip
def domain_products(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    attributes = F.struct(words[0].alias("color"), F.struct(F.col("p_size").alias("w")).alias("dimensions"), (F.col("p_size") > 25).alias("smart"), words.alias("tags"))
    docs = p.select(F.col("p_partkey").alias("_id"), F.col("p_brand").alias("sku"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"), attributes.alias("attributes"))
    return FL.products(docs).drop("created_at", "updated_at")


@query(f"""
SELECT o_orderkey::VARCHAR AS payment_id, o_orderkey::VARCHAR AS order_id, {_ENUM.format('o_orderpriority')} AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  {_ENUM.format('o_orderstatus')} AS payment_status, NULL::VARCHAR AS provider_ref, NULL::VARCHAR AS gateway_avs, (o_custkey % 100)::INTEGER AS gateway_riskscore,
  'north gate' AS gateway_processor, NULL::VARCHAR AS gateway_payercountry, NULL::VARCHAR AS gateway_fraudcheck, NULL::VARCHAR AS gateway_deviceaccount, NULL::VARCHAR AS gateway_network
FROM orders
""")  # fmt: skip
def domain_payments(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    gateway = F.struct((F.col("o_custkey") % 100).alias("riskScore"), F.lit("north gate").alias("processor"))
    docs = o.select(F.col("o_orderkey").alias("_id"), F.col("o_orderkey").alias("orderId"), F.col("o_orderpriority").alias("method"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"), gateway.alias("gatewayResponse"))
    return FL.payments(docs).drop("created_at", "updated_at")


@query(f"""
SELECT c_custkey::VARCHAR AS user_id, trim(c_name) AS full_name, lower('C' || c_custkey || '@Example.org') AS email, NULL::VARCHAR AS phone,
  upper(n_name) AS country_code, upper(n_name) AS country_name, {_ENUM.format('c_mktsegment')} AS preferred_theme, c_acctbal > 0 AS email_notifications_enabled,
  NULL::BOOLEAN AS sms_notifications_enabled, NULL::BOOLEAN AS newsletter_enabled, c_mktsegment || ',' || n_name AS segments, NULL::VARCHAR AS preferred_categories,
  NULL::BOOLEAN AS marketing_consent FROM customer JOIN nation ON c_nationkey = n_nationkey
""")  # fmt: skip
def domain_users(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    preferences = F.struct(F.col("c_mktsegment").alias("theme"), F.struct((F.col("c_acctbal") > 0).alias("email")).alias("notifications"), F.array("c_mktsegment", "n_name").alias("segments"))
    docs = c.select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"), F.concat(F.lit(" C"), F.col("c_custkey"), F.lit("@Example.org ")).alias("email"), F.col("n_name").alias("country"), preferences.alias("preferences"))
    return FL.users(docs).drop("created_at", "updated_at")


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def json_props_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k long").alias("props"))
    return FL.flatten(e)


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS types, count(*)::INTEGER AS n FROM events GROUP BY user_id")
def array_to_csv(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("e"))
    docs = rows.select("user_id", F.struct(F.transform("e", lambda x: x["event_type"]).alias("types")).alias("seen"))
    return docs.select("user_id", C.array_csv(docs, "seen.types").alias("types"), F.size("seen.types").alias("n"))


@query("""
WITH d AS (SELECT event_id, event_type, value, ts FROM events)
SELECT event_id, value > 50 AS is_large, CASE WHEN value > 50 THEN CAST(value AS DECIMAL(18,2)) END AS amount, upper(trim(event_type)) AS currency,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, NULL::DATE AS due_date,
  '{"a":' || (event_id % 7) || '}' AS extra_raw_json, 2::INTEGER AS tags_count, 'x' AS note FROM d
""")
def normalize_by_name(spark, sf_dir):
    """Every rule of the type normaliser: flags, money, codes, times, dates that don't parse, maps, arrays, blanks."""
    e = table(spark, sf_dir, "events")
    docs = e.select(
        "event_id", (F.col("value") > 50).cast("string").alias("is_large"), F.when(F.col("value") > 50, F.col("value").cast("string")).otherwise("n/a").alias("amount"),
        F.concat(F.lit(" "), "event_type").alias("currency"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), F.lit("soon").alias("due_date"),
        F.create_map(F.lit("a"), F.col("event_id") % 7).alias("extra"), F.array("event_type", F.lit("y")).alias("tags"), F.lit(" x ").alias("note"),
    )
    return FL.flatten(docs).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query(f"""{_ITEMS}
SELECT o_orderkey::VARCHAR AS silver_row_id, o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS customerid, {_ENUM.format('o_orderstatus')} AS status,
  (SELECT count(*) FROM i WHERE i.id = o_orderkey::VARCHAR)::INTEGER AS n_items
FROM orders
""".replace("(SELECT count(*) FROM i WHERE i.id = o_orderkey::VARCHAR)::INTEGER AS n_items\nFROM orders", "g.n::INTEGER AS n_items\nFROM orders LEFT JOIN (SELECT id, count(*) AS n FROM i GROUP BY id) g ON g.id = o_orderkey::VARCHAR"))  # fmt: skip
def clean_orders(spark, sf_dir):
    """The generic clean table of nested documents with _id as key."""
    clean = FL.clean_table(order_documents(spark, sf_dir), "shop__orders_clean", key="_id")
    return clean.select("silver_row_id", "id", "customerid", "status", F.col("items_count").alias("n_items"))


@query("""
WITH c AS (SELECT *, md5(c_custkey::VARCHAR) AS h, 'f' || (c_custkey % 3) AS f, '2024-03-01 05:30:00' AS t FROM customer)
SELECT h AS silver_row_id, 'src' AS source_id, f AS raw_file_id, h AS bronze_record_hash, t AS bronze_ingested_at, true AS dated,
  sha256(concat_ws('||', h, 'src', '', '', '', '', f, '', h, t, c_custkey::VARCHAR, c_nationkey::VARCHAR, trim(c_mktsegment))) AS silver_record_hash FROM c
""")
def clean_audit_columns(spark, sf_dir):
    """Row id, lineage, hash and times of processing of a clean table."""
    c = table(spark, sf_dir, "customer")
    docs = c.select(
        "c_custkey", "c_nationkey", "c_mktsegment", F.lit("src").alias("_source_id"), F.concat(F.lit("f"), F.col("c_custkey") % 3).alias("_raw_file_id"),
        F.md5(F.col("c_custkey").cast("string")).alias("_record_hash"), F.lit("2024-03-01 05:30:00").cast("timestamp").alias("_bronze_ingested_at"),
    )
    clean = FL.clean_table(docs, "shop__customers_clean")
    dated = (F.to_date("silver_processed_at") == F.col("silver_ingestion_date")) & (F.col("silver_processed_at") > F.col("bronze_ingested_at"))
    return clean.select("silver_row_id", "source_id", "raw_file_id", "bronze_record_hash", F.col("bronze_ingested_at").cast("string").alias("bronze_ingested_at"), dated.alias("dated"), "silver_record_hash")


# Profiles and quality


@query("""
WITH c AS (SELECT count(*) AS n, count(event_id) AS a, count(ts) AS b, count(user_id) AS c, count(event_type) AS d, count(value) AS e, count(props) AS f FROM events)
SELECT v.field_path, v.detected_type, 1 AS depth, v.k AS occurrence_count, c.n AS total_rows, 'column' AS flattening_strategy, false AS pii_detected,
       round(v.k / c.n * 100, 2) AS occurrence_percent
FROM c, LATERAL (VALUES ('event_id', 'bigint', c.a), ('ts', 'timestamp_ntz', c.b), ('user_id', 'bigint', c.c), ('event_type', 'string', c.d), ('value', 'double', c.e),
  ('props', 'string', c.f)) v(field_path, detected_type, k)
""")
def field_profile_events(spark, sf_dir):
    return P.field_profile(table(spark, sf_dir, "events"))


@query("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE k IS NULL) AS null_keys, count(DISTINCT k) AS distinct_keys,
       greatest(count(*) - count(*) FILTER (WHERE k IS NULL) - count(DISTINCT k), 0) AS duplicate_keys
FROM (SELECT l_orderkey || '|' || l_linenumber AS k FROM lineitem)
""")
def quality_metrics_lineitem(spark, sf_dir):
    return P.key_quality(table(spark, sf_dir, "lineitem"), F.concat_ws("|", "l_orderkey", "l_linenumber"))


@query("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE l_orderkey IS NULL) AS null_keys, count(DISTINCT l_orderkey) AS distinct_keys,
       greatest(count(*) - count(*) FILTER (WHERE l_orderkey IS NULL) - count(DISTINCT l_orderkey), 0) AS duplicate_keys FROM lineitem
""")
def duplicate_keys(spark, sf_dir):
    return P.key_quality(table(spark, sf_dir, "lineitem"), F.col("l_orderkey"))


@query("""
SELECT (SELECT count(*) FROM orders WHERE lower(o_orderstatus) NOT IN ('completed', 'processing', 'pending', 'cancelled', 'incremental_bronze_test', 'incremental_test')) AS unknown_states,
       (SELECT count(*) FROM part WHERE p_retailprice IS NULL OR p_retailprice < 0) AS bad_prices
""")
def domain_checks(spark, sf_dir):
    states = table(spark, sf_dir, "orders").agg(P.outside(C.enum_text(F.col("o_orderstatus")), P.ORDER_STATES).alias("unknown_states"))
    return states.join(table(spark, sf_dir, "part").agg(P.bad_prices(F.col("p_retailprice")).alias("bad_prices")))  # a row each


@query("""
SELECT * FROM (VALUES ('orders', 'changed', 'o_orderstatus:int', 'o_orderpriority:string,o_orderstatus:string'), ('part', 'unchanged', '', ''),
  ('region', 'initial', 'r_name:string,r_regionkey:int', '')) v(table_name, change_type, new_fields, removed_fields)
""")
def schema_drift(spark, sf_dir):
    o, p, r = (table(spark, sf_dir, t) for t in ("orders", "part", "region"))
    later = o.drop("o_orderpriority").withColumn("o_orderstatus", F.lit(1)).schema
    cases = [("orders", o.schema, later), ("part", p.schema, p.schema), ("region", None, r.schema)]
    rows = [P.schema_drift(spark, old, new).withColumn("table_name", F.lit(n)) for n, old, new in cases]
    joined = lambda c: F.array_join(c, ",").alias(c)
    return rows[0].union(rows[1]).union(rows[2]).select("table_name", "change_type", joined("new_fields"), joined("removed_fields"))


@query("""
SELECT * FROM (VALUES ('shop__orders_clean', 'transactional', 'bi_ready', 'ready', 100.0::DOUBLE, 100.0::DOUBLE, ''), ('shop__part_clean', 'pii_sensitive', 'bi_ready', 'ready', 100.0, 98.8, ''),
  ('shop__customer_clean', 'pii_sensitive', 'bi_ready', 'ready', 100.0, 98.8, ''), ('shop__events_clean', 'log_like', 'limited', 'ready', 100.0, 100.0, ''))
  v(table_name, classification, suitability, status, bi_readiness, analytics_readiness, reasons)
""")
def readiness_scores(spark, sf_dir):
    """Readiness of clean tables from their schemas."""
    rows = []
    for name in ("orders", "part", "customer", "events"):
        df = order_documents(spark, sf_dir) if name == "orders" else table(spark, sf_dir, name)
        clean = FL.clean_table(df, f"shop__{name}_clean")
        r = P.readiness(df.schema, clean.schema, f"shop__{name}_clean", name)
        rows.append((r["table"], r["classification"], r["suitability"], r["status"], r["bi_readiness"], r["analytics_readiness"], "; ".join(r["reasons"])))
    return spark.createDataFrame(rows, "table_name string, classification string, suitability string, status string, bi_readiness double, analytics_readiness double, reasons string")


@query("""
SELECT v.*, CASE field_path WHEN 'email' THEN a WHEN 'mobilePhone' THEN b ELSE c END AS filled
FROM (VALUES ('email', 'email', 'column_name_contains_email', 0.98::DOUBLE, 'exposed'), ('mobilePhone', 'phone', 'column_name_contains_phone', 0.85, 'hashed'),
  ('profile.passportNo', 'passport', 'column_name_contains_passport', 0.85, 'excluded')) v(field_path, pii_type, rule, confidence, protection),
  (SELECT count(c_name) AS a, count(c_name) FILTER (WHERE c_custkey % 3 = 0) AS b, count(c_name) FILTER (WHERE c_custkey % 7 = 0) AS c FROM customer)
""")
def pii_audit(spark, sf_dir):
    """Fields with personal data of nested documents, how a view protects them, and in how many documents they are filled."""
    some = lambda n: F.when(F.col("c_custkey") % n == 0, F.col("c_name"))
    docs = table(spark, sf_dir, "customer").select(F.col("c_name").alias("email"), some(3).alias("mobilePhone"), F.col("c_acctbal").alias("age"), F.struct(some(7).alias("passportNo"), F.col("c_mktsegment").alias("city")).alias("profile"))
    found = [x[1:6] for x in audits.pii_rows(docs.schema, ["email", "mobilephone_hash", "age"])]
    rows = spark.createDataFrame(found, "field_path string, pii_type string, rule string, confidence double, protection string")
    return rows.join(P.field_profile(docs).select("field_path", F.col("occurrence_count").alias("filled")), "field_path")


# Files and bronze tables


@query("""
SELECT n_nationkey, n_name, n_regionkey, 'src1' AS source_id, 'geo' AS source_db, 'nations' AS source_collection, '2024-03-01' AS dt, '05' AS hr FROM nation
""")
def raw_round_trip(spark, sf_dir):
    """Documents written as gzipped JSON lines with their envelope, and read back."""
    at = F.lit("2024-03-01 05:30:00").cast("timestamp")
    path = documents.raw_path(shared_path(spark, "raw"), "geo", "nations")
    documents.write_raw(documents.enveloped(table(spark, sf_dir, "nation"), "src1", "Source", "geo", "nations", at), path, at)
    schema = "n_nationkey int, n_name string, n_regionkey int, __source_id string, __source_db string, __source_collection string, dt string, hr string"
    back = documents.read_raw(spark, path, schema)
    return back.select("n_nationkey", "n_name", "n_regionkey", F.col("__source_id").alias("source_id"), F.col("__source_db").alias("source_db"), F.col("__source_collection").alias("source_collection"), "dt", "hr")


@query("SELECT count(*) AS row_count, 0::BIGINT AS bad_lines FROM events")
def raw_verify(spark, sf_dir):
    at = F.lit("2024-03-01 05:30:00").cast("timestamp")
    path = shared_path(spark, "raw")
    documents.write_raw(table(spark, sf_dir, "events"), path, at)
    return documents.verify_raw(spark, path).agg(F.sum("row_count").alias("row_count"), F.sum("bad_lines").alias("bad_lines"))


@query("""
SELECT p_partkey AS part_key, p_name AS col_1_name, p_size AS size_cm, p_brand || '/' || p_type AS nested, p_brand AS "é", p_size AS "a_b_", p_size + 1 AS "_", p_size + 2 AS "a$b",
  sha256('{"_":' || (p_size + 1) || ',"a$b":' || (p_size + 2) || ',"a_b_":' || p_size || ',"col_1_name":"' || p_name || '","nested":{"a_b":"' || p_brand || '","a_b_2":"' || p_type
    || '"},"part_key":' || p_partkey || ',"size_cm":' || p_size || ',"é":"' || p_brand || '"}') AS record_hash,
  'r1' AS raw_run_id FROM part
""")  # fmt: skip
def bronze_parts(spark, sf_dir):
    """Unsafe names at two depths made safe, those that are fine in any letters kept, with audit columns and content hash."""
    p = table(spark, sf_dir, "part")
    docs = p.select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("1 name"), F.col("p_size").alias("size(cm)"), F.struct(F.col("p_brand").alias("a.b"), F.col("p_type").alias("a b")).alias("nested"),
                    F.col("p_brand").alias("é"), F.col("p_size").alias("a b_"), (F.col("p_size") + 1).alias("_"), (F.col("p_size") + 2).alias("a$b"))
    rows = bronze.bronze_table(documents.enveloped(docs, "s", "S", "shop", "parts", F.current_timestamp()), "r1", F.current_timestamp())
    return rows.select("part_key", "col_1_name", "size_cm", F.concat_ws("/", "nested.a_b", "nested.a_b_2").alias("nested"), "é", "a_b_", "_", "a$b", F.col("_record_hash").alias("record_hash"), F.col("_raw_run_id").alias("raw_run_id"))


@query("""
SELECT r_name AS source_id, 'c' || n_nationkey AS collection FROM region JOIN nation ON r_regionkey = n_regionkey
""")
def active_collections(spark, sf_dir):
    """Lists of names, and of objects with names, in JSON; system collections are left out."""
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(F.concat(F.lit("c"), F.col("n_nationkey"))).alias("c"))
    joined = table(spark, sf_dir, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"))
    objects = F.to_json(F.transform("c", lambda x: F.struct(x.alias("name"), F.lit(True).alias("active"))))
    plain = F.to_json(F.concat("c", F.array(F.lit("system.views"))))
    return documents.active_collections(joined.select(F.col("r_name").alias("source_id"), F.when(F.col("r_regionkey") % 2 == 0, objects).otherwise(plain).alias("active_collections_json")))


@query("SELECT 'incremental_timestamp' AS strategy, 'created_at' AS field, count(*) AS n FROM events")
def cursor_detection(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("_id"), F.col("ts").alias("created_at"), F.lit("never").alias("updatedAt"))
    plan = cursors.detect_cursor(e)
    return e.agg(F.lit(plan.strategy).alias("strategy"), F.lit(plan.field).alias("field"), F.count(F.lit(1)).alias("n"))


_PLAN = cursors.CursorPlan(cursors.TIMESTAMP, "ts")


@query("""
SELECT event_id, user_id FROM events, (SELECT ts AS t, event_id AS i FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 199) WHERE ts > t OR (ts = t AND event_id > i) ORDER BY ts, event_id LIMIT 1000
""")
def cursor_page(spark, sf_dir):
    """The page after the first 200 events; the token is what a first read would have left."""
    e = table(spark, sf_dir, "events")
    first = cursors.next_page(e, _PLAN, None, 200, "event_id").select(F.max(F.struct("ts", "event_id", cursors.token_column(_PLAN, "event_id").alias("t"))).alias("m"))
    token = first.head()["m"]["t"]
    return cursors.next_page(e, _PLAN, token, 1000, "event_id").select("event_id", "user_id")


@query("SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 + 1 AS batch_no FROM events")
def batch_numbers(spark, sf_dir):
    return cursors.numbered(table(spark, sf_dir, "events"), ["ts", "event_id"], 1000).select("event_id", "batch_no")


@query("""
WITH n AS (SELECT event_id, ts, event_type, user_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 + 1 AS batch_no FROM events),
h AS (SELECT batch_no, ts, event_id, md5(event_id || '|' || ts::VARCHAR || '|{"event_id":' || event_id || ',"event_type":"' || event_type || '","ts":"' ||
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","user_id":' || user_id || '}') AS h,
  '{"kind":"timestamp","field":"ts","value":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","_id":"' || event_id || '"}' AS t FROM n)
SELECT batch_no, count(*) AS row_count, arg_min(t, (ts, event_id::VARCHAR)) AS min_cursor, arg_max(t, (ts, event_id::VARCHAR)) AS max_cursor,
  substring(md5(string_agg(h, '|' ORDER BY ts, event_id::VARCHAR)), 1, 12) AS checksum FROM h GROUP BY batch_no
""")
def batch_fingerprint(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    return cursors.fingerprints(cursors.numbered(e, ["ts", "event_id"], 1000), _PLAN, ["batch_no"], "event_id")


@query("SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '://[^/@\\s:]+:[^/@\\s]+@', '://***:***@', 'g'), '\\b(password|passwd|secret|token|api_key|access_key)\\s*[=:]\\s*[^\\s,;&]+', '\\1=***', 'gi') AS text FROM conversations")
def mask_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", C.masked(F.col("text")).alias("text"))


_FIELDS = {"event_id": True, "ts": False, "user_id": True, "event_type": False, "value": True, "props": False}


@query(" UNION ALL ".join(f"""SELECT '{c}' AS field_path, count({c}) AS occurrence_count, count(*) AS total_rows, {f'min({c})' if n else 'NULL'}::DOUBLE AS least,
  {f'max({c})' if n else 'NULL'}::DOUBLE AS most, true AS distinct_within, true AS median_within FROM events""" for c, n in _FIELDS.items()))
def profile_by_batch(spark, sf_dir):
    """Profiles of seven batches, one delivered twice, merged: counts as of the whole table, estimates within their bounds."""
    e = table(spark, sf_dir, "events")
    store = partials.ProfileStore(spark, shared_path(spark, "profiles"))
    for some in ("event_id % 7 < 4", "event_id % 7 >= 3"):
        store.add(e.filter(some).withColumn("part", F.col("event_id") % 7), "part")
    true = e.agg(*[F.struct(F.count_distinct(c).alias("n"), F.percentile(c, F.array(F.lit(0.45), F.lit(0.55))).alias("q") if n else F.lit(None).alias("q")).alias(c) for c, n in _FIELDS.items()])
    exact = true.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field_path"), F.col(c)["n"].alias("n"), F.col(c)["q"].cast("array<double>").alias("q")) for c in _FIELDS])))
    got = store.read().join(exact, "field_path")
    near = F.abs(F.col("distinct_estimate") - F.col("n")) <= 0.08 * F.col("n")
    middle = F.col("q").isNull() | F.col("quantiles")[1].between(F.col("q")[0], F.col("q")[1])
    return got.select("field_path", "occurrence_count", "total_rows", "least", "most", near.alias("distinct_within"), middle.alias("median_within"))


_MIXED = """'{"k":' || o_orderkey || ',"p":' || CASE o_orderkey % 5 WHEN 0 THEN '"' || o_orderpriority || '"' WHEN 1 THEN '[1,"a",{"z":null}]'
  WHEN 2 THEN '{"q":{"r":true}}' WHEN 3 THEN '2.5' ELSE '[]' END || '}'"""


@query(rf"""
WITH d AS (SELECT o_orderkey, {_MIXED} AS j FROM orders UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 11 = 0),
t AS (SELECT o_orderkey, CASE WHEN fullkey = '$' THEN '$' ELSE regexp_replace(fullkey, '\[[0-9]+\]', '[]', 'g') END AS path,
  CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END AS type
  FROM d, json_tree(j) WHERE json_valid(j))
SELECT path, type, count(*) AS count, count(DISTINCT o_orderkey) AS documents FROM t GROUP BY ALL
UNION ALL SELECT '$', 'invalid', count(*), count(*) FROM d WHERE NOT json_valid(j) HAVING count(*) > 0
""")
def document_paths(spark, sf_dir):
    """Paths and types over lines of mixed documents, some of which aren't JSON."""
    o = table(spark, sf_dir, "orders")
    bad = o.filter("o_orderkey % 11 = 0").select(F.col("o_orderpriority").alias("value"))
    return census.path_census(o.select(F.expr(_MIXED).alias("value")).union(bad))


@query("""
SELECT o_orderkey + CASE kind WHEN 'extra' THEN 1000000000 ELSE 0 END AS key, kind AS status, CASE kind WHEN 'extra' THEN 0 ELSE 1 END::BIGINT AS left_rows,
  CASE kind WHEN 'missing' THEN 0 WHEN 'repeated' THEN 2 ELSE 1 END::BIGINT AS right_rows
FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_orderkey % 3000 = 7 THEN 'changed' WHEN o_orderkey % 3000 = 3 THEN 'missing' WHEN o_orderkey % 3000 = 33 THEN 'repeated' END,
  CASE WHEN o_orderkey % 3000 = 5 THEN 'extra' END], lambda x: x IS NOT NULL)) AS kind FROM orders)
""")
def content_differences(spark, sf_dir):
    """Orders and a copy of them with a few rows changed, missing, doubled and added: each is named."""
    o, r = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 3000
    moved = o.filter(r == 5).withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    copy = o.filter(r != 3).withColumn("o_totalprice", F.when(r == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    found = contents.differences(o, copy.union(o.filter(r == 33)).union(moved), "o_orderkey")
    return found.select("key", "status", F.col("left_rows").cast("long").alias("left_rows"), F.col("right_rows").cast("long").alias("right_rows"))
