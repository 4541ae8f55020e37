"""Loops over batches: from a source into raw files, and from raw batches into a clean table.

The driver only decides which batch comes next; reading, writing and merging are Spark jobs. State is appended after a
batch's result is in place, and a batch that runs again replaces what it wrote before, so a loop that dies, is paused
or is cancelled goes on where it stopped when it is started again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlake.functions.logs import mask_text
from loomlake.functions.names import clean_table_name, quote
from loomlake.operators import flatten as FL
from loomlake.operators import profile as P
from loomlake.operators.events import EventLog
from loomlake.operators.keyed import KeyedTable
from loomlake.operators.partials import ProfileStore
from loomlake.operators.scopes import batch_id, of_batches
from loomlake.operators.state import pending
from loomlake.sources import cursors, documents
from loomlake.storage import discard, shared_path

GROUP = 50
#: Says before each batch whether to go on: run, pause or cancel.
Control = Callable[[], str]
ENDS = {"pause": "paused", "cancel": "cancelled"}
_RAW = "database string, collection string, run_id string, batch_no long, row_count long, token string, checksum string, status string"
_CLEAN = "table_name string, file_id string, status string, row_count long, error string"
#: Typed tables are merged on these keys, all others on silver_row_id.
KEYS = {"users": "user_id", "orders": "order_id", "order_items": "order_item_key", "products": "product_id", "payments": "payment_id"}


def go_on() -> str:
    return "run"


class State:
    """Rows of an append-only table; the tables of all loops below a root are kept apart by name."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path) if documents.exists(self.spark, self.path) else self.spark.createDataFrame([], self.schema)

    def add(self, rows: list[tuple]) -> None:
        """Driver's own notes, some at a time."""
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)


# Source to raw files


@dataclass
class Collected:
    status: str
    batches: int
    rows: int
    skipped: int


def raw_batches(spark: SparkSession, root: str) -> State:
    return State(spark, f"{root}/state/raw_batches", _RAW)


def collect(
    spark: SparkSession, docs: DataFrame, plan: cursors.CursorPlan, root: str, database: str, collection: str, run_id: str, at: Column,
    size: int = cursors.BATCH, id_col: str = "_id", control: Control = go_on, log: EventLog | None = None, ahead: int | None = None,
) -> Collected:
    """Reads what ``docs`` has beyond the last pages into <root>/raw/<database>/<collection>/batch=<n>, ``size`` a page.

    All pages are made in one pass: one scan with the cursor's predicate, one range sort, one write by batch, whatever their
    number. ``control`` is asked before each pass; with ``ahead`` a pass makes so many pages at most, and there are more.
    Documents without a cursor value have pages of their own, by id, after the others; they have a token of their own,
    too, so later documents of either kind are found. A page whose content is that of an earlier one is skipped. A source
    without a cursor is one page. Pages are noted when they are in place; those of a pass that died are written again.
    """
    state, path = raw_batches(spark, root), documents.raw_path(f"{root}/raw", database, collection)
    out = Collected("success", 0, 0, 0)
    tokens = None
    while True:
        said = control()
        if said != "run":
            out.status = ENDS[said]
            break
        mine = state.read().filter((F.col("database") == database) & (F.col("collection") == collection) & F.col("status").isin("success", "skipped"))
        n, before = _last(mine, plan)
        if before == tokens and tokens != (None, None):
            break  # the tokens haven't moved
        tokens, scratch = before, shared_path(spark, "pages")
        try:
            found = _pass(spark, docs, plan, scratch, path, at, size, id_col, ahead, mine, n, tokens, (database, collection))
            if found is not None:
                states = found.select("database", "collection", F.lit(run_id).alias("run_id"), "batch_no", "row_count", "token", "checksum", "status")
                states.coalesce(1).write.mode("append").parquet(state.path)
                good = F.col("status") == "success"
                made = found.agg(F.count_if(good).alias("n"), F.sum(F.when(good, F.col("row_count"))).alias("rows"), F.count_if(~good).alias("skipped")).head()
                out.batches, out.rows, out.skipped = out.batches + made["n"], out.rows + (made["rows"] or 0), out.skipped + made["skipped"]
                if log:
                    log.add(run_id, "raw_batch", "success", f"{database}.{collection}: {made['n']} batches, {made['rows'] or 0} rows, {made['skipped']} skipped")
        finally:
            discard(spark, scratch)
        if found is None or ahead is None or plan.strategy == cursors.SNAPSHOT:
            break
    return out


def _last(mine: DataFrame, plan: cursors.CursorPlan) -> tuple[int, tuple[str | None, str | None]]:
    """The last page's number, and the last tokens of pages with and without cursor values."""
    valued = F.get_json_object("token", "$.value").isNotNull() | ~F.col("token").startswith("{") if plan.strategy == cursors.TIMESTAMP else F.lit(True)
    last = mine.agg(F.max("batch_no").alias("n"), F.max_by("token", F.when(valued, F.col("batch_no"))).alias("dated"), F.max_by("token", F.when(~valued, F.col("batch_no"))).alias("undated")).head()
    return last["n"] or 0, (last["dated"], last["undated"])


def _pass(
    spark: SparkSession, docs: DataFrame, plan: cursors.CursorPlan, scratch: str, path: str, at: Column, size: int, id_col: str,
    ahead: int | None, mine: DataFrame, n: int, tokens: tuple[str | None, str | None], names: tuple[str, str],
) -> DataFrame | None:
    """Writes the next pages and gives their state rows (in ``scratch``); None if nothing is waiting."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    batch, whole = "_batch", plan.strategy == cursors.SNAPSHOT
    rows = docs.withColumn("_undated", F.lit(False)) if whole else cursors.waiting(docs, plan, *tokens, id_col)
    order = [plan.field, id_col] if plan.strategy == cursors.TIMESTAMP else [id_col]
    if ahead is not None and not whole:
        rows = rows.orderBy("_undated", *[quote(c) for c in order]).limit(ahead * size)
    rows = kept(rows, "rows")  # the one scan of the source
    counts = {r["_undated"]: r["n"] for r in rows.groupBy("_undated").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    if whole:
        pages = rows.drop("_undated").withColumn(batch, F.lit(n + 1).cast("long"))
        prints = cursors.snapshot_fingerprint(rows.drop("_undated"), id_col).withColumn("batch_no", F.lit(n + 1).cast("long")).withColumnRenamed("max_cursor", "token")
    else:
        made = []
        for undated, first in ((False, n), (True, n + -(-counts.get(False, 0) // size))):
            if counts.get(undated):
                part, by = rows.filter(F.col("_undated") == undated).drop("_undated"), [quote(c) for c in (order if not undated else [id_col])]
                some = cursors.numbered(part, by, size, lambda df, name=f"sorted-{undated}": kept(df, name))
                made.append(some.withColumn(batch, F.col("batch_no") + first).drop("batch_no"))
        pages = made[0] if len(made) == 1 else made[0].unionByName(made[1])
        prints = cursors.fingerprints(pages, plan, [batch], id_col, resume=True).withColumnsRenamed({batch: "batch_no", "resume": "token"})
    known = mine.select("checksum").distinct().withColumn("_known", F.lit(True))
    again = F.row_number().over(Window.partitionBy("checksum").orderBy("batch_no")) > 1
    judged = prints.withColumn("_again", again).join(known, "checksum", "left")
    status = F.when(F.col("_again") | F.col("_known").isNotNull(), "skipped").otherwise("success")
    states = kept(judged.select(F.lit(names[0]).alias("database"), F.lit(names[1]).alias("collection"), "batch_no", "row_count", "token", "checksum", status.alias("status")), "states")
    fresh = pages.join(states.filter("status = 'success'").select(F.col("batch_no").alias(batch)), batch, "left_semi")
    envelope = documents.enveloped(fresh.withColumnRenamed(batch, "batch"), names[0], names[0], names[0], names[1], at)
    documents.write_raw_batches(envelope, path, at)
    return states


# Raw batches to a clean table


@dataclass
class Target:
    """A clean table and where it is kept."""

    database: str
    collection: str
    root: str
    table: str = ""
    key: str = ""

    def __post_init__(self) -> None:
        self.table = self.table or clean_table_name(self.database, self.collection)
        self.key = self.key or KEYS.get(self.collection, "silver_row_id")

    def kept(self, spark: SparkSession, name: str | None = None) -> KeyedTable:
        return KeyedTable(spark, f"{self.root}/clean/{name or self.table}")


@dataclass
class Processed:
    status: str = "success"
    found: int = 0
    processed: int = 0
    skipped: int = 0
    failed: int = 0
    rows: int = 0
    children: int = 0
    total_rows: int = 0
    seconds: dict[str, float] = field(default_factory=dict)


def clean_states(spark: SparkSession, root: str) -> State:
    return State(spark, f"{root}/state/clean_batches", _CLEAN)


def process(
    spark: SparkSession, target: Target, bronze: DataFrame, file_ids: list[str], run_id: str = "", size: int = GROUP, control: Control = go_on,
    transform: Callable[[DataFrame], DataFrame] | None = None, log: EventLog | None = None,
) -> Processed:
    """Merges the raw files ``file_ids`` of a bronze table into its clean table, ``size`` files at a time.

    Files that were merged before are skipped. A group is read, transformed, merged by hash, its child tables too
    (those of documents without a typed table), and only then noted. A group that fails is noted with its error and the
    next one follows. Each group adds the partial profiles of its files; after the last group the field profile is their sum,
    and the quality of the key is what the table's own record says: nothing is read again. ``file_ids`` are metadata: some
    thousands at most.
    """
    out, state, known = Processed(found=len(file_ids)), clean_states(spark, target.root), target.collection in FL.DOMAIN
    done = state.read().filter((F.col("table_name") == target.table) & (F.col("status") == "success"))
    asked = spark.createDataFrame([(i, f) for i, f in enumerate(file_ids)], "place long, file_id string")
    waiting = [r["file_id"] for r in pending(asked, done).orderBy("place").collect()]
    out.skipped = len(file_ids) - len(waiting)
    make = transform or (lambda rows: FL.transform(rows, target.collection, target.table))
    for first in range(0, len(waiting), size):
        said = control()
        if said != "run":
            out.status = ENDS[said]
            break
        group = waiting[first : first + size]
        scratch = shared_path(spark, "group")
        try:
            rows = _group(spark, of_batches(bronze, group).withColumn("_batch", batch_id(bronze)), scratch)
            metrics = _timed(out, "merge", lambda r=rows: target.kept(spark).upsert(make(r.drop("_batch")), [target.key], "silver_record_hash"))
            _timed(out, "profile", lambda r=rows: _profiles(spark, target).add(r, "_batch"))
            if not known and transform is None:
                out.children += _timed(out, "children", lambda r=rows: _merge_children(spark, target, r.drop("_batch")))
        except PySparkException as e:
            state.add([(target.table, f, "failed", 0, mask_text(str(e))[:500]) for f in group])
            out.failed, out.status = out.failed + len(group), "failed"
            if log:
                log.add(run_id, "clean_batch", "failed", str(e)[:500])
            continue
        finally:
            discard(spark, scratch)
        state.add([(target.table, f, "success", metrics["changed"], None) for f in group])
        out.processed, out.rows, out.total_rows = out.processed + len(group), out.rows + metrics["changed"], metrics["total"]
        if log:
            log.add(run_id, "clean_batch", "success", f"{target.table}: {metrics['inserted']} inserted, {metrics['updated']} updated")
    if out.processed:
        _timed(out, "metadata", lambda: _describe(spark, target, bronze))
    return out


def _group(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """A group's rows, read from their source once: the merge, the profiles and the child tables take them from here."""
    if "void" in rows.schema.simpleString():  # files can't hold it
        return rows
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _timed(out: Processed, name: str, do: Callable):
    began = time.monotonic()
    try:
        return do()
    finally:
        out.seconds[name] = out.seconds.get(name, 0.0) + time.monotonic() - began


def _merge_children(spark: SparkSession, target: Target, rows: DataFrame) -> int:
    """Child rows that changed. Tables without rows are not made."""
    changed = 0
    for name, child in FL.child_tables(rows, FL.row_id(rows), target.table).items():
        changed += target.kept(spark, name).upsert(child, ["child_record_id"], None)["changed"]
    return changed


def _profiles(spark: SparkSession, target: Target) -> ProfileStore:
    return ProfileStore(spark, f"{target.root}/profiles/{target.table}")


def _describe(spark: SparkSession, target: Target, bronze: DataFrame) -> None:
    facts = spark.createDataFrame(P.field_facts(bronze.schema), "field_path string, detected_type string, depth int, flattening_strategy string, pii_detected boolean")
    signature = P.metadata_signature({"schema": bronze.schema.jsonValue()})
    counted = _profiles(spark, target).read().drop("depth").join(facts, ["field_path", "detected_type"])
    target.kept(spark, f"{target.table}_profile").write(counted.withColumn("signature", F.lit(signature)))
    rows = target.kept(spark).rows()  # a merged table has each key once, and none that is null
    target.kept(spark, f"{target.table}_quality").write(spark.createDataFrame([(rows, 0, rows, 0)], "total_rows long, null_keys long, distinct_keys long, duplicate_keys long"))
