"""Incremental reads of document tables: which column serves as cursor, where a read resumes, and what a batch holds.

A cursor is a position in the order (cursor, id). Reads are keyset predicates that reach the scan, never offsets.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import field_of, list_hash
from loomlake.functions.names import quote
from loomlake.storage import written

# Time columns that are tried in this order, and the names of the strategies.
CANDIDATES = ("updatedAt", "updated_at", "modifiedAt", "modified_at", "lastModified", "last_modified", "createdAt", "created_at")
TIMESTAMP, OBJECT_ID, SNAPSHOT = "incremental_timestamp", "incremental_objectid", "snapshot_fingerprint"
SAMPLE, BATCH = 200, 1000
_OBJECT_ID = r"^[0-9a-f]{24}$"


@dataclass(frozen=True)
class CursorPlan:
    strategy: str
    field: str | None
    kind: str = "timestamp"
    warnings: tuple[str, ...] = ()


def sample(docs: DataFrame, id_col: str = "_id", n: int = SAMPLE) -> DataFrame:
    return docs.orderBy(id_col).limit(n)


def _as_time(docs: DataFrame, name: str) -> Column:
    c = F.col(quote(name))
    kind = field_of(docs.schema, name).dataType
    return c.cast("timestamp") if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType) else F.try_to_timestamp(c.cast("string"))


def detect_cursor(docs: DataFrame, configured: str = "auto", id_col: str = "_id") -> CursorPlan:
    """The configured column if the sample has times in it, else the first of CANDIDATES that has, else an id that is
    an object id throughout, else snapshots. One aggregate over the sample decides."""
    auto = configured.strip().lower() in ("", "auto", "__auto__")
    order = ([] if auto else [configured]) + [c for c in CANDIDATES if c != configured]
    there = [c for c in order if c in docs.columns]
    has_id = id_col in docs.columns
    rows = sample(docs, id_col) if has_id else docs.limit(SAMPLE)
    got = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(_as_time(docs, c)).alias(f"usable_{i}") for i, c in enumerate(there)],
        *[F.count(F.col(quote(c))).alias(f"present_{i}") for i, c in enumerate(there)],
        (F.count_if(F.col(quote(id_col)).cast("string").rlike(_OBJECT_ID)) if has_id else F.lit(0)).alias("ids"),
    ).head()
    if not got["n"]:
        return CursorPlan(SNAPSHOT, None, "snapshot", ("no documents yet",))
    unusable = () if auto else (f"{configured} is not usable",)
    for i, c in enumerate(there):
        if got[f"usable_{i}"]:
            short = got["n"] - got[f"present_{i}"]
            warn = (unusable if c != configured else ()) + ((f"{short} sampled documents lack {c}",) if short else ())
            return CursorPlan(TIMESTAMP, c, "string" if isinstance(field_of(docs.schema, c).dataType, T.StringType) else "timestamp", warn)
    if got["ids"] == got["n"]:
        return CursorPlan(OBJECT_ID, id_col, "objectid", unusable)
    return CursorPlan(SNAPSHOT, None, "snapshot", unusable or ("no cursor column was found",))


# Tokens: where a read resumes


def encode_token(plan: CursorPlan, value: str | None, doc_id: str | None) -> str:
    """An id for object-id cursors and snapshots, JSON of kind, field, value and id for times."""
    if plan.strategy != TIMESTAMP:
        return str(doc_id)
    return json.dumps({"kind": "timestamp", "field": plan.field, "value": value, "_id": doc_id}, separators=(",", ":"))


def decode_token(token: str | None) -> tuple[str | None, str | None]:
    """(value, id) of a token; a text that isn't JSON is a bare value."""
    if not token:
        return None, None
    if token.lstrip().startswith("{"):
        try:
            found = json.loads(token)
        except ValueError:
            return token, None
        return found.get("value"), found.get("_id")
    return token, None


def token_column(plan: CursorPlan, id_col: str = "_id") -> Column:
    doc = F.col(quote(id_col)).cast("string")
    if plan.strategy != TIMESTAMP:
        return doc
    value = F.date_format(F.col(quote(plan.field)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if plan.kind == "timestamp" else F.col(quote(plan.field))
    return F.to_json(F.struct(F.lit("timestamp").alias("kind"), F.lit(plan.field).alias("field"), value.alias("value"), doc.alias("_id")))


def after(plan: CursorPlan, token: str | None, id_col: str = "_id") -> Column:
    """Rows beyond a token: later cursor, or the same and a larger id. Snapshots and first reads take all rows. Rows
    without a cursor value are never beyond a token that has one; beyond one without are such rows with a larger id."""
    value, doc = decode_token(token)
    if not token or plan.strategy == SNAPSHOT:
        return F.lit(True)
    if value is None:
        one = F.col(quote(id_col))
        return F.col(quote(plan.field)).isNull() & (one > F.lit(doc) if doc is not None else one.isNotNull())
    if plan.strategy == OBJECT_ID:
        return F.col(quote(id_col)) > F.lit(value)
    c = F.col(quote(plan.field))
    at = F.lit(value) if plan.kind == "string" else F.lit(value).cast("timestamp_ntz")
    return (c > at) | ((c == at) & (F.col(quote(id_col)) > F.lit(doc))) if doc is not None else c > at


def without_cursor(docs: DataFrame, plan: CursorPlan) -> DataFrame:
    """Documents that an incremental read would miss."""
    return docs.filter(F.col(quote(plan.field)).isNull()) if plan.strategy == TIMESTAMP else docs.limit(0)


def next_page(docs: DataFrame, plan: CursorPlan, token: str | None, size: int = BATCH, id_col: str = "_id") -> DataFrame:
    """The next rows in cursor order; documents without a cursor value come after all others only, to a token without one."""
    order = [F.col(quote(plan.field)).asc_nulls_last(), quote(id_col)] if plan.strategy == TIMESTAMP else [quote(id_col)]
    return docs.filter(after(plan, token, id_col)).orderBy(*order).limit(size)


def waiting(docs: DataFrame, plan: CursorPlan, dated: str | None, undated: str | None, id_col: str = "_id") -> DataFrame:
    """What is beyond two tokens, with a column ``_undated``: documents with a cursor value beyond the one, and those without
    beyond the other, which are passed by id. Both parts are predicates that reach the scan."""
    if plan.strategy != TIMESTAMP:
        return docs.filter(after(plan, dated, id_col)).withColumn("_undated", F.lit(False))
    none = F.col(quote(plan.field)).isNull()
    return docs.filter((~none & after(plan, dated, id_col)) | (none & after(plan, undated, id_col))).withColumn("_undated", none)


# Batches


def numbered(docs: DataFrame, order: list[str], size: int = BATCH, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``docs`` with batch_no from 1 in the given total order, without a window over all rows: rows are range
    partitioned and sorted once, and a partition's offset is the number of rows in those before it.

    The sorted rows are stored by ``keep`` (default: below the shared folder) with their places. Evaluated twice, a range
    partitioning has other bounds and other merged partitions each time, and offsets wouldn't fit the places.
    """
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    ordered = keep(placed) if keep else written(placed, "numbered")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    offsets = sizes.select("_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_m") - F.col("_first")
    return ordered.join(F.broadcast(offsets), "_p").withColumn("batch_no", (F.floor(place / size) + 1).cast("long")).drop("_p", "_m", "_n", "_first", "_before")


def batch_count(rows: int, size: int = BATCH) -> int:
    return max(1, -(-rows // size))


def fingerprints(docs: DataFrame, plan: CursorPlan, batch: list[str], id_col: str = "_id", resume: bool = False) -> DataFrame:
    """Per batch: row_count, min_cursor and max_cursor (tokens of the first and last row), checksum.

    The checksum covers id, cursor and content of each row, in the order of cursor and id as text. Only row hashes are
    gathered, a batch is bounded by its size. With ``resume`` there is one more token, of the last row in the order of cursor
    and id itself, which reads go by: as text 9 comes after 10, and a read from there would find rows of the batch again.
    """
    doc = F.col(quote(id_col)).cast("string")
    cursor = [F.col(quote(plan.field))] if plan.strategy == TIMESTAMP else []
    content = F.to_json(F.struct(*[quote(c) for c in sorted(docs.columns) if c not in batch]))
    part = F.md5(F.concat_ws("|", doc, *[c.cast("string") for c in cursor], content))
    last = F.struct(*[c.alias("c") for c in cursor], F.col(quote(id_col)).alias("i"))
    rows = docs.select(*batch, F.struct(*[c.alias("c") for c in cursor], doc.alias("i"), part.alias("h")).alias("r"), token_column(plan, id_col).alias("t"), last.alias("last"))
    ordered = rows.groupBy(*batch).agg(
        F.array_sort(F.collect_list("r")).alias("r"), F.min_by("t", "r").alias("min_cursor"), F.max_by("t", "r").alias("max_cursor"), *([F.max_by("t", "last").alias("resume")] if resume else [])
    )
    return ordered.select(
        *batch, F.size("r").cast("long").alias("row_count"), "min_cursor", "max_cursor", *(["resume"] if resume else []), list_hash(F.transform("r", lambda x: x["h"])).alias("checksum")
    )


def snapshot_fingerprint(docs: DataFrame, id_col: str = "_id") -> DataFrame:
    """row_count, max_cursor and checksum of a source that is taken whole, if it has rows; the checksum is of its rows in no
    order, from sums that tasks take."""
    text = F.to_json(F.struct(*[quote(c) for c in sorted(docs.columns)]))
    last = F.max(F.col(quote(id_col)).cast("string")) if id_col in docs.columns else F.lit(None).cast("string")
    sums = docs.select("*", F.xxhash64(text).alias("_a"), F.xxhash64(text, F.lit(1)).alias("_b")).agg(
        F.count(F.lit(1)).alias("row_count"), last.alias("max_cursor"), F.sum(F.col("_a").cast("decimal(38,0)")).alias("_a"), F.sum(F.col("_b").cast("decimal(38,0)")).alias("_b")
    )
    whole = F.md5(F.concat_ws("|", "row_count", "_a", "_b"))
    return sums.filter("row_count > 0").select("row_count", "max_cursor", whole.alias("checksum"))
