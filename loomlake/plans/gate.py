"""Read-only SQL over safe views: Spark's own parser says what a text would do, and a walk over its unresolved plan
decides whether it may. Nothing is decided by patterns over the text."""

from __future__ import annotations

import hashlib
import re
import threading
import time
import uuid
from dataclasses import dataclass

from py4j.java_gateway import is_instance_of
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LENGTH, MAX_JOINS, MAX_RELATIONS, MAX_ROWS = 8000, 5, 6, 100
MAX_SECONDS, MAX_BYTES, SLOW_MS = 30, 512 << 20, 3000
#: Logical plan nodes of a read-only query; any other node (commands, DDL, table functions, literal tables, paths) is refused.
ALLOWED_NODES = {
    "Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Limit", "Offset", "Distinct", "Join", "LateralJoin", "SubqueryAlias",
    "UnresolvedRelation", "UnresolvedWith", "CTERelationDef", "CTERelationRef", "Union", "Intersect", "Except", "UnresolvedHaving", "WithWindowDefinition",
    "UnresolvedSubqueryColumnAliases", "Window", "Generate", "UnresolvedOrderBy", "Pivot", "Unpivot", "UnpivotTranspose", "Deduplicate", "ResolvedHint", "UnresolvedHint",
}
#: Roles: which names each may read.
ROLES = {"bi": (r"report_.*", r".*_analytics"), "analyst": (r".*_analytics", r"report_.*"), "admin": (r".*",)}
#: Functions that reach outside the query: files, the JVM, the network, the session.
UNSAFE_FUNCTIONS = {"java_method", "reflect", "try_reflect", "input_file_name", "read_files", "current_database", "version", "raise_error"}


class Refused(ValueError):
    """The query may not run."""


@dataclass(frozen=True)
class Checked:
    """starts: where the names of relations begin in the text."""

    sql: str
    relations: tuple[str, ...]
    joins: int
    starts: tuple[int, ...] = ()


def _children(node) -> list:
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _nodes(plan, gateway):
    """All nodes of a plan, and of the plans inside its expressions and its WITH clauses."""
    yield plan
    if plan.nodeName().endswith("UnresolvedWith"):
        relations = plan.cteRelations()
        for i in range(relations.size()):
            yield from _nodes(relations.apply(i)._2(), gateway)
    for child in _children(plan):
        yield from _nodes(child, gateway)
    expressions = plan.expressions()
    for i in range(expressions.size()):
        yield from _subplans(expressions.apply(i), gateway)


def _subplans(expression, gateway):
    if is_instance_of(gateway, expression, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
        yield from _nodes(expression.plan(), gateway)
    for child in _children(expression):
        yield from _subplans(child, gateway)


def _functions(plan):
    """Names of the functions called anywhere in one node's expressions."""
    def visit(expression):
        if expression.getClass().getSimpleName() == "UnresolvedFunction":
            parts = expression.nameParts()
            yield parts.apply(parts.size() - 1).lower()
        for child in _children(expression):
            yield from visit(child)

    expressions = plan.expressions()
    for i in range(expressions.size()):
        yield from visit(expressions.apply(i))


def _cte_names(plan) -> set[str]:
    relations = plan.cteRelations()
    return {relations.apply(i)._1().lower() for i in range(relations.size())}


def check_sql(spark: SparkSession, sql: str, allowed: set[str], role: str = "admin") -> Checked:
    """Raises Refused unless ``sql`` is one query over the allowed views only.

    CTEs, subqueries, comma joins, set operations, literals and extract(.. from ..) are fine. Commands, DDL, DML,
    table functions, literal tables, files as tables, and base tables are not, wherever they stand.
    """
    if not sql or not sql.strip():
        raise Refused("SQL is required")
    if len(sql) > MAX_LENGTH:
        raise Refused(f"SQL is longer than {MAX_LENGTH} characters")
    text = sql.strip().removesuffix(";").strip()
    conf = spark.conf
    before = conf.get("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:  # the parser's exception comes through py4j
        raise Refused(f"not a single valid statement: {str(e).strip().splitlines()[0][:200]}") from (None if isinstance(e, ParseException) else e)
    finally:
        conf.set("spark.sql.ansi.doubleQuotedIdentifiers", before)
    relations, joins, ctes, starts = [], 0, set(), []
    for node in _nodes(plan, spark.sparkContext._gateway):
        name = node.nodeName()
        if name.lstrip("'") not in ALLOWED_NODES:
            raise Refused(f"not allowed in a read-only query: {name.lstrip(chr(39))}")
        bad = UNSAFE_FUNCTIONS.intersection(_functions(node))
        if bad:
            raise Refused(f"function not allowed: {min(bad)}")
        joins += name.lstrip("'") in ("Join", "LateralJoin")
        if name.lstrip("'") == "UnresolvedWith":
            ctes |= _cte_names(node)
        if name.lstrip("'") == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            relations.append(".".join(parts.apply(i) for i in range(parts.size())))
            start = node.origin().startIndex()
            if start.isDefined():
                starts.append(start.get())
    read = [r for r in relations if r.lower() not in ctes]
    if not read:
        raise Refused("the query must read a safe view")
    if joins > MAX_JOINS:
        raise Refused(f"{joins} joins; at most {MAX_JOINS}")
    if len(read) > MAX_RELATIONS:
        raise Refused(f"{len(read)} relations; at most {MAX_RELATIONS}")
    names = {a.lower() for a in allowed}
    for r in read:
        short = re.sub(r"^(delta\.)?silver\.", "", r.lower())
        if "." in short or short not in names or not any(re.fullmatch(p, short) for p in ROLES[role]):
            raise Refused(f"not a safe view: {r}")
    return Checked(text, tuple(sorted({re.sub(r"^(delta\.)?silver\.", "", r.lower()) for r in read})), joins, tuple(sorted(set(starts))))


def gated(spark: SparkSession, sql: str, allowed: set[str], role: str = "admin", limit: int = MAX_ROWS, max_bytes: int | None = MAX_BYTES) -> DataFrame:
    """The query's rows, at most ``limit`` whatever limits stand in the text; refused too if its scan is estimated
    above ``max_bytes`` (None: a job over whole tables, of any size). Analysed, not run."""
    checked = check_sql(spark, sql, allowed, role)
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        df = spark.sql(_short_names(checked))
    finally:
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", before)
    if max_bytes is not None and (size := scan_bytes(df)) > max_bytes:
        raise Refused(f"the query would scan about {size} bytes; at most {max_bytes}")
    return df.limit(max(1, min(limit, MAX_ROWS)))


def _short_names(checked: Checked) -> str:
    """The text with the names of relations, and nothing else, without the schema that views are in."""
    text = checked.sql
    for start in reversed(checked.starts):
        schema = re.compile(r"""(["`]?delta["`]?\s*\.\s*)?["`]?silver["`]?\s*\.\s*""", re.I).match(text, start)
        text = text[:start] + text[schema.end() :] if schema else text
    return text


def scan_bytes(df: DataFrame) -> int:
    """The estimated bytes that the leaves of the plan read: of files only the share of the columns that are read, by the
    usual widths of their types."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return sum(_leaf_bytes(leaves.apply(i)) for i in range(leaves.size()))


def _leaf_bytes(leaf) -> int:
    if leaf.getClass().getSimpleName() == "FileSourceScanExec":
        relation = leaf.relation()
        whole = max(1, relation.dataSchema().defaultSize())
        return int(relation.location().sizeInBytes()) * min(whole, leaf.requiredSchema().defaultSize()) // whole
    link = leaf.logicalLink()
    return int(str(link.get().stats().sizeInBytes())) if link.isDefined() else 0


def fingerprint(sql: str) -> str:
    """Equal for texts that differ in case, white space and comments."""
    plain = re.sub(r"/\*.*?\*/|--[^\n]*", " ", sql, flags=re.S)
    return hashlib.sha256(re.sub(r"\s+", " ", plain).strip().lower().encode()).hexdigest()[:24]


@dataclass
class History:
    """Queries that were asked for, as rows to be appended to a table."""

    rows: list[tuple]
    SCHEMA = "query_id string, sql_fingerprint string, relations array<string>, status string, error string, duration_ms long, row_count long, is_slow boolean"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.SCHEMA)


def run(spark: SparkSession, sql: str, allowed: set[str], history: History, role: str = "admin", seconds: float = MAX_SECONDS) -> list:
    """Rows of a gated query. It is cancelled after ``seconds``; every outcome is kept: ok, failed, cancelled, blocked."""
    query_id, began, relations = uuid.uuid4().hex, time.monotonic(), ()
    late = threading.Event()

    def note(status: str, error: str | None = None, n: int | None = None) -> None:
        ms = int((time.monotonic() - began) * 1000)
        history.rows.append((query_id, fingerprint(sql), list(relations), status, error, ms, n, ms >= SLOW_MS))

    try:
        relations = check_sql(spark, sql, allowed, role).relations
        df = gated(spark, sql, allowed, role)
    except Refused as e:
        note("blocked", str(e)[:500])
        raise
    except Exception as e:  # analysis: unknown columns, wrong types
        note("failed", str(e)[:500])
        raise
    spark.sparkContext.setJobGroup(query_id, "read-only query", True)

    def stop() -> None:
        late.set()
        cancel(spark, query_id)

    timer = threading.Timer(seconds, stop)
    timer.start()
    try:
        rows = df.collect()
    except Exception as e:  # a failed or cancelled job: noted, then raised again
        note("cancelled" if late.is_set() else "failed", str(e)[:500])
        raise
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    note("ok", None, len(rows))
    return rows


def cancel(spark: SparkSession, query_id: str) -> None:
    spark.sparkContext.cancelJobGroup(query_id)


def most_queried(history: DataFrame, n: int = 10) -> DataFrame:
    """(view_name, queries) of the views that are read most."""
    views = history.filter("status = 'ok'").select(F.explode("relations").alias("view_name"))
    return views.groupBy("view_name").agg(F.count(F.lit(1)).alias("queries")).orderBy(F.desc("queries"), "view_name").limit(n)
