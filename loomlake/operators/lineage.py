"""The catalogue of tables and views, and what each is made from, as edges: of tables by rule, of columns from plans."""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import clean_table_name, is_pii_column, view_name
from loomlake.operators.flatten import plan_flatten
from loomlake.operators.views import plan_view
from loomlake.storage import discard, shared_path

_EDGE = "upstream string, downstream string, relationship_type string"


def edges(spark: SparkSession, bronze: dict[tuple[str, str], T.StructType], reports: dict[str, str] | None = None) -> DataFrame:
    """(upstream, downstream, relationship_type): source to bronze to clean to child tables and safe views, and safe
    views to reports (report name -> view)."""
    rows = []
    for (database, collection), schema in bronze.items():
        clean = clean_table_name(database, collection)
        base = clean.removesuffix("_clean")
        rows += [(f"source.{database}.{collection}", f"bronze.{base}", "ingested"), (f"bronze.{base}", f"silver.{clean}", "transformed"), (f"silver.{clean}", f"view.{view_name(clean)}", "protected")]
        for child in plan_flatten(schema, clean).children.values():
            rows += [(f"silver.{clean}", f"silver.{child}", "exploded"), (f"silver.{child}", f"view.{view_name(child)}", "protected")]
    rows += [(f"view.{view}", f"report.{name}", "reported") for name, view in (reports or {}).items()]
    return spark.createDataFrame(rows, _EDGE).distinct()


def assets(graph: DataFrame) -> DataFrame:
    """(asset, asset_type, upstreams, downstreams) of everything that an edge touches."""
    down = graph.groupBy(F.col("upstream").alias("asset")).agg(F.count(F.lit(1)).alias("downstreams"))
    up = graph.groupBy(F.col("downstream").alias("asset")).agg(F.count(F.lit(1)).alias("upstreams"))
    kind = F.substring_index("asset", ".", 1)
    return up.join(down, "asset", "full_outer").select("asset", kind.alias("asset_type"), F.coalesce("upstreams", F.lit(0)).alias("upstreams"), F.coalesce("downstreams", F.lit(0)).alias("downstreams"))


# Columns


def column_edges(spark: SparkSession, made: dict[str, DataFrame], known: set[str]) -> DataFrame:
    """(upstream, upstream_column, downstream, downstream_column, derived): which columns of the relations ``known`` each
    column of the ``made`` ones is computed from, found in the analysed plans; no data are read.

    A relation is known by the name that it has in the plan (a view, or the alias of a DataFrame), whatever lies below it.
    derived is false where all ways from the one column to the other pass it on as it is. Conditions of filters and joins
    select rows and make no edges; keys of groups do where they are in the output. Columns of other relations have none.
    """
    low, rows = {k.lower(): k for k in known}, []
    for name, df in made.items():
        plan = df._jdf.queryExecution().analyzed()
        names = {k: v for k, v in low.items() if k != name.lower()}
        found = _Columns(spark.sparkContext._gateway, names)
        found.visit(plan)
        for attribute in _seq(plan.output()):
            ways: dict[tuple[str, str], bool] = {}
            for asset, column, derived in found.of.get(attribute.exprId().id(), ()):
                ways[asset, column] = ways.get((asset, column), False) or derived
            rows += [(asset, column, name, attribute.name(), derived) for (asset, column), derived in ways.items()]
    return spark.createDataFrame(rows, "upstream string, upstream_column string, downstream string, downstream_column string, derived boolean").distinct()


def column_graph(edges: DataFrame) -> DataFrame:
    """Edges of columns as edges of assets named <relation>.<column>, for assets() and reachable()."""
    at = lambda side: F.concat_ws(".", side, f"{side}_column").alias(side)
    return edges.select(at("upstream"), at("downstream"), F.when(F.col("derived"), "derived").otherwise("passed").alias("relationship_type"))


def _seq(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


class _Columns:
    """By id of an attribute of a plan: the known columns that it comes from, and whether it is derived from them."""

    def __init__(self, gateway, known: dict[str, str]):
        self.gateway, self.known, self.of = gateway, known, {}

    def visit(self, node) -> None:
        kind = node.nodeName()
        if kind == "SubqueryAlias" and (name := self.known.get(node.alias().lower())):
            for x in _seq(node.output()):
                self.of[x.exprId().id()] = {(name, x.name(), False)}
            return
        for child in [*_seq(node.children()), *_seq(node.innerChildren())] if kind != "View" else _seq(node.children()):
            self.visit(child)
        for expression in _seq(node.expressions()):
            self._named(expression)
        children = [_seq(c.output()) for c in _seq(node.children())]
        for i, x in enumerate(_seq(node.output())):
            here = x.exprId().id()
            if kind in ("Union", "Intersect", "Except"):  # the output is by place, and may have the first child's ids
                self.of[here] = set().union(*(self.of.get(c[i].exprId().id(), set()) for c in (children if kind != "Except" else children[:1])))
            elif here not in self.of and children:  # generators, expansions, and what else makes columns of its own
                self.of[here] = self._from(node)

    def _named(self, expression) -> None:
        """Notes the aliases in an expression, and visits the plans of its subqueries."""
        below = _seq(expression.children())
        for child in below:
            self._named(child)
        if is_instance_of(self.gateway, expression, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            self.visit(expression.plan())
        if expression.nodeName() == "Alias":
            same = below[0].nodeName() == "AttributeReference"
            self.of[expression.exprId().id()] = {(a, c, d or not same) for a, c, d in self._from(expression)}

    def _from(self, tree) -> set[tuple[str, str, bool]]:
        """All that the references of an expression (or node), and the results of its subqueries, come from; derived."""
        out = {(a, c, True if tree.nodeName() != "Alias" else d) for x in _seq(tree.references().toSeq()) for a, c, d in self.of.get(x.exprId().id(), ())}
        return out | (self._subqueries(tree) if tree.nodeName() == "Alias" else set())

    def _subqueries(self, expression) -> set[tuple[str, str, bool]]:
        out = set()
        if is_instance_of(self.gateway, expression, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            out = {(a, c, True) for x in _seq(expression.plan().output()) for a, c, _ in self.of.get(x.exprId().id(), ())}
        return out.union(*(self._subqueries(c) for c in _seq(expression.children())))


def reachable(graph: DataFrame, start: str, down: bool = True) -> DataFrame:
    """(asset, distance) of all that follows from ``start`` (or that it follows from), itself included, however far.

    Ways are doubled: each round joins what is found with ways of up to twice the length, so rounds grow with the logarithm
    of the distance. Each round is written to the shared folder; only the last one's result stays. Cycles are fine.
    """
    spark = graph.sparkSession
    a, b = ("upstream", "downstream") if down else ("downstream", "upstream")
    scratch, n = shared_path(spark, "lineage"), 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal n
        n += 1
        df.write.parquet(f"{scratch}/{n}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{n}")

    try:
        ways = kept(graph.filter(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}").select(F.col(a).alias("asset"), F.col(b).alias("to"), F.lit(1).alias("far")).distinct())
        found, size = kept(spark.createDataFrame([(start, 0)], "asset string, distance int")), 1
        while True:
            step = found.join(ways, "asset").select(F.col("to").alias("asset"), (F.col("distance") + F.col("far")).alias("distance"))
            found = kept(found.union(step).groupBy("asset").agg(F.min("distance").alias("distance")))
            before, size = size, found.count()
            if size == before:
                break
            onward = ways.toDF("from", "asset", "first").join(ways, "asset").filter(F.col("from") != F.col("to")).select(F.col("from").alias("asset"), "to", (F.col("first") + F.col("far")).alias("far"))
            ways = kept(ways.union(onward).groupBy("asset", "to").agg(F.min("far").alias("far")))
        result = shared_path(spark, "reachable")
        found.write.parquet(result)
        return spark.read.schema(found.schema).parquet(result)
    finally:
        discard(spark, scratch)


def tags(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    """(asset, column, tag): pii, hashed or json of the columns of clean tables."""
    rows = []
    for table, columns in tables.items():
        plan = plan_view(columns)
        rows += [(f"silver.{table}", c, "pii") for c in columns if is_pii_column(c)]
        rows += [(f"view.{view_name(table)}", c, "hashed") for c in plan.hashed] + [(f"silver.{table}", c, "json") for c in plan.blocked]
    return spark.createDataFrame(rows, "asset string, column string, tag string")
