"""Upserts without a transactional table format: a hash-gated merge as one full outer join.

Used for clean tables (see keyed.py for how they are kept), and with resolvers for state tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlake.functions.names import quote


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, the same each time if the order is total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def merge(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str | None, order: list[Column] | None = None, resolve: dict[str, callable] | None = None) -> DataFrame:
    """The merged table with a column ``_action``: insert, update or keep.

    Source rows with a null key are left out, of several rows of a key the first by ``order`` counts (default: by hash).
    A matched row is updated if either hash is null or they differ; without hash_col always. resolve: column ->
    function of (old, new) for columns that aren't just replaced. Columns of either side are kept, missing values null.
    """
    return merge_distinct(target, distinct_source(source, keys, hash_col, order), keys, hash_col, resolve)


def distinct_source(source: DataFrame, keys: list[str], hash_col: str | None, order: list[Column] | None = None) -> DataFrame:
    """One row of each key, none without one."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(quote(k)).isNotNull()
    return latest(source.filter(known), keys, order or [F.col(hash_col).asc_nulls_last() if hash_col else F.xxhash64(*[F.col(quote(c)) for c in source.columns])])


def merge_distinct(
    target: DataFrame, source: DataFrame, keys: list[str], hash_col: str | None, resolve: dict[str, callable] | None = None,
    parts: dict[str, Column] | None = None, order: list[Column] | None = None,
) -> DataFrame:
    """merge() of a source that has each key once; with ``parts`` of any source, by one shuffle (see merge_by_parts)."""
    if parts:
        return merge_by_parts(target, source, keys, hash_col, parts, order)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"t.{quote(k)}") == F.col(f"s.{quote(k)}"))
    joined = t.join(s, match, "full_outer")
    fresh = F.col("t._in_target").isNull()
    matched = F.col("s._in_source").isNotNull()
    differs = F.lit(True)
    if hash_col and hash_col in target.columns:
        differs = F.col(f"t.{quote(hash_col)}").isNull() | F.col(f"s.{quote(hash_col)}").isNull() | (F.col(f"t.{quote(hash_col)}") != F.col(f"s.{quote(hash_col)}"))
    action = F.when(fresh, "insert").when(matched & differs, "update").otherwise("keep")
    out = []
    for c in [*target.columns, *[c for c in source.columns if c not in target.columns]]:
        old = F.col(f"t.{quote(c)}") if c in target.columns else F.lit(None)
        new = F.col(f"s.{quote(c)}") if c in source.columns else old
        mixed = resolve[c](old, new) if resolve and c in resolve and c in target.columns and c in source.columns else new
        out.append(F.when(fresh, new).when(action == "update", mixed).otherwise(old).alias(c))
    return joined.select(*out, action.alias("_action"))


def merge_by_parts(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str | None, parts: dict[str, Column], order: list[Column] | None = None) -> DataFrame:
    """merge() by one shuffle of both sides instead of one for the choice in the source, one for the join and one for what
    follows: rows are dealt by ``parts`` (columns that keys decide, kept in the result), and a key's rows meet in their sort."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(quote(k)).isNotNull()
    sides = [df.withColumns(parts | {"_new": F.lit(new)}) for df, new in ((target, False), (source.filter(known), True))]
    rows = sides[0].unionByName(sides[1], allowMissingColumns=True).repartition(*parts)
    chosen = order or [F.col(quote(hash_col)).asc_nulls_last() if hash_col else F.xxhash64(*[F.col(quote(c)) for c in source.columns])]
    key = Window.partitionBy(*parts, *[F.col(quote(k)) for k in keys]).orderBy("_new", *chosen)
    names = [*target.columns, *[c for c in source.columns if c not in target.columns]]
    gone = [c for c in target.columns if c not in source.columns]  # an update leaves them as they were
    hashed = hash_col and hash_col in target.columns
    beside = {"_before": F.lag("_new").over(key), "_after": F.lead("_new").over(key)} | {f"_old_{i}": F.lag(quote(c)).over(key) for i, c in enumerate(gone)}
    if hashed:
        beside |= {"_hash_before": F.lag(quote(hash_col)).over(key), "_hash_after": F.lead(quote(hash_col)).over(key)}
    rows = rows.withColumns(beside)

    def differs(other: str) -> Column:
        return ~F.coalesce(F.col(quote(hash_col)) == F.col(other), F.lit(False)) if hashed else F.lit(True)

    insert, update = F.col("_new") & F.col("_before").isNull(), F.col("_new") & ~F.col("_before") & differs("_hash_before")
    keep = ~F.col("_new") & ~(F.coalesce("_after", F.lit(False)) & differs("_hash_after"))
    action = F.when(insert, "insert").when(update, "update").when(keep, "keep")
    old = {c: F.when(F.col("_action") == "update", F.col(f"_old_{i}")).otherwise(F.col(quote(c))).alias(c) for i, c in enumerate(gone)}
    return rows.withColumn("_action", action).filter("_action IS NOT NULL").select(*[old.get(c, F.col(quote(c))) for c in names], *parts, "_action")


def merge_metrics(merged: DataFrame) -> DataFrame:
    """inserted, updated, kept, changed, total."""
    is_ = lambda x: F.count_if(F.col("_action") == x)
    return merged.agg(is_("insert").alias("inserted"), is_("update").alias("updated"), is_("keep").alias("kept"),
                      (is_("insert") + is_("update")).alias("changed"), F.count(F.lit(1)).alias("total"))


def keep_old(old: Column, new: Column) -> Column:
    return F.coalesce(old, new)


def keep_new(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def greatest(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def add(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``source`` whose keys the target lacks, one per key."""
    return source.dropDuplicates(keys).join(target.select(*keys).distinct(), keys, "left_anti")


def replace_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``source``, and those of the target for other keys."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source, allowMissingColumns=True)
