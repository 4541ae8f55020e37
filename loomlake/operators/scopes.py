"""Which part of the work a run is about: scopes of tables, batches of a bronze table, optional filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.columns import field_of
from loomlake.functions.names import quote

#: How much of (database, collection) a scope fixes; any other scope takes all tables.
FIXES = {"database": 1, "collection": 2, "bronze_table": 2, "table": 2, "bronze_file": 2, "file": 2}
#: Texts that are a true flag.
TRUE = ("1", "true", "yes")


def table_ref(text: str | None) -> tuple[str | None, str | None]:
    """(database, collection) of ``a.b`` or ``a__b``; a name alone is a collection."""
    name = (text or "").strip()
    for mark in (".", "__"):
        first, found, rest = name.partition(mark)
        if found:
            return first.strip() or None, rest.strip() or None
    return None, name or None


def in_scope(tables: DataFrame, scope: str | None = "all_pending", database: str | None = None, collection: str | None = None, table: str | None = None) -> DataFrame:
    """The rows of ``tables`` (database, collection, ..) that a scope takes; names given apart win over those of ``table``."""
    of_table = table_ref(table)
    wanted = (database or of_table[0], collection or of_table[1])
    for column, value in zip(("database", "collection"), wanted[: FIXES.get((scope or "").strip().lower(), 0)], strict=False):
        tables = tables.filter(F.col(column) == value) if value else tables
    return tables


def batch_id(bronze: DataFrame) -> Column:
    """The raw file that a row is from, as text; empty where the table doesn't say."""
    field = field_of(bronze.schema, "_raw_file_id")
    return F.coalesce(F.col(quote(field.name)).cast("string"), F.lit("")) if field else F.lit("")


def of_batches(bronze: DataFrame, file_ids: list[str] = (), object_keys: list[str] = ()) -> DataFrame:
    """Rows of the given raw files, by id or by object key; all rows where there is nothing to go by. The lists are a
    group of batches, so they reach the scan as a filter."""
    conditions = [
        F.col(quote(field.name)).cast("string").isin(list(values))
        for name, values in (("_raw_file_id", file_ids), ("_raw_object_key", object_keys))
        for field in [field_of(bronze.schema, name)]
        if field and values
    ]
    if not conditions:
        return bronze
    return bronze.filter(conditions[0] if len(conditions) == 1 else conditions[0] | conditions[1])


def asked(df: DataFrame, columns: dict[str, str], given: dict[str, object]) -> DataFrame:
    """Rows that equal the given values. columns: public name -> column; other names, nulls and blanks filter nothing.
    For a flag, texts are read as one."""
    for name, column in columns.items():
        value = given.get(name)
        if value is None or value == "":
            continue
        if isinstance(df.schema[column].dataType, T.BooleanType):
            value = str(value).lower() in TRUE
        df = df.filter(F.col(quote(column)) == F.lit(value))
    return df
