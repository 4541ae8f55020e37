"""The catalog: what tables and columns there are, which databases are new, tables over folders, views that answer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import literal, quote

# Databases that are never sources.
SYSTEM_DATABASES = ("admin", "config", "local")
DEMO_PREFIXES = ("demo", "sample_")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(name, kind, is_view) of tables and views without those of the system."""
    found = [(t.name, t.tableType, t.tableType in ("VIEW", "TEMPORARY")) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(found, "name string, kind string, is_view boolean").filter("NOT startswith(name, 'system.')")


def list_columns(spark: SparkSession, schemas: dict[str, T.StructType], tables: Iterable[str] | None = None) -> DataFrame:
    """(table_name, column_name, data_type, ordinal) of the wanted tables, in order of table and place."""
    wanted = set(schemas if tables is None else tables)
    rows = [(t, f.name, f.dataType.simpleString(), i) for t, s in schemas.items() if t in wanted for i, f in enumerate(s.fields, 1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int").orderBy("table_name", "ordinal")


def discovered(names: DataFrame, sources: DataFrame, requested: Iterable[str] | None = None) -> DataFrame:
    """Sources (name, is_active) after a look at the databases (name): new ones come in as inactive, those that are
    known stay as they are; system and demo databases, and those not asked for, are left out. origin: inserted or known."""
    low = F.lower("name")
    fit = ~low.isin(*SYSTEM_DATABASES)
    for p in DEMO_PREFIXES:
        fit = fit & ~low.startswith(p)
    if requested is not None:
        fit = fit & F.col("name").isin(*requested)
    fresh = names.filter(fit).select("name").distinct().join(sources, "name", "left_anti")
    known = sources.select("name", "is_active", F.lit("known").alias("origin"))
    return known.unionByName(fresh.select("name", F.lit(False).alias("is_active"), F.lit("inserted").alias("origin")))


def register_table(spark: SparkSession, name: str, path: str, source: str = "parquet") -> bool:
    """An external table over a folder; true if it is new. One that is there over another folder is replaced (its files
    stay), over the same it is left alone."""
    known = spark.catalog.tableExists(name)
    if known:
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote(name)}").collect()}
        if _plain(about.get("Location", "")) == _plain(path):
            return False
        spark.sql(f"DROP TABLE {quote(name)}")
    spark.sql(f"CREATE TABLE {quote(name)} USING {source} LOCATION {literal(path)}")
    return not known


def _plain(path: str) -> str:
    """A path without its scheme's spelling: s3 and s3a name the same store."""
    scheme, found, rest = path.partition(":")
    return (scheme.replace("s3a", "s3") + ":" if found and scheme != "file" else "") + "/" + (rest if found else path).strip("/")


def live_views(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(view_name, live): whether a view still answers a query for one row."""
    rows = []
    for name in names:
        try:
            spark.table(quote(name)).limit(1).collect()
            rows.append((name, True))
        except AnalysisException:  # the view, or what it reads, is gone or has changed
            rows.append((name, False))
    return spark.createDataFrame(rows, "view_name string, live boolean")


def data_size(c: Column) -> Column:
    """A number of bytes as a literal of whole GB, MB, KB or B, at least 1; also of decimals, for numbers beyond a long."""
    out = F.concat(F.greatest(F.lit(1), c).cast("string"), F.lit("B"))
    for power, unit in ((10, "KB"), (20, "MB"), (30, "GB")):
        size = F.greatest(F.lit(1), F.bround(c.cast("double") / (1 << power)).cast("decimal(38,0)"))
        out = F.when(c >= 1 << power, F.concat(size.cast("string"), F.lit(unit))).otherwise(out)
    return out
