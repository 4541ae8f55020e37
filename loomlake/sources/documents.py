"""Document files: compressed JSON lines with an envelope, partitioned by date and hour; reading them back, checking
them, and finding the tables below a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import quote, safe_identifier
from loomlake.operators.profile import schema_paths

ENVELOPE = ("__source_id", "__source_name", "__source_db", "__source_collection", "__extracted_at")


def enveloped(docs: DataFrame, source_id: str, source_name: str, database: str, collection: str, at: Column) -> DataFrame:
    values = (F.lit(source_id), F.lit(source_name), F.lit(database), F.lit(collection), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
    return docs.select("*", *[v.alias(n) for n, v in zip(ENVELOPE, values, strict=True)])


def serialised(docs: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text per document: times in ISO form, binary as text, decimals as numbers. Columns ``beside`` stay columns."""
    cols = []
    for f in docs.schema.fields:
        if f.name in beside:
            continue
        c = F.col(quote(f.name))
        cols.append((c.cast("string") if isinstance(f.dataType, T.BinaryType) else c.cast("double") if isinstance(f.dataType, T.DecimalType) else c).alias(f.name))
    return docs.select(*beside, F.to_json(F.struct(*cols), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("value"))


def raw_path(root: str, database: str, collection: str) -> str:
    return f"{root.rstrip('/')}/{safe_identifier(database)}/{safe_identifier(collection)}"


def write_raw(docs: DataFrame, path: str, at: Column, mode: str = "append") -> None:
    """Adds gzipped JSON lines below dt=YYYY-MM-DD/hr=HH (or replaces all that is below ``path``, with another mode)."""
    rows = serialised(docs).withColumns({"dt": F.date_format(at, "yyyy-MM-dd"), "hr": F.date_format(at, "HH")})
    rows.write.mode(mode).partitionBy("dt", "hr").option("compression", "gzip").text(path)


def write_raw_batches(docs: DataFrame, path: str, at: Column, batch: str = "batch") -> None:
    """Adds documents below batch=<n>/dt=YYYY-MM-DD/hr=HH by their column ``batch``; what a batch held before is replaced."""
    rows = serialised(docs, (batch,)).withColumns({"dt": F.date_format(at, "yyyy-MM-dd"), "hr": F.date_format(at, "HH")})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch, "dt", "hr").option("compression", "gzip").text(path)


def read_raw(spark: SparkSession, path: str, schema: T.StructType | str | None = None, strict: bool = True) -> DataFrame:
    """Documents with dt and hr. strict: a line that isn't JSON fails the read; else it is in _corrupt."""
    reader = spark.read.option("mode", "FAILFAST") if strict else spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def verify_raw(spark: SparkSession, path: str) -> DataFrame:
    """Per file: lines, and lines that aren't a JSON object."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("v").isNull()).alias("bad_lines"))


def reusable(spark: SparkSession, path: str, row_count: int) -> bool:
    """Whether a written batch can be used again: it is there, whole, and every line parses."""
    if not exists(spark, path):
        return False
    got = verify_raw(spark, path).agg(F.sum("row_count").alias("n"), F.sum("bad_lines").alias("bad")).head()
    return got["n"] == row_count and not got["bad"]


def reconcile_files(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """(file, status): ok, missing, orphan or row_count_differs, from expected and actual (file, row_count)."""
    e, a = metadata.select("file", F.col("row_count").alias("_e")), files.select("file", F.col("row_count").alias("_a"))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "orphan").when(F.col("_a") != F.col("_e"), "row_count_differs").otherwise("ok")
    return e.join(a, "file", "full_outer").select("file", status.alias("status"))


# Folders


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return list(found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    """Without a Spark job."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def discover_tables(spark: SparkSession, root: str) -> DataFrame:
    """(database, collection, path) of the tables at root/<database>/<collection>."""
    rows = [(str(p).rsplit("/", 2)[1], str(p).rsplit("/", 2)[2], str(p)) for s in _glob(spark, f"{root.rstrip('/')}/*/*") if s.isDirectory() for p in [s.getPath()]]
    return spark.createDataFrame([r for r in rows if not r[1].startswith(("_", "."))], "database string, collection string, path string")


def merged_discovery(metadata: DataFrame, physical: DataFrame) -> DataFrame:
    """Registered and physical tables; what is registered counts, origin tells where a table was found."""
    m, p = metadata.select("database", "collection", F.col("path").alias("_m")), physical.select("database", "collection", F.col("path").alias("_p"))
    origin = F.when(F.col("_m").isNull(), "files").when(F.col("_p").isNull(), "metadata").otherwise("metadata+files")
    return m.join(p, ["database", "collection"], "full_outer").select("database", "collection", F.coalesce("_m", "_p").alias("path"), origin.alias("origin"))


def folder_stats(spark: SparkSession, root: str) -> DataFrame:
    """Per table: objects, data files and bytes below it; the listing is Spark's own, distributed beyond a few folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    rest = F.substring_index("path", root.rstrip("/").split(":")[-1].replace("//", ""), -1)
    parts = F.split(F.ltrim(rest, F.lit("/")), "/")
    return files.select(parts[0].alias("database"), parts[1].alias("collection"), F.col("path").rlike(r"\.(parquet|gz|json|txt)$").alias("data"), "length").groupBy("database", "collection").agg(
        F.count(F.lit(1)).alias("objects"), F.count_if("data").alias("data_files"), F.sum("length").alias("bytes")
    )


def active_collections(inventory: DataFrame) -> DataFrame:
    """(source_id, collection): sources with a JSON list of names or of objects with a name, one row for each."""
    v = F.try_variant_get(F.try_parse_json("active_collections_json"), "$", "array<variant>")
    item = inventory.select("source_id", F.explode(v).alias("i"))
    name = F.coalesce(F.try_variant_get("i", "$.name", "string"), F.try_variant_get("i", "$", "string"))
    return item.select("source_id", name.alias("collection")).filter("collection IS NOT NULL AND NOT startswith(collection, 'system.')")


def observed_paths(lines: DataFrame) -> set[str]:
    """Dotted paths of all fields in JSON lines (column value); [] marks a step into an array. The schemas of the
    lines are merged by an aggregate, so only one schema reaches the driver."""
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).head()["s"]
    return schema_paths(T._parse_datatype_string(f"root {found.replace('OBJECT<', 'STRUCT<')}").fields[0].dataType) if found else set()
