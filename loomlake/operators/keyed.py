"""Tables in versions, laid out by a hash of their keys, so that a merge reads and writes only what a delivery touches.

A row lies in the bucket of its key: <path>/data/_write=<id>/_bucket=<n>. A version is a small JSON file that names the
folder of each bucket, with the schema, the number of rows and the metrics of the write. It appears under its number or
not at all, and no number is given twice: of two writers that saw the same version one is refused. Where the other
changed none of its buckets it takes over the new version's folders for the rest, else it merges again.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import quote
from loomlake.operators.merge import merge_distinct
from loomlake.storage import discard

#: Buckets of a new table. About a bucket for each 256 MB is right: ``resize`` deals the rows anew.
BUCKETS = 16
#: Versions that are kept, and how often a refused writer tries again.
KEEP, TRIES = 10, 8
#: Parts of a bucket that a merge may sort in tasks of their own.
SHARES = 8
_WRITE, _BUCKET, _SHARE = "_write", "_bucket", "_share"


class Refused(RuntimeError):
    """Another writer has given the number to a version of its own."""


@dataclass
class Version:
    number: int
    keys: list[str]
    buckets: int
    schema: dict
    parts: dict[str, str]
    """bucket -> the write that holds it."""
    rows: int
    written: float
    metrics: dict[str, int] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The same for a key whatever its type is in a delivery."""
    return F.pmod(F.xxhash64(*[F.col(quote(k)).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class KeyedTable:
    """A table below ``path``. Without keys (``write`` alone) it has one bucket and is replaced whole."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.path, self.buckets, self.keep = spark, path.rstrip("/"), buckets, keep
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # Versions

    def _fs(self, path: str):
        p = self._hadoop.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def numbers(self) -> list[int]:
        """The numbers of the versions that are there, ascending."""
        fs, p = self._fs(f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def exists(self) -> bool:
        """Without a Spark job."""
        return bool(self.numbers())

    def version(self, number: int | None = None) -> Version | None:
        """The version of that number, or the newest; None if there is none."""
        for _ in range(TRIES):
            n = number or max(self.numbers(), default=0)
            if not n:
                return None
            fs, p = self._fs(f"{self.path}/versions/{n:020d}.json")
            if fs.exists(p):  # else it went while the list was read
                stream = fs.open(p)
                try:
                    return Version(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
                finally:
                    stream.close()
            if number:
                return None
        return None

    def _commit(self, new: Version) -> None:
        """Puts the version in place if its number is free."""
        draft = f"{self.path}/versions/.{uuid.uuid4().hex}"
        fs, p = self._fs(draft)
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(asdict(new)), "utf-8"))
        out.close()
        gateway = self.spark.sparkContext._gateway
        plain = gateway.new_array(getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)  # without overwriting
        target = self._hadoop.Path(f"{self.path}/versions/{new.number:020d}.json")
        context = self._hadoop.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(p, target, plain)
        except Py4JJavaError as e:
            fs.delete(p, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Refused(f"version {new.number} of {self.path} is another writer's") from None
            raise
        self._expire()

    def _expire(self) -> None:
        """Drops versions beyond the last ``keep``, and the folders that only they name."""
        numbers = self.numbers()
        old = numbers[: -self.keep] if self.keep else []
        if not old:
            return
        named = lambda ns: {(w, b) for n in ns if (v := self.version(n)) for b, w in v.parts.items()}
        gone = named(old) - named(numbers[-self.keep :])
        for n in old:
            discard(self.spark, f"{self.path}/versions/{n:020d}.json")
        for write, bucket in gone:
            discard(self.spark, self._folder(write, bucket))

    def vacuum(self, hours: float = 168) -> int:
        """Drops folders that no version names and that are older than ``hours``: what writers left that died. Their number."""
        live = {(w, b) for n in self.numbers() if (v := self.version(n)) for b, w in v.parts.items()}
        fs, p = self._fs(f"{self.path}/data/*/{_BUCKET}=*")
        before, n = (time.time() - hours * 3600) * 1000, 0
        for s in fs.globStatus(p) or []:
            write, bucket = (x.partition("=")[2] for x in str(s.getPath()).rsplit("/", 2)[1:])
            if (write, bucket) not in live and s.getModificationTime() <= before:
                fs.delete(s.getPath(), True)
                n += 1
        return n

    def history(self) -> DataFrame:
        """(number, written, rows, inserted, updated, kept, changed, buckets_written) of the versions that are there."""
        rows = []
        for n in self.numbers():
            if v := self.version(n):
                m = v.metrics
                rows.append((v.number, v.written, v.rows, *[m.get(k) for k in ("inserted", "updated", "kept", "changed", "buckets_written")]))
        return self.spark.createDataFrame(rows, "number long, written double, rows long, inserted long, updated long, kept long, changed long, buckets_written long")

    # Rows

    def _rows(self, v: Version, buckets: set[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets: only their folders are listed."""
        paths = [self._folder(w, b) for b, w in v.parts.items() if buckets is None or b in buckets]
        schema = v.struct()
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.path}/data").schema(schema).parquet(*paths).select(*[F.col(quote(c)) for c in schema.names])

    def read(self, number: int | None = None) -> DataFrame:
        v = self.version(number)
        if v is None:
            raise ValueError(f"no such version of {self.path}")
        return self._rows(v)

    def rows(self) -> int:
        """Rows of the newest version, from its record."""
        v = self.version()
        return v.rows if v else 0

    def write(self, df: DataFrame, keys: list[str] | None = None) -> None:
        """Replaces all rows. With keys rows are dealt to buckets, those with a null key too."""
        for _ in range(TRIES):
            old = self.version()
            buckets = (old.buckets if old and old.keys == keys else self.buckets) if keys else 1
            write, seen = self._written(df.withColumn("_action", F.lit("insert")), keys or [], buckets)
            metrics = {"inserted": seen["inserted"], "updated": 0, "kept": 0, "changed": seen["inserted"], "buckets_written": len(seen["buckets"])}
            new = Version(_after(old), keys or [], buckets, df.schema.jsonValue(), _parts(seen["buckets"], write), seen["inserted"], time.time(), metrics)
            if self._tried(new):
                return
            discard(self.spark, self._folder(write))
        raise Refused(f"{self.path}: refused {TRIES} times")

    def resize(self, buckets: int) -> bool:
        """Deals the rows to another number of buckets; false if another writer came between."""
        old, self.buckets = self.version(), buckets
        if old is None or not old.keys:
            return False
        write, seen = self._written(self._rows(old).withColumn("_action", F.lit("keep")), old.keys, buckets)
        metrics = {"inserted": 0, "updated": 0, "kept": old.rows, "changed": 0, "buckets_written": len(seen["buckets"])}
        done = self._tried(Version(_after(old), old.keys, buckets, old.schema, _parts(seen["buckets"], write), old.rows, time.time(), metrics))
        if not done:
            discard(self.spark, self._folder(write))
        return done

    def upsert(self, source: DataFrame, keys: list[str], hash_col: str | None, order: list[Column] | None = None) -> dict[str, int]:
        """Merges ``source`` as merge() does and gives inserted, updated, kept, changed and total.

        Only the buckets of the delivery's keys are read, and only those with a change stay written: the cost is that of the
        delivery and its buckets. A delivery that changes nothing, or has no row with a key, makes no version. A column
        whose type changes has all buckets written again.
        """
        for _ in range(TRIES):
            old = self.version()
            if old and old.keys != keys:
                raise ValueError(f"{self.path} is laid out by {old.keys}, not by {keys}")
            metrics = self._merged(source, keys, hash_col, order, old)
            if metrics is not None:
                return metrics
        raise Refused(f"{self.path}: refused {TRIES} times")

    def _merged(self, source: DataFrame, keys: list[str], hash_col: str | None, order: list[Column] | None, old: Version | None) -> dict[str, int] | None:
        """One try; None if another writer changed what this one read."""
        buckets, before = (old.buckets, old.rows) if old else (self.buckets, 0)
        nothing = {"inserted": 0, "updated": 0, "kept": before, "changed": 0, "total": before}
        known = F.lit(True)
        for k in keys:
            known = known & F.col(quote(k)).isNotNull()
        # as many as there are buckets; a new table has none to read
        touched = {str(r[0]) for r in source.filter(known).select(bucket_of(keys, buckets)).distinct().collect()} if old else set()
        if old and not touched:
            return nothing
        there = old.struct() if old else source.schema
        share = F.pmod(F.xxhash64(F.lit("share"), *[F.col(quote(k)).cast("string") for k in keys]), F.lit(SHARES)).cast("int")
        parts = {_BUCKET: bucket_of(keys, buckets), _SHARE: share}
        with_rows_of = lambda some: merge_distinct(self._rows(old, some) if old else self.spark.createDataFrame([], there), source, keys, hash_col, None, parts, order)
        merged = with_rows_of(touched)
        schema = _nullable(T.StructType([f for f in merged.schema.fields if f.name not in ("_action", *parts)]))
        there = _nullable(there)
        retyped = old is not None and any(schema[f.name].dataType != f.dataType for f in there.fields)
        if retyped:
            touched |= set(old.parts)
            merged = with_rows_of(None)
        write, seen = self._written(merged.drop(_SHARE), keys, buckets)
        if not seen["buckets"]:
            discard(self.spark, self._folder(write))
            return nothing
        if old and not {str(b) for b in seen["buckets"]} <= touched:  # the source gave other keys when it was read again
            discard(self.spark, self._folder(write))
            return None
        changed = seen["inserted"] + seen["updated"]
        fresh = {str(b) for b in (seen["buckets"] if retyped and changed else seen["changed"])}
        if not fresh:
            discard(self.spark, self._folder(write))
        for same in {str(b) for b in seen["buckets"]} - fresh if fresh else ():
            discard(self.spark, self._folder(write, same))
        base = old
        for _ in range(TRIES):
            total = (base.rows if base else 0) + seen["inserted"]
            counts = {"inserted": seen["inserted"], "updated": seen["updated"], "kept": total - changed, "changed": changed}
            kept = {b: w for b, w in (base.parts if base else {}).items() if b not in fresh}
            new = Version(_after(base), keys, buckets, schema.jsonValue(), kept | _parts(fresh, write), total, time.time(), counts | {"buckets_written": len(fresh)})
            if not fresh or self._tried(new):
                return counts | {"total": total}
            newer = self.version()
            alike = newer and old and newer.buckets == buckets and _nullable(newer.struct()) == there == schema
            if not alike or any(newer.parts.get(b) != old.parts.get(b) for b in touched):
                break  # what was read is no longer so
            base = newer
        discard(self.spark, self._folder(write))
        return None

    def _written(self, df: DataFrame, keys: list[str], buckets: int) -> tuple[str, dict]:
        """Writes rows (with _action; with their bucket, if they are dealt already) by bucket and counts them in the same job, behind its last shuffle: a task that runs
        again counts once. Gives the write and inserted, updated, and the buckets with rows and with changes."""
        write, seen = uuid.uuid4().hex, Observation()
        if _BUCKET in df.columns:
            dealt = df
        else:
            dealt = df.withColumn(_BUCKET, bucket_of(keys, buckets)).repartition(_BUCKET) if keys else df.withColumn(_BUCKET, F.lit(0))
        is_ = lambda x: F.count_if(F.col("_action") == x)
        changed = F.collect_set(F.when(F.col("_action") != "keep", F.col(_BUCKET)))
        counted = dealt.observe(seen, is_("insert").alias("inserted"), is_("update").alias("updated"), changed.alias("changed"), F.collect_set(_BUCKET).alias("buckets"))
        counted.drop("_action").write.partitionBy(_BUCKET).option("compression", "zstd").parquet(self._folder(write))
        return write, seen.get

    def _tried(self, new: Version) -> bool:
        try:
            self._commit(new)
        except Refused:
            return False
        return True

    def _folder(self, write: str, bucket: str | None = None) -> str:
        return f"{self.path}/data/{_WRITE}={write}" + (f"/{_BUCKET}={bucket}" if bucket is not None else "")


def _after(old: Version | None) -> int:
    return old.number + 1 if old else 1


def _parts(buckets, write: str) -> dict[str, str]:
    return {str(b): write for b in buckets}


def _nullable(schema: T.StructType) -> T.StructType:
    """As files give it back."""
    text = json.dumps(schema.jsonValue())
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}": false', f'"{flag}": true')
    return T.StructType.fromJson(json.loads(text))
