"""Column expressions: tolerant lookup, normalisation, hashing, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import quote

# Name rules of the type normaliser.
TIME_SUFFIXES, TIME_NAMES = ("_at", "_datetime", "_timestamp"), {"createdat", "updatedat", "created_at", "updated_at"}
MONEY_MARKERS = ("amount", "price", "total", "balance", "cost", "fee")
FLAG_PREFIXES, FLAG_SUFFIXES = ("is_", "has_", "can_", "should_"), ("_flag", "_enabled", "_active")
CODE_MARKERS, ENUM_SUFFIXES = ("country_code", "currency_code", "currency"), ("status", "type", "category", "mode")
CHECKED_COUNTRIES = {"AE": "United Arab Emirates", "US": "United States", "SA": "Saudi Arabia"}


# Lookup: names regardless of case, null of the wanted type where there is none


def field_of(schema: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in schema.fields if f.name == name), None) or next((f for f in schema.fields if f.name.lower() == name.lower()), None)


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    field = field_of(df.schema, name)
    return F.expr(f"try_cast({quote(field.name)} AS {kind})") if field else F.lit(None).cast(kind)


def at_path(df: DataFrame, path: str, kind: str = "string") -> Column:
    """A dotted path through structs; null if any step is missing or isn't a struct."""
    where: T.DataType = df.schema
    steps = []
    for step in path.split("."):
        field = field_of(where, step) if isinstance(where, T.StructType) else None
        if field is None:
            return F.lit(None).cast(kind)
        steps.append(quote(field.name))
        where = field.dataType
    return F.expr(f"try_cast({'.'.join(steps)} AS {kind})")


def array_csv(df: DataFrame, path: str) -> Column:
    """The elements of an array joined by commas; a scalar as text."""
    where: T.DataType = df.schema
    steps = []
    for step in path.split("."):
        field = field_of(where, step) if isinstance(where, T.StructType) else None
        if field is None:
            return F.lit(None).cast("string")
        steps.append(quote(field.name))
        where = field.dataType
    col = F.col(".".join(steps))
    return F.array_join(col.cast("array<string>"), ",") if isinstance(where, T.ArrayType) else col.cast("string")


# Normalisation


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def enum_text(c: Column) -> Column:
    return F.lower(F.regexp_replace(trimmed(c), r"[\s-]+", "_"))


def upper_code(c: Column) -> Column:
    return F.upper(trimmed(c))


def country_name(c: Column) -> Column:
    code = upper_code(c)
    named = F.lit(None).cast("string")
    for key, value in reversed(CHECKED_COUNTRIES.items()):
        named = F.when(code == key, value).otherwise(named)
    return F.coalesce(named, code)


def normalised(c: Column, kind: T.DataType, path: str) -> Column:
    """A scalar by what its type and its path (parts joined by _) say; the first rule that applies counts. A value that
    doesn't fit the wanted type becomes null."""
    p = path.lower()
    text = c.cast("string")
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(kind, T.BinaryType):
        return text
    if p.endswith(TIME_SUFFIXES) or p in TIME_NAMES:
        return c.cast("timestamp") if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType) else F.try_to_timestamp(text)
    if p.endswith("date"):
        return text.try_cast("date") if not isinstance(kind, T.TimestampType | T.TimestampNTZType) else c.cast("date")
    if any(m in p for m in MONEY_MARKERS):
        return c.try_cast("decimal(18,2)") if not isinstance(kind, T.BooleanType | T.DateType | T.TimestampType) else text.try_cast("decimal(18,2)")
    if p.startswith(FLAG_PREFIXES) or p.endswith(FLAG_SUFFIXES):
        return text.try_cast("boolean")
    if any(m in p for m in CODE_MARKERS):
        return upper_code(c)
    if p.endswith(ENUM_SUFFIXES):
        return enum_text(c)
    return trimmed(c) if isinstance(kind, T.StringType) else c


# Hashes


def stable_hash(*cols: Column) -> Column:
    """SHA-256 of the values as text, joined by ||, null as empty."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def pii_hash(c: Column, salt: str) -> Column:
    """Salted SHA-256, equal for equal values so that hashed columns still join; null for null and blank values."""
    text = c.cast("string")
    return F.when(F.trim(text) != "", F.sha2(F.concat(F.lit(f"{salt}|"), text), 256))


def record_hash(df: DataFrame, leave_out: tuple[str, ...] = ()) -> Column:
    """SHA-256 of the row as JSON, without the columns left out; column order doesn't matter."""
    return F.sha2(F.to_json(F.struct(*[F.col(quote(c)) for c in sorted(df.columns) if c not in leave_out])), 256)


def list_hash(values: Column) -> Column:
    """The first 12 hex digits of the MD5 of a list of texts in order."""
    return F.substring(F.md5(F.array_join(values, "|")), 1, 12)


# Dates and progress


def tolerant_timestamp(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("timestamp"), F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def seconds_between(first: Column, last: Column) -> Column:
    return F.unix_timestamp(last) - F.unix_timestamp(first)


def freshness(last: Column, now: Column, delayed_minutes: Column, stale_minutes: Column) -> Column:
    """fresh, delayed, stale or never_ingested, by the age of the last value."""
    age = seconds_between(last, now) / 60
    return F.when(last.isNull(), "never_ingested").when(age > stale_minutes, "stale").when(age > delayed_minutes, "delayed").otherwise("fresh")


def percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.round(done / total * 100, 2)))).otherwise(F.lit(0.0))


def remaining_seconds(elapsed: Column, pct: Column) -> Column:
    return F.when((pct > 0) & (pct < 100), elapsed * (100 - pct) / pct)


# Masking


def masked(c: Column) -> Column:
    """Credentials in URIs and key=value secrets as ***."""
    uri = F.regexp_replace(c, r"://[^/@\s:]+:[^/@\s]+@", "://***:***@")
    return F.regexp_replace(uri, r"(?i)\b(password|passwd|secret|token|api_key|access_key)\s*[=:]\s*[^\s,;&]+", "$1=***")
