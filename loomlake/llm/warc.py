"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged archives.

Each record is a gzip member of its own. The reader checks every member (gzip check sum, record framing, block
digest). After a failed check it looks for the next gzip member or version line that starts a valid record, goes
on there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.files import read_files, write_file
from loomlake.llm.shared import as_long, as_text, scratch, with_group

#: Equal payloads of fewer bytes are stored again.
MIN_REVISIT = 100
#: A header of a plain record ends within so many bytes; in a gzip member it may be of any length.
MAX_HEADER = 16 << 20
#: An archive file is ended after the record by which it has so many bytes.
ROLL = 128 << 20
_STEP = 1 << 16
# Fixed values of the format.
_VERSION, _DATE, _GZIP = b"WARC/1.1\r\n", "2000-01-01T00:00:00Z", b"\x1f\x8b\x08"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE = b"WARC/1."
_FIELD = re.compile(r"[!#-'*+.^-`|~\w-]+:|[ \t]", re.A)
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


class Record(NamedTuple):
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    """Bytes without a record. ``inside``: where they lie in what the gzip member at ``offset`` inflates to, if only they
    are lost of it."""

    offset: int
    length: int
    inside: tuple[int, int] | None = None


def encode_record(headers: dict[str, object], block: bytes) -> bytes:
    """One record as a gzip member; header values are made fit for a line."""
    lines = {**headers, "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(), "Content-Length": len(block)}
    text = "".join(f"{k}: {re.sub(r'[\x00-\x1f\x7f]+', lambda m: '%' + '%'.join(f'{ord(c):02X}' for c in m[0]), str(v))}\r\n" for k, v in lines.items())
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(_VERSION + text.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _count(value: str | None) -> int | None:
    """A count of bytes as headers state it, in ASCII digits; None for anything else."""
    return int(value) if re.fullmatch(r"[0-9]{1,18}", value or "") else None


def _plain(data, at: int, longest: int | None = None) -> tuple[dict[str, str], bytes, int] | None:
    """The record at ``at``, and where it ends; None unless all of it is right."""
    end = data.find(b"\r\n\r\n", at, len(data) if longest is None else at + longest)
    if end < 0 or not data.startswith(_LINE, at):
        return None
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = _count(headers.get("content-length"))
    if size is None or not all(_FIELD.match(x) for x in lines):
        return None
    first, last = end + 4, end + 4 + size
    block = data[first:last]
    if data[last : last + 4] != b"\r\n\r\n":
        return None
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        return None
    return headers, block, last + 4


def _member(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What the gzip member at ``at`` holds and where it ends; None for the end if it is damaged or cut off."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    try:
        while pos < len(data) and not unpack.eof:
            out.append(unpack.decompress(data[pos : pos + _STEP]))
            pos += _STEP
    except zlib.error:
        return b"".join(out), None
    return b"".join(out), min(pos, len(data)) - len(unpack.unused_data) if unpack.eof else None


def _inflated(inner: bytes) -> Iterator[tuple[dict[str, str], bytes] | tuple[int, int]]:
    """The valid records (headers, block) of inflated bytes, and the ranges (start, length) between them."""
    at, lost = 0, None
    while at < len(inner):
        if one := _plain(inner, at):
            if lost is not None:
                yield lost, at - lost
                lost = None
            yield one[:2]
            at = one[2]
            continue
        lost = at if lost is None else lost
        at = inner.find(_LINE, at + 1)
        at = len(inner) if at < 0 else at
    if lost is not None:
        yield lost, len(inner) - lost


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """The valid records of an archive in order, and the byte ranges between them that hold none.

    Plain and gzipped records may be mixed, and a member may hold many. A record's offset and length are those of its
    member or plain text. What a member inflates to is searched for version lines after a failed record too; in a damaged
    member as far as it inflates (its records have length 0, the member is a gap), and beyond for the next member.
    """
    pos, lost = 0, None
    while pos < len(data):
        found, end = [], None
        if data.startswith(_GZIP, pos):
            inner, end = _member(data, pos)
            found = list(_inflated(inner))
            if not any(isinstance(x[0], dict) for x in found) and inner:  # a member without a record is a gap
                end = None
        elif one := _plain(data, pos, MAX_HEADER):
            found, end = [one[:2]], one[2]
        if end is not None:
            if lost is not None:
                yield Gap(lost, pos - lost)
                lost = None
            for x in found:
                yield Record(pos, end - pos, *x) if isinstance(x[0], dict) else Gap(pos, end - pos, x)
            pos = end
            continue
        lost = pos if lost is None else lost
        yield from (Record(pos, 0, *x) for x in found if isinstance(x[0], dict))
        after = _START.search(data, pos + 1)
        pos = after.start() if after else len(data)
    if lost is not None:
        yield Gap(lost, pos - lost)


def rolled(members: Iterator[bytes], limit: int) -> Iterator[Iterator[bytes]]:
    """Runs of members; each ends with the member by which it has ``limit`` bytes, and is read before the next is asked for."""
    for first in members:

        def run(first: bytes = first) -> Iterator[bytes]:
            size = len(first)
            yield first
            while size < limit and (one := next(members, None)) is not None:
                size += len(one)
                yield one

        yield run()


def write_archives(pages: DataFrame, path: str, roll: int = ROLL) -> DataFrame:
    """Writes a record per row of (page_id, url, html) below ``path``; returns (file, n_records, n_bytes) when run.
    A task writes a file for each ``roll`` bytes, none without rows.

    A null html is an empty payload. Of equal payloads of at least MIN_REVISIT bytes the one with the smallest
    page_id is a response and the others revisit it; rows that repeat its page_id too are responses, as are all
    where every page_id is null. A null id is written as ``null``.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    values = {"_first": (F.min("page_id"), F.min("_first")), "_n": (F.count(F.lit(1)), F.sum("_n"))}
    marked = with_group(rows, ["digest"], ["page_id", "url"], values, F.col("_n") > 1)
    again = (F.col("_n") > 1) & (F.octet_length("html") >= MIN_REVISIT) & F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id"))
    marked = marked.select("page_id", "url", "html", "digest", F.when(again, F.col("_first")).alias("first"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0

        def members() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                for page, url, html, digest, first in batch.itertuples(index=False):
                    payload, n = html.encode(), n + 1
                    name = lambda x: "null" if x is None else x
                    headers = {
                        "WARC-Type": "response" if first is None else "revisit",
                        "WARC-Record-ID": f"<urn:page:{name(page)}>",
                        "WARC-Date": _DATE,
                        "WARC-Target-URI": url or "",
                        "Content-Type": "application/http; msgtype=response",
                        "WARC-Payload-Digest": f"sha256:{digest}",
                        "X-Payload-Length": len(payload),
                    }
                    if first is None:
                        yield encode_record(headers, _HTTP + payload)
                    else:
                        yield encode_record(headers | {"WARC-Profile": _REVISIT, "WARC-Refers-To": f"<urn:page:{name(first)}>"}, _HTTP)

        rows, before = [], 0
        for k, run in enumerate(rolled(members(), roll)):
            file = f"{path}/part-{TaskContext.get().partitionId():06d}-{k:05d}.warc.gz"
            size = write_file(file, run)
            rows.append((file, n - before, size))
            before = n
        yield pd.DataFrame(rows, columns=["file", "n_records", "n_bytes"])

    return as_text(marked, "page_id", "first").mapInPandas(write, "file string, n_records long, n_bytes long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per salvaged record or gap of the archives below ``path``.

    (file, offset, length, kind: record or gap, page_id, url, record_type, payload_bytes, payload_digest, refers_to,
    payload, inner_offset, inner_length). The last two say where in an inflated member a gap lies that isn't all of it. A record whose payload does not have the SHA-256 it
    states is reported as a gap; where none is stated, or another kind, it is computed. Archives without
    records give only gaps, empty ones nothing. An archive is read by one task, in memory: foreign files must be below 2 GB.
    A page id or a stated length that isn't a number in range is null.
    """

    def number(urn: str | None) -> str | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", urn or "")
        return found[1] if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None

    def row(file: str, x: Record | Gap) -> tuple:
        gap = (file, x.offset, x.length, "gap", None, None, None, None, None, None, None)
        if isinstance(x, Gap):
            return *gap, *(x.inside or (None, None))
        h = x.headers
        kind, page = h.get("warc-type"), number(h.get("warc-record-id"))
        algorithm, _, digest = h.get("warc-payload-digest", "").partition(":")
        http = x.block.startswith(b"HTTP/")
        body = x.block.partition(b"\r\n\r\n")[2] if http else x.block
        if kind != "revisit":
            own = hashlib.sha256(body).hexdigest()
            if algorithm == "sha256" and own != digest:
                return *gap, None, None
            digest = own
            return file, x.offset, x.length, "record", page, h.get("warc-target-uri"), kind, len(body), digest, None, body, None, None
        digest = digest if algorithm == "sha256" else None
        return file, x.offset, x.length, "record", page, h.get("warc-target-uri"), kind, _count(h.get("x-payload-length")), digest, number(h.get("warc-refers-to")), None, None, None

    schema = (
        "file string, offset long, length long, kind string, page_id string, url string, record_type string, "
        "payload_bytes long, payload_digest string, refers_to string, payload binary, inner_offset long, inner_length long"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"], strict=True):
                rows, held = [], 0
                for x in salvage(data):
                    rows.append(row(file, x))
                    held += x.length
                    if held > 1 << 22 or len(rows) > 2000:
                        yield _frame(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return as_long(read_files(spark, path, "*.warc*").mapInPandas(read, schema), "page_id", "refers_to")


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("offset", "length", "payload_bytes", "inner_offset", "inner_length")})


def op3_warc(spark, sf_dir):
    path = scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path).agg(F.sum("n_records")).collect()
    records = read_archives(spark, path).filter("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, octet_length(b) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
"""
