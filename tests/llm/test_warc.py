"""WARC: round trip, what is stored once, salvage after damage."""

import hashlib
import random
import zlib

from loomlake.llm import warc
from loomlake.llm.files import read_files
from loomlake.llm.shared import scratch


def records(n=12, plain=()):
    out = []
    for i in range(n):
        raw = warc.encode_record({"WARC-Type": "resource", "WARC-Record-ID": f"<urn:page:{i}>"}, f"record {i} ".encode() * (9 + i))
        out.append(zlib.decompress(raw, 31) if i in plain else raw)
    return out


def found(data):
    rows = list(warc.salvage(data))
    ids = [int(r.headers["warc-record-id"].split(":")[-1].rstrip(">")) for r in rows if isinstance(r, warc.Record)]
    return ids, [(g.offset, g.length) for g in rows if isinstance(g, warc.Gap)]


def test_whole_archives():
    for plain in ((), range(12), (0, 3, 11)):
        parts = records(plain=plain)
        assert found(b"".join(parts)) == (list(range(12)), [])
        offsets = [r.offset for r in warc.salvage(b"".join(parts))]
        assert offsets == [sum(map(len, parts[:i])) for i in range(12)]
    assert found(b"") == ([], [])
    assert found(b"nothing here") == ([], [(0, 12)])


def test_salvage_skips_only_what_is_damaged():
    rng = random.Random(4)
    for trial in range(60):
        parts = records(plain=set(rng.sample(range(12), 4)))
        k = rng.randrange(12)
        start = sum(map(len, parts[:k]))
        data = bytearray(b"".join(parts))
        if trial % 3 == 0:  # bytes lost
            at = start + len(parts[k]) - rng.randrange(8, 60)  # the header of a plain record has no check sum
            del data[at : at + 2]
            size = len(parts[k]) - 2
        elif trial % 3 == 1:  # a byte changed in the content or its check sum
            data[start + len(parts[k]) - 7] ^= 0x55
            size = len(parts[k])
        else:  # foreign bytes between
            data[start:start] = b"\x1f\x8b\x08junk WARC/1.1\r\n"
            size = 18
        ids, gaps = found(bytes(data))
        want = [i for i in range(12) if i != k or trial % 3 == 2]
        assert [i for i in ids if i in want] == want, (trial, k, ids)
        assert all(start <= o <= start + size + 2 for o, _ in gaps), (trial, start, size, gaps)
        assert gaps or k in ids


def test_cut_off_archive():
    parts = records()
    data = b"".join(parts)[:-20]
    ids, gaps = found(data)
    assert ids == list(range(11)) and gaps == [(sum(map(len, parts[:11])), len(parts[11]) - 20)]


def test_round_trip(spark):
    long, short = "é" * 60, "tiny"
    pages = [(5, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (9, None, long), (1, "u", short), (3, "u", short), (4, "u", None), (6, "u", ""), (None, "u", "no id " * 30), (7, "u", "z" * 3_000_000), (2, "u", long)]
    df = spark.createDataFrame([(p, u, h, 1, "x") for p, u, h in pages], "page_id long, url string, html string, digest int, first string")
    path = scratch(spark, "warc")
    assert warc.write_archives(df, path).agg({"n_records": "sum"}).head()[0] == len(pages)
    rows = warc.read_archives(spark, path).collect()
    assert all(r["kind"] == "record" for r in rows)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    want = []
    for p, _, h in pages:
        b = (h or "").encode()
        again = h == long and p != 2
        want.append((str(p), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    whole = {r["page_id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert whole[7] == b"z" * 3_000_000 and whole[4] == b"" and whole[2] == long.encode()
    nothing = scratch(spark, "warc")
    assert warc.write_archives(df.filter("page_id < 0"), nothing).count() == 0


def test_archives_are_rolled_and_long_urls_kept(spark):
    pages = [(i, "data:" + "x" * (300_000 if i == 3 else 5), f"{i} " * 500) for i in range(40)]
    path = scratch(spark, "warc")
    files = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2), path, 2000).collect()
    assert len(files) > 4 and sum(r["n_records"] for r in files) == 40
    rows = warc.read_archives(spark, path).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(40)) and {r["kind"] for r in rows} == {"record"}
    assert max(len(r["url"]) for r in rows) == 300_005


def test_bad_headers_are_gaps_not_crashes(spark, tmp_path):
    good = records(2)
    record = lambda lines: b"WARC/1.1\r\n" + lines.encode() + b"\r\n\r\nabc\r\n\r\n"
    bad = [record(f"Content-Length: {x}") for x in ("\u00b2", "3x", "-3", "9" * 30, "")]
    odd = [
        warc.encode_record({"WARC-Type": "revisit", "WARC-Record-ID": "<urn:page:7>", "X-Payload-Length": "many", "WARC-Refers-To": f"<urn:page:{10**30}>"}, b""),
        warc.encode_record({"WARC-Type": "resource", "WARC-Record-ID": f"<urn:page:{2**63}>"}, b"x"),
    ]
    (tmp_path / "a.warc").write_bytes(good[0] + b"".join(bad) + odd[0] + odd[1] + good[1])
    rows = warc.read_archives(spark, f"file://{tmp_path}").collect()
    kept = [(r["page_id"], r["payload_bytes"], r["refers_to"]) for r in rows if r["kind"] == "record"]
    assert [k[0] for k in kept] == [0, 7, None, 1] and kept[1] == (7, None, None)
    gaps = [(r["offset"], r["length"]) for r in rows if r["kind"] == "gap"]
    assert gaps == [(len(good[0]), sum(map(len, bad)))]


def test_damaged_files_report_gaps(spark, tmp_path):
    parts = records()
    data = bytearray(b"".join(parts))
    at = sum(map(len, parts[:4]))
    data[at + len(parts[4]) - 6] ^= 1
    (tmp_path / "a.warc.gz").write_bytes(bytes(data))
    (tmp_path / "b.warc.gz").write_bytes(b"")
    rows = warc.read_archives(spark, f"file://{tmp_path}").collect()
    gaps = [(r["offset"], r["length"]) for r in rows if r["kind"] == "gap" and r["length"] == len(parts[4])]
    assert gaps == [(at, len(parts[4]))]
    assert read_files(spark, f"file://{tmp_path}", "*.warc*").count() == 1  # Spark leaves empty files out


def test_salvage_inside_members():
    parts = [zlib.decompress(x, 31) for x in records(6)]
    whole = b"".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    pack = lambda b: (z := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(b) + z.flush()
    assert found(pack(whole)) == (list(range(6)), [])
    for bad in ({1}, {0}, {5}, {2, 3}, {0, 4}):
        inner = bytearray(whole)
        for k in bad:
            inner[starts[k + 1] - 10] ^= 0x20
        data = pack(whole) + pack(bytes(inner)) + parts[0]
        rows = list(warc.salvage(data))
        ids = [int(r.headers["warc-record-id"].split(":")[-1].rstrip(">")) for r in rows if isinstance(r, warc.Record)]
        assert ids == [*range(6), *[k for k in range(6) if k not in bad], 0]
        gaps = [r for r in rows if isinstance(r, warc.Gap)]
        assert {(g.offset, g.length) for g in gaps} == {(len(pack(whole)), len(pack(bytes(inner))))}
        assert sum(g.inside[1] for g in gaps) == sum(len(parts[k]) for k in bad)
    cut = pack(b"".join(bytes(random.Random(k).randbytes(0)) + p for k, p in enumerate(parts)))[:-9]
    ids, gaps = found(cut + parts[3])
    assert ids[-1] == 3 and gaps == [(0, len(cut))]
    assert found(pack(b"no record") + parts[2])[0] == [2]


def test_ids_beyond_doubles(spark):
    big, text = (1 << 53) + 1, "payload " * 30
    pages = [(big, "u", text), (big + 2, "u", text), (None, "u", "other " * 40), (-big, "u", "x"), ((1 << 63) - 1, "u", text)]
    path = scratch(spark, "warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), path).collect()
    got = {(r["page_id"], r["refers_to"]) for r in warc.read_archives(spark, path).collect()}
    assert got == {(big, None), (big + 2, big), (None, None), (-big, None), ((1 << 63) - 1, big)}
