"""The loop from a source into raw files: one pass for all pages, documents without a cursor, runs that are taken up again."""

import datetime

import pytest
from pyspark.sql import functions as F

from loomlake.operators import loops
from loomlake.sources import cursors, documents
from loomlake.storage import shared_path

PLAN = cursors.CursorPlan(cursors.TIMESTAMP, "at")
SCHEMA = "_id long, at timestamp_ntz, v string"


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def day(d):
    return None if d is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=d)


def docs(spark, rows):
    return spark.createDataFrame([(i, day(d), f"v{i}") for i, d in rows], SCHEMA)


def read(spark, df, root, size=2, **more):
    return loops.collect(spark, df, PLAN, root, "d", "c", "r", at(), size, **more)


def raw(spark, root):
    got = spark.read.option("basePath", f"{root}/raw/d/c").schema("_id long, batch int").json(f"{root}/raw/d/c").collect()
    out = {}
    for r in got:
        out.setdefault(r["batch"], []).append(r["_id"])
    return {b: sorted(v) for b, v in sorted(out.items())}


@pytest.mark.parametrize("ahead", [None, 1, 2])
def test_more_documents_without_cursor_than_a_page_holds(spark, ahead):
    root = shared_path(spark, "lake")
    first = docs(spark, [(1, 5), (2, 3), (3, None), (4, None), (5, None), (6, None), (7, None), (8, 3), (9, 4)])
    got = read(spark, first, root, ahead=ahead)
    want = {1: [2, 8], 2: [1, 9], 3: [3, 4], 4: [5, 6], 5: [7]}
    if ahead is None:
        assert raw(spark, root) == want
    assert sorted(x for v in raw(spark, root).values() for x in v) == list(range(1, 10)) and got.rows == 9 and got.status == "success"
    assert read(spark, first, root, ahead=ahead).rows == 0
    more = first.union(docs(spark, [(10, 5), (11, 9), (12, None), (0, 1)]))
    assert read(spark, more, root, ahead=ahead).rows == 3
    assert sorted(x for v in raw(spark, root).values() for x in v) == list(range(1, 13))


def test_ids_that_are_null_end_too(spark):
    root = shared_path(spark, "lake")
    rows = spark.createDataFrame([(None, None, "a"), (None, None, "b"), (None, None, "c"), (4, None, "d")], SCHEMA)
    asked = iter(["run"] * 6 + ["cancel"])
    assert read(spark, rows, root, ahead=1, control=lambda: next(asked)).status == "success"


def test_one_scan_and_as_many_jobs_for_any_number_of_pages(spark):
    seen, sc = spark.sparkContext.accumulator(0), spark.sparkContext

    def passing(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    jobs = []
    for n in (4, 1200):
        root = shared_path(spark, "lake")
        source = docs(spark, [(i, i // 3 if i % 4 else None) for i in range(n)]).mapInPandas(passing, SCHEMA)
        before = seen.value
        sc.setJobGroup(root, "collect")
        got = read(spark, source, root)
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert got.rows == n and got.batches == -(-(n * 3 // 4) // 2) - (-(n // 4) // 2) and seen.value - before == n
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(root)))
    assert jobs[1] <= jobs[0] + 6, jobs  # folders beyond a few are listed by a job


def test_repeated_pages_are_skipped_and_no_scratch_stays(spark, monkeypatch):
    scratch = []
    monkeypatch.setattr(loops, "shared_path", lambda *a: scratch.append(shared_path(*a)) or scratch[-1])
    root = shared_path(spark, "lake")
    snapshot = cursors.CursorPlan(cursors.SNAPSHOT, None, "snapshot")
    once = docs(spark, [(1, 1), (2, None)])
    take = lambda df: loops.collect(spark, df, snapshot, root, "d", "c", "r", at())
    assert [(g.batches, g.skipped) for g in (take(once), take(once.orderBy(F.desc("_id"))), take(once.limit(1)), take(once.limit(0)))] == [(1, 0), (0, 1), (1, 0), (0, 0)]
    assert raw(spark, root) == {1: [1, 2], 3: [1]}
    assert len(scratch) == 4 and not any(documents.exists(spark, p) for p in scratch)


def test_ids_of_more_digits_are_read_once(spark):
    """Many rows with the last cursor value, whose ids have one digit or two: as texts 9 is the last, as numbers 12 is."""
    root = shared_path(spark, "lake")
    rows = docs(spark, [(i, 1) for i in range(1, 13)] + [(i, None) for i in range(95, 106)])
    assert read(spark, rows, root, size=6).rows == 23
    assert read(spark, rows, root, size=6).rows == 0
