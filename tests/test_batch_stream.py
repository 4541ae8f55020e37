"""States of batches on a stream: any order of arrival, time-outs, and the batch operators as the measure."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomlake.operators import state
from loomlake.streaming import batches

START = datetime.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(key, before)


def ms(minute):
    return int((START + datetime.timedelta(minutes=minute) - datetime.datetime(1970, 1, 1)).total_seconds() * 1000)


@pytest.mark.parametrize(("events", "now", "want"), [
    ([], 0, ("queued", None, 0, False)),
    ([(0, "running", None), (5, "success", 7)], 100, ("success", 7, 0, False)),
    ([(5, "success", 7), (0, "running", None)], 100, ("success", 7, 0, False)),
    ([(0, "success", 7)], 100, ("queued", None, 0, False)),
    ([(0, "running", 3)], 30, ("running", 3, 0, False)),
    ([(0, "running", 3)], 31, ("failed", 3, 0, True)),
    ([(0, "running", 3), (31, "success", 9)], 31, ("failed", 3, 0, True)),
    ([(0, "running", 3), (31, "retrying", None), (40, "success", 9)], 99, ("success", 9, 1, False)),
    ([(0, "running", None), (1, "failed", None), (2, "retrying", None), (3, "failed", 1), (4, "retrying", None)], 34, ("retrying", 1, 2, False)),
])
def test_fold(events, now, want):
    assert batches.fold([(ms(m), i, s, r) for i, (m, s, r) in enumerate(events)], ms(now))[:4] == want


def test_stream_equals_the_fold_in_any_order(rocks, tmp_path):
    spark, rng = rocks, random.Random(4)
    events = []
    for b in range(25):
        at = rng.randrange(20)
        for k in range(rng.randrange(1, 7)):
            events.append((f"b{b}", START + datetime.timedelta(minutes=at), k, rng.choice(["running", "running", "success", "failed", "retrying"]), rng.choice([None, k])))
            at += rng.choice([1, 5, 29, 31, 60])
    rng.shuffle(events)
    events += events[:10]
    schema = "batch_id string, at timestamp, seq long, status string, rows long, seen timestamp"
    said = f"file://{tmp_path}/said"
    for n in range(4):  # the last delivery is a sign of life that moves the clock
        rows = [(*e, START + datetime.timedelta(days=2, minutes=n)) for e in events[n::3]] if n < 3 else [("end", START, 0, "skipped", None, START + datetime.timedelta(days=5))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = batches.batch_states(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in"), "seen", "1 day")
        put = lambda df, i: df.write.mode("append").parquet(said)
        stream.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", f"file://{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()
    got = {r["batch_id"]: tuple(r)[1:] for r in batches.latest_states(spark.read.parquet(said)).collect()}
    by = {}
    for b, at, k, s, r in set(events):
        by.setdefault(b, []).append((ms((at - START).total_seconds() / 60), k, s, r))
    now = ms(4 * 24 * 60)
    assert {b: v for b, v in got.items() if b != "end"} == {b: batches.fold(v, now)[:4] for b, v in by.items()}
    assert any(v[3] for v in got.values()) and any(v[0] == "success" for v in got.values())


def test_a_run_adds_one_state_row_whatever_its_events():
    class Kept:
        rows, timers = [], []
        getListState = lambda self, *a: self
        get = lambda self: iter(self.rows)
        appendValue = lambda self, row: self.rows.append(row)
        listTimers = lambda self: iter(())
        registerTimer = lambda self, at: self.timers.append(at)
        getCurrentWatermarkInMs = lambda self: 0

    kept, big = Kept(), 2**53 + 1
    states = batches._States(30)
    states.init(kept)
    events = pd.DataFrame({"event": [f'[{i},null,["running"],null]' for i in range(300)] + [f'[300,{big},["success"],{big}]'] * 2})
    for n in (1, 1):  # the same events again add nothing
        (said,) = states.handleInputRows(("b",), iter([events]), kept)
        assert said.iloc[0].tolist() == ["b", "success", big, 0, False, 301, 0] and len(kept.rows) == n


def test_fold_is_what_the_batch_operators_say(spark):
    old = spark.createDataFrame([(s, s, 1, 0) for s in state.TRANSITIONS], "batch_id string, status string, rows int, retry_count int")
    for wanted in ("running", "success", "failed", "skipped", "cancelled", "retrying"):
        changes = spark.createDataFrame([(s, wanted, 5) for s in state.TRANSITIONS], "batch_id string, status string, rows int")
        got = {r["batch_id"]: (r["status"], r["rows"], r["retry_count"]) for r in state.advance(old, changes).collect()}
        way = {"queued": [], "running": ["running"], "failed": ["running", "failed"], "retrying": ["running", "failed", "retrying"]}
        for s, before in way.items():
            events = [(ms(0), i, x, 1) for i, x in enumerate([*before, wanted])]
            status, rows, retries, *_ = batches.fold([(*e[:3], 5 if i == len(before) else 1) for i, e in enumerate(events)], ms(1))
            assert (status, rows or 1, retries - before.count("retrying")) == got[s], (s, wanted)
    running = spark.createDataFrame([(1, "running", START, False)], "b int, status string, started_at timestamp, retryable boolean")
    for minute in (30, 31):
        now = F.lit(START + datetime.timedelta(minutes=minute))
        r = state.interrupted(running, now).head()
        assert (r["status"], r["retryable"]) == batches.fold([(ms(0), 0, "running", None)], ms(minute))[0::3][:2]
