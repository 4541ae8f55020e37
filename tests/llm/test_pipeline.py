"""The corpus pipeline: stages one by one, and its end against the tokenizer."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from loomlake.llm import decontamination, near_dedup, token_files
from loomlake.llm.shared import stored


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, sf), name)
        out.append(docs)
    return out


def test_stages_narrow(spark, sf, steps):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    ids = set(before)
    for df in steps[:-1]:
        assert df.columns == docs.columns
        rows = df.collect()
        now = [r["doc_id"] for r in rows]
        assert len(now) == len(set(now)) and set(now) <= ids
        assert all(r == before[r["doc_id"]] for r in rows)
        ids = set(now)
    assert 0 < len(ids) < len(before)


def test_decisions_take_effect(spark, sf, steps):
    assert near_dedup.near_duplicate_classes(steps[1]).filter("class_size > 1").count() == 0
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontamination.find_leaks(steps[2], items).count() == 0
    assert decontamination.find_leaks(steps[1], items).count() > 0


def test_end_equals_the_tokenizer(sf, steps):
    t = Tokenizer.from_str(token_files.default_tokenizer()[0])
    start, want = 0, []
    for r in sorted(steps[3].collect(), key=lambda r: r["doc_id"]):
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, steps[4].select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_run_is_the_stages(spark, sf, steps):
    assert sorted(map(tuple, P.run(spark, sf).collect())) == sorted(map(tuple, steps[4].collect()))


def test_large_ids_beside_nulls(spark, sf, tmp_path):
    """Ids beyond what doubles hold, some null, go through all stages as they are."""
    shift = (1 << 53) + 1
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        moved = F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") * 2 + shift)
        table.withColumn("doc_id", moved).filter("doc_id IS NOT NULL" if name == "labels" else "true").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    rows = P.run(spark, str(tmp_path)).collect()
    got = [r["doc_id"] for r in rows]
    assert set(got) <= ids and None in got and sum(i is not None and i % 2 for i in got) + got.count(None) > 0
    known = [i for i in got if i is not None]
    assert len(known) == len(set(known)) > 20 and any(i % 4 == 3 for i in known) and any(i % 4 == 1 for i in known)
