"""Token files: the coder alone, the tokenizer's shortcuts, whole files, damage."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loomlake.llm import token_files as K
from loomlake.llm.shared import scratch

SPEC, VOCABULARY = K.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(SPEC)


@pytest.mark.parametrize("n", [0, 1, 5, K.LANES, K.LANES + 1, 200_000, K.BLOCK])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
    table = K.frequency_table(np.bincount(ids, minlength=6000))
    assert table.freq.sum() == 1 << table.bits or not n
    block = K.encode_block(ids, table)
    assert (K.decode_block(block, table, table.slots()) == ids).all()
    if n > 100_000:
        counts = np.bincount(ids, minlength=6000) / n
        entropy = -(counts[counts > 0] * np.log2(counts[counts > 0])).sum() * n / 8
        assert len(block) < entropy * 1.02 + 24 + 12 * K.LANES * -(-n // K.LANES // K.CHECKPOINT) + 8 * K.LANES


def test_decoding_from_checkpoints():
    ids = np.random.default_rng(2).integers(0, 300, 150_000).astype(np.uint32)
    table = K.frequency_table(np.bincount(ids))
    block, step = K.encode_block(ids, table), K.LANES * K.CHECKPOINT
    marks = -(-len(ids) // step)
    parts = [K.decode_block(block, table, table.slots(), i, i + 1) for i in range(marks)]
    assert (np.concatenate(parts) == ids).all() and len(parts[0]) == step


def test_tables():
    one = K.frequency_table(np.array([0, 7, 0]))
    assert one.freq.tolist() == [0, 1 << one.bits, 0]
    skewed = K.frequency_table(np.array([10**12] + [1] * 70_000))
    assert skewed.freq.sum() == 1 << skewed.bits and skewed.freq.min() == 1
    flat = K.frequency_table(np.ones(50_000, int))
    assert flat.freq.sum() == 1 << flat.bits and flat.freq.min() >= 1


def test_damage_is_seen():
    docs = [(1, np.arange(1000, dtype=np.uint32)), (None, np.zeros(0, np.uint32)), (3, np.arange(5, dtype=np.uint32))]
    table = K.frequency_table(np.bincount(np.concatenate([x for _, x in docs])))
    data = b"".join(K.encode_file(docs, table))
    got = list(K.decode_file(data, table))
    assert [d for d, _ in got] == [1, None, 3] and all((a == b).all() for (_, a), (_, b) in zip(got, docs, strict=True))
    for at in (3, len(data) // 2, len(data) - 2):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(K.decode_file(bytes(bad), table))


def test_encoder_equals_the_library(tokenizer):
    rng = random.Random(6)
    pieces = ["the", " ", "  ", "\n", "\n\n", " \n", "\t", "don't", "Straße,", "x.", "...", "é", "日本", "🎉", "<|endoftext|>", "1,000.5", "a,b", "U.S.", ",", " ", "\r\n", "'s", "_", "END.",
              "wort%%%", "Wort###", "é***", "ß&&&", "x'%", "it's!!", "7%%", "_%", "日本。", "日本%%", "a\u0301.", "a\u0301b%%", "$$$", "(see)", "\u2028", "²%", "ab\u200d."]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n", "a", "a ", " a", "x" * 20_000, "word " * 20_000]
    encoder = K.Encoder(SPEC)
    for first in range(0, len(texts), 500):
        part = texts[first : first + 500]
        for text, raw in zip(part, encoder.encode(part), strict=True):
            assert np.frombuffer(raw, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("known", [K.KNOWN, 20])
def test_known_stems_are_kept(tokenizer, monkeypatch, known):
    """Chunks of earlier calls aren't encoded again, and ids stay the library's, also where what is kept is full."""
    monkeypatch.setattr(K, "KNOWN", known)
    rng, encoder, seen = random.Random(8), K.Encoder(SPEC), []
    monkeypatch.setattr(K.Encoder, "_ids", lambda self, text, of=K.Encoder._ids: seen.append(len(text)) or of(self, text))
    word = lambda: "".join(rng.choice("aeiourstnl\u00e9") for _ in range(rng.randint(1, 7))) + rng.choice(["", "", ",", "%%"])
    texts = [rng.choice([" ", "\n"]).join(word() for _ in range(40)) for _ in range(30)]
    sizes = []
    for part in (texts[:15], texts[10:], texts):
        seen.clear()
        for text, raw in zip(part, encoder.encode(part), strict=True):
            assert np.frombuffer(raw, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        sizes.append(sum(seen))
    if known > 20:
        assert sizes[2] < 10 < sizes[1]  # the tails only


def test_special_tokens_are_the_librarys(spark, tokenizer):
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a <|endoftext|>"]
    for text, raw in zip(texts, K.Encoder(SPEC).encode(texts), strict=True):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, np.uint32).tolist() == ids and 50256 in ids


def test_starts_over_many_files_and_parts(spark, monkeypatch):
    rows = [(i, "word " * (i % 7)) for i in range(400)]
    monkeypatch.setattr(K, "BLOCK", 16)  # many files a part; tasks run in forked workers of this process or not, either way starts must add up
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = sorted(K.token_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    assert len(got) == 400


def test_files_equal_brute_force(spark, tokenizer):
    rows = [(5, "five words stand here now"), (1, "one"), (9, None), (3, ""), (7, "seven " * 30_000), (5, "five again"), (None, "no id"), (2, "two\n\nlines\tand tab")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, n_tokens int, crc int")
    want, start = [], 0
    coded = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [K.END_ID]) for d, t in rows]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, crc(x[1]))):
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in K.token_index(df.repartition(3)).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert K.token_index(df.filter("doc_id < 0")).count() == 0
    written = K.write_token_files(df, scratch(spark, "tokens"), SPEC, VOCABULARY)
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in K.read_token_files(spark, written).collect()}
    assert np.frombuffer(whole[1, want[1][1]], "<u4").tolist() == tokenizer.encode("one", add_special_tokens=False).ids + [2]


def test_ids_beyond_doubles(spark):
    big = (1 << 53) + 1
    rows = [(big + 2, "c"), (None, "a"), (big, "b b"), (-big, ""), (big + 1, None)]
    got = [r["doc_id"] for r in K.token_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).orderBy("start").collect()]
    assert got == [None, -big, big, big + 1, big + 2]
