"""The prefix trie against a plain version, with nulls, ties, long conversations and large ids."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loomlake.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
BIG = (1 << 53) + 100 - ((1 << 53) + 100) % 100


def plain(rows: list[tuple]) -> set[tuple]:
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c > 0 else -1)
        built[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members, ends = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children, below = {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves, total = below.get(node[:d], (0, 0))
            below[node[:d]] = leaves + (node not in children), total + saved
    return {
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children.get(node, 0), *below[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, m in members.items()
    }


def nodes(spark, rows: list[tuple]) -> set[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "a": F.lit(1), "part": F.lit(2)})
    found = trie.prefix_trie(*trie.rebuilt_turns(trie.numbered_turns(df)))
    out = found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(out) == len(set(map(tuple, out)))
    return set(map(tuple, out))


def drawn(seed: int, ids: list[int], longest: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for c in ids:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, None, t // 2]), rng.choice(["u", "a", None]), rng.choice(["x", "yé", "", None, "z" * 70])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_trie_equals_plain_version(spark, seed):
    rows = drawn(seed, [*range(-3, 12), *range(95, 112), 305, BIG, BIG + 1, BIG + 2, BIG + 99], 9)
    rows += [(None, 0, "u", "x"), *[(7, 1, "u", "x")] * 3]
    assert nodes(spark, rows) == plain(rows)


def test_long_conversations_by_segments_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 4)
    monkeypatch.setattr(trie, "PIECE", 50)
    rows = [(c, t, "u", f"{t}" if t < 30 - c % 7 else f"{t} {c % 3}") for c in range(100, 140) for t in range(5 + 9 * (c % 5))]
    assert nodes(spark, rows) == plain(rows)


def test_many_equal_conversations_and_none(spark):
    rows = [(c, t, "u", "same") for c in range(300) for t in range(3)]
    assert nodes(spark, rows) == plain(rows)
    assert nodes(spark, []) == set()


def test_turnless_conversation(spark):
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert nodes(spark, [(lone, 0, "u", "x")]) == {(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}
