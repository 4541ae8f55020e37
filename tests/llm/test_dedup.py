"""Exact, near and line dedup: rules on small tables, against brute force."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlake.llm import exact_dedup, line_dedup, near_dedup

SCHEMA = "doc_id long, text string, _part int, keep_id string"
WORD = re.compile(r"[^\W_]+")


def table(spark, rows):
    """Documents with two more columns whose names clash with those used inside."""
    return spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))
    line = lambda: " ".join(word() for _ in range(rng.randint(1, 14)))
    shared = [line() for _ in range(6)]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice(shared) if rng.random() < 0.3 else line() for _ in range(rng.randint(1, 12)))
        rows.append((i, text))
        if rng.random() < 0.4:
            words = text.split(" ")
            words[rng.randrange(len(words))] = word()
            rows.append((1000 + i, " ".join(words)))
        if rng.random() < 0.3:
            rows.append((2000 + i, text))
    return [*rows, (5000, None), (5001, ""), (5002, "..."), (None, "one two three four five six"), (5003, "x " * 4000), (7, rows[0][1])]


def test_exact_groups(spark):
    rows = corpus()
    by = collections.defaultdict(list)
    for d, t in rows:
        by[t or ""].append(d)
    want = []
    for d, t in rows:
        ids = [x for x in by[t or ""] if x is not None]
        keep = max(ids) if ids else None
        want.append((d, keep, len(by[t or ""]), keep == d, hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = exact_dedup.drop_copies(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "_part", "keep_id"]
    assert kept.count() == sum(w[3] for w in want)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(table(spark, [])).count() == 0


def test_chunks_depend_on_content(spark):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefgmnopwy") for _ in range(rng.randint(2, 8))) for _ in range(6000))
    one, two = (r["weak"] for r in exact_dedup.chunk_recipes(table(spark, [(1, text), (2, "A new start. " + text[:9000] + " inserted " + text[9000:])])).collect())
    assert len(one) > 10 and len(set(one) & set(two)) >= len(one) * 0.9


def test_ambiguous_chunks_are_seen(spark):
    rows = spark.createDataFrame([([1, 2], ["a", "b"]), ([1], ["c"])], "weak array<long>, strong array<string>")
    assert [r["weak"] for r in exact_dedup.ambiguous_chunks(rows).collect()] == [1]


def near_by_force(rows):
    parent, first, bags = {}, {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, t) in enumerate(rows):
        words = WORD.findall((t or "").lower())
        k = min(5, len(words))
        parent[i] = i
        key = tuple(words) if words else t or ""
        if key in first:
            parent[i] = first[key]
            continue
        first[key] = i
        bags[i] = collections.Counter(tuple(words[j : j + k]) for j in range(len(words) - k + 1)) if words else collections.Counter()
    items = list(bags.items())
    for n, (i, a) in enumerate(items):
        for j, b in items[:n]:
            union = sum((a | b).values())
            if union and sum((a & b).values()) / union >= 0.8 and find(i) != find(j):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    out = []
    for ids in groups.values():
        known = [d for d in ids if d is not None]
        out += [(d, min(known) if known else None, len(ids)) for d in ids]
    return out


def test_near_duplicate_classes(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(5000)}" for _ in range(60)] for _ in range(8)]
    rows = []
    for b in base:
        for _ in range(4):
            text = list(b)
            text[rng.randrange(60)] = "changed"
            rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), " ".join(b) + "."))
    chain = [f"c{i}" for i in range(80)]
    rows += [(100 + i, " ".join(chain[2 * i :])) for i in range(6)]  # neighbours are alike, the ends are not
    rows += [(200, None), (201, ""), (202, "!?"), (203, "one two"), (204, "One, two"), (None, "alone here"), (205, "spam " * 3000), (206, "spam " * 3001)]
    got = [tuple(r)[:3] for r in near_dedup.near_duplicate_classes(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(near_by_force(rows), key=str)
    kept = near_dedup.drop_near_duplicates(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "_part", "keep_id"]
    assert kept.count() == len({(r[1], r[0] if r[1] is None else 0) for r in got})
    assert near_dedup.near_duplicate_classes(table(spark, [])).count() == 0


def test_signatures_are_unbiased():
    rng, z = np.random.default_rng(1), []
    for _ in range(150):
        keys = np.sort(rng.integers(0, 2**63, 200).astype(np.uint64))
        a, b = rng.integers(1, 40, 200), rng.integers(1, 40, 200)
        true = near_dedup.overlap((keys, a), (keys, b))
        x, y = near_dedup.bag_min_hash([(keys, a), (keys, b)])
        z.append(((x == y).mean() - true) / (true * (1 - true) / near_dedup.REGISTERS) ** 0.5)
    assert abs(np.mean(z)) * len(z) ** 0.5 < 4
    assert 0.7 < np.std(z) < 1.3


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (101, 100)], "a long, b long")
    got = dict(tuple(r) for r in near_dedup.components(links).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def lines_by_force(rows, threshold=0.8):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    gone, seen = collections.defaultdict(list), []
    for d, t in order:
        for i, line in enumerate((t or "").split("\n")):
            words = set(WORD.findall(line.lower()))
            if not words:
                continue
            if any(len(words & s) / len(words | s) >= threshold for s in seen):
                gone[d].append(i)
            seen.append(words)
    return gone


def test_line_dedup(spark):
    rows = [r for r in corpus(9) if r[0] != 7] + [(7, "a b c d e f g h i j\nA, b c d e f g h i\n\n\na b c d e f g h i j k\nz")]
    gone = lines_by_force(rows)
    got = {r["doc_id"]: (r["n_lines"], r["removed"]) for r in line_dedup.line_report(table(spark, rows)).collect()}
    assert got == {d: ((t or "").count("\n") + 1, gone[d]) for d, t in rows}
    clean = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(table(spark, rows)).collect()}
    assert clean[5000] is None
    for d, t in rows:
        if t is not None:
            assert clean[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "same line"), (1, "same line")]])
def test_line_dedup_edges(spark, rows):
    assert line_dedup.line_report(table(spark, rows)).select(F.sum("n_removed")).head()[0] in (None, 0)


def test_block_comparison_is_exact():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.sort(rng.choice(pool[: rng.integers(30, 34)], rng.integers(26, 30), replace=False)) for _ in range(60)]
    groups = [bytes([g]) for g in rng.integers(0, 20, 60)]
    query = np.arange(60) % 3 == 0
    found = near_dedup.compare_all([bytes([i]) for i in range(60)], groups, [x.tobytes() for x in sets], query)
    want = set()
    for i in np.flatnonzero(query):
        for j in np.flatnonzero(~query):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if groups[i] != groups[j] and shared / (len(sets[i]) + len(sets[j]) - shared) >= 0.8:
                want.add((i, groups[j]))
    assert want and {(a[0], groups[b[0]]) for a, b in found} == want and len(found) == len(want)


def test_block_comparison_is_bounded():
    """A full block takes a few arrays beside its hashes (5 MB here): 110 MB before."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 180).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[n:], rng.integers(0, 2**63, n).astype(np.uint64)])) for n in rng.integers(0, 90, 3450)]
    groups, query = [bytes([g]) for g in rng.integers(0, 9, 3450)], rng.random(3450) < 0.5
    tracemalloc.start()
    found = near_dedup.compare_all([i.to_bytes(2, "big") for i in range(3450)], groups, [x.tobytes() for x in sets], query)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 64 << 20


@pytest.mark.parametrize("block", [2000, 7])
def test_crowded_buckets(spark, monkeypatch, block):
    """A crowd of near copies whose members resemble some others only: the same classes as by force."""
    monkeypatch.setattr(near_dedup, "PAIRED", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 4))):
            words[rng.randrange(70)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    got = [tuple(r)[:3] for r in near_dedup.near_duplicate_classes(table(spark, rows)).collect()]
    assert sorted(got) == sorted(near_by_force(rows)) and len({g[1] for g in got}) > 1


def test_rows_without_an_id_of_their_own(spark):
    """A third of the ids are null and some are repeated: one row of each class stays, whatever its id."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(30)) for _ in range(30)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0] + "."), (None, texts[3]), (7, texts[6]), (1, texts[2]), (7, texts[4].upper()), (7, texts[4]), (500, texts[1]), (None, None), (None, "")]
    got = near_dedup.drop_near_duplicates(table(spark, rows))
    assert got.columns == ["doc_id", "text", "_part", "keep_id"]
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted((t or "").lower().strip(".") for _, t in kept) == sorted([*texts, ""])
    by = {(t or "").lower().strip("."): d for d, t in kept}
    assert by[texts[6]] == 7 and by[texts[2]] == 1 and by[texts[1]] == 7 and by[texts[9]] is None
    found = [tuple(r)[:3] for r in near_dedup.near_duplicate_classes(table(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted(near_by_force(rows), key=str)


@pytest.mark.parametrize("broadcast", [300_000, 0])
def test_line_crowds_and_the_way_beyond_broadcast(spark, monkeypatch, broadcast):
    """A passage of which 70 near copies share all rare words, a second one, and lines that share words of a crowd only."""
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST", broadcast)
    monkeypatch.setattr(line_dedup, "CROWD", 8)
    rng = random.Random(14)
    base = [[f"p{k}w{i}" for i in range(24)] for k in range(2)]
    rows = []
    for d in range(70):
        lines = []
        for words in base:
            line = list(words)
            for _ in range(rng.choice((0, 1, 2, 3, 4))):
                line[rng.randrange(24)] = rng.choice("and or the of".split())
            lines.append(" ".join(line))
        lines.append(" ".join(base[0][:3] + [f"q{d}x{i}" for i in range(9)]))
        rows.append((d, "\n".join(lines)))
    gone = lines_by_force(rows)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(table(spark, rows)).collect()}
    assert got == {d: gone[d] for d, _ in rows} and sum(map(len, got.values())) > 70


def test_lines_that_are_gone_arent_compared_again(spark, monkeypatch):
    """After the crowds no pair is verified whose later line is gone; of a large crowd several leads leave fewer lines."""
    monkeypatch.setattr(line_dedup, "CROWD", 8)
    rng = random.Random(5)
    rows = []
    for d in range(60):
        line = [f"w{i}" for i in range(24)]
        for _ in range(rng.choice((0, 1, 2, 3))):
            line[rng.randrange(6, 24)] = rng.choice("and or the of".split())
        rows.append((d, " ".join(line)))
    seen, whole = [], line_dedup._ordered_pairs

    def ordered(*args):
        pairs = whole(*args)
        seen.append({(r["later"], r["earlier"]) for r in pairs.collect()})
        return pairs

    monkeypatch.setattr(line_dedup, "_ordered_pairs", ordered)
    found, alike = [], line_dedup.later_sets

    def later(*args):
        sids = alike(*args)
        found.append({r["sid"] for r in sids.collect()})
        return sids

    monkeypatch.setattr(line_dedup, "later_sets", later)
    gone, left = lines_by_force(rows), []
    for large in (1000, 16):
        monkeypatch.setattr(line_dedup, "LARGE", large)
        seen.clear(), found.clear()
        got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(table(spark, rows)).collect()}
        assert got == {d: gone[d] for d, _ in rows}
        assert found[0] and not found[0] & {later for later, _ in seen[1]}
        left.append(len(seen[1]))
    assert left[1] <= left[0]


def test_copies_whose_own_words_are_rarer_are_a_crowd(spark, monkeypatch):
    """Near copies of a passage in which words stand for others that are rarer than the passage's, but as common as a
    crowd's: they are compared with few lines, not each with all. Words are parted and hashed in one pass over the texts."""
    monkeypatch.setattr(line_dedup, "CROWD", 8)
    monkeypatch.setattr(line_dedup, "LARGE", 16)
    rng, rows, tables, parted = random.Random(9), [], {}, []
    for d in range(90):
        line = [f"w{i}" for i in range(40)]
        for _ in range(rng.choice((2, 3, 3, 4, 4))):
            line[rng.randrange(40)] = f"o{rng.randrange(12)}"
        rows.append((d, " ".join(line)))
    keep = lambda df, name, within=None, of=line_dedup.stored: tables.setdefault(name, []).append(of(df, name)) or tables[name][-1]
    split = lambda text, of=line_dedup._split: parted.append(text) or of(text)
    monkeypatch.setattr(line_dedup, "stored", keep)
    gone = lines_by_force(rows)
    monkeypatch.setattr(line_dedup, "_split", split)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(table(spark, rows)).collect()}
    assert got == {d: gone[d] for d, _ in rows} and sum(map(len, got.values())) > 60
    assert tables["line-order"][1].count() < 1000  # of 4005 pairs
    assert "text" not in parted


def test_long_lines_are_parted_before_texts_are_read(spark, monkeypatch):
    """Long lines that share a word and little else, by whose parities in 64 bits they could be alike: of each pair of
    which texts are read, half of the words are shared at least, and what goes is as by force."""
    rng, tables = random.Random(20), {}
    lines = [[f"v{rng.randrange(4000)}" for _ in range(140)] for _ in range(160)]
    lines += [[*x[: -(4 + 9 * i)], *(f"n{i}x{j}" for j in range(4))] for i, x in enumerate(lines[:6])]
    rows = [(d, " ".join(x)) for d, x in enumerate(lines)]
    keep = lambda df, name, within=None, of=line_dedup.stored: tables.setdefault(name, []).append(of(df, name)) or tables[name][-1]
    monkeypatch.setattr(line_dedup, "stored", keep)
    gone = lines_by_force(rows)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(table(spark, rows)).collect()}
    assert got == {d: gone[d] for d, _ in rows} and sum(map(len, got.values())) > 2
    words = {r["sid"]: set(r["words"]) for r in tables["whole-lines"][-1].collect()}
    pairs = [(words[r["later"]], words[r["earlier"]]) for r in tables["line-order"][-1].collect()]
    assert tables["line-pairs"][-1].count() > 100 > len(pairs) and all(len(a & b) / len(a | b) > 0.5 for a, b in pairs)


def test_recall_of_near_duplicates(spark):
    """All pairs of different texts of a whole table that resemble each other by 0.8 or more end in one class: measured."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    bags = [near_dedup.shingle_multiset(t) for _, t in rows]
    owners = collections.defaultdict(list)
    for i, (h, _, _) in enumerate(bags):
        for x in h.tolist():
            owners[x].append(i)
    pairs = {(i, j) for ids in owners.values() for k, i in enumerate(ids) for j in ids[k + 1 :]}
    near = [(i, j) for i, j in pairs if near_dedup.overlap(bags[i][:2], bags[j][:2]) >= near_dedup.THRESHOLD]
    of = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(of[rows[i][0]] == of[rows[j][0]] for i, j in near)
    assert len(near) > 50 and found / len(near) >= 0.99


def test_ids_beyond_doubles(spark):
    big, rng = (1 << 53) + 1, random.Random(2)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(40)) for _ in range(4)]
    rows = [(big, texts[0]), (None, texts[1]), (big + 2, texts[2]), (-big, texts[3]), (big + 4, texts[0] + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(df).collect()} == set(rows[:4])
    got = {tuple(r)[:3] for r in near_dedup.near_duplicate_classes(df).collect()}
    assert got == {(big, big, 2), (big + 4, big, 2), (None, None, 1), (big + 2, big + 2, 1), (-big, -big, 1)}
