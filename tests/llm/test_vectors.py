"""The subspace pigeonhole join against all pairs."""

import numpy as np
import pytest

from loomlake.llm import vector_dedup
from loomlake.llm.vector_dedup import forest, near_vectors, rotated, share

BIG = (1 << 53) + 1


def plain(rows: list[tuple]) -> set[tuple]:
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = {k: [] for k in range(len(rows))}
    for d in {len(v) for (_, v), good in zip(rows, ok, strict=True) if good}:
        at = [k for k, (_, v) in enumerate(rows) if ok[k] and len(v) == d]
        m = np.array([rows[k][1] for k in at])
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(m @ m.T >= 0.95), strict=True):
            if i != j:
                near[at[i]].append(at[j])
    out, label = [], {}
    for k in range(len(rows)):
        if k in label:
            continue
        seen, todo = {k}, [k]
        while todo:
            fresh = [x for x in near[todo.pop()] if x not in seen]
            seen.update(fresh)
            todo += fresh
        least = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
        label |= dict.fromkeys(seen, least)
    for k, (i, _) in enumerate(rows):
        out.append((i, len(near[k]), label[k], i is not None and i == label[k]))
    return sorted(out, key=str)


def drawn(seed: int, d: int, n: int, groups: int, spread: float) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    rows = [rng.normal(size=d) for _ in range(n)]
    rows += [centres[rng.integers(groups)] * (1 + rng.random()) + spread * rng.normal(size=d) for _ in range(n)]
    return [(BIG + k, [float(x) for x in np.float32(r)]) for k, r in enumerate(rows)]


def found(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, block string, node int").repartition(5)
    return sorted((tuple(r) for r in near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize(("d", "grid", "part"), [(64, 1, 8192), (64, 2, 20), (20, 3, 50), (3, 1, 30)])
def test_links_equal_all_pairs(spark, monkeypatch, d, grid, part):
    monkeypatch.setattr(vector_dedup, "PART", part)
    monkeypatch.setattr(vector_dedup, "TILE", 500)
    monkeypatch.setattr(vector_dedup, "GRID", grid)
    monkeypatch.setattr(vector_dedup, "round", lambda _: 9, raising=False)
    rows = drawn(d, d, 150, 6, 0.16)
    assert found(spark, rows) == plain(rows)
    assert sum(n for _, n, *_ in plain(rows)) > 400


def test_odd_rows(spark):
    rows = [(None, [1.0, 0.0]), (7, [2.0, 0.0]), (5, [1.0, 0.1]), (5, [1.0, 0.1]), (4, None), (None, None), (3, []), (2, [0.0, 0.0]), (1, [float("nan"), 1.0]), (0, [float("inf"), 1.0]), (-1, [1.0, None]), (8, [1.0, 0.0, 0.0]), (9, [-1.0, 0.0]), (6, [1e-30, 0.0]), (10, [3e38, 3e37])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_many_copies_and_a_chain(spark):
    turn = [[float(np.cos(a)), float(np.sin(a)), 0.0, 0.0] for a in np.arange(60) * 0.1]
    rows = [(1000 - k, v) for k, v in enumerate(turn)] + [(k, [0.0, 0.0, 1.0, 0.0]) for k in range(400)]
    assert found(spark, rows) == plain([(i, [float(x) for x in np.float32(v)]) for i, v in rows])


def test_rotation_keeps_distances_and_rows_alone_decide():
    x = np.random.default_rng(0).normal(size=(50, 20))
    r, u = rotated(x), x / np.linalg.norm(x, axis=1)[:, None]
    assert np.abs(r @ r.T - u @ u.T).max() < 1e-14
    assert all((rotated(x[k : k + 1])[0] == r[k]).all() for k in range(50))
    assert share(64, 0.95) > 0.1 / 8


def test_forest():
    rng = np.random.default_rng(5)
    i, j = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    label = forest(300, i, j)
    assert (label[i] == label[j]).all() and (label[label] == label).all() and (label <= np.arange(300)).all()
    chain = forest(500, np.arange(499), np.arange(1, 500))
    assert (chain == 0).all()
