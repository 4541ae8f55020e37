"""Links between near-equal embeddings, by a subspace pigeonhole join.

Cosine c or more means a squared distance of 2 - 2c or less between unit vectors. They are rotated (signs and a Hadamard
transform, which spreads every vector evenly) and split into blocks of WIDTH dimensions; the budget for the squared
distance is shared among the blocks in proportion to their width, so a pair within the whole budget is within the share of
one block at least. In each block near pairs are found by a range join: vectors lie in the cells of a grid over the block's
first dimensions, as wide as the block's radius, and visit the cells within reach. What comes within a block's share is
verified by the cosine of the original vectors, and counts in the first such block only: the union of all candidates, each
verified once.

Equal vectors are one throughout, with a weight. Cells with many vectors are dealt over parts, and visitors pass by in
batches. Of the links of a cell come out counts and a forest that connects what they connect, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.llm.near_dedup import components
from loomlake.llm.shared import salts, stored, unused, with_group, workspace

COSINE = 0.95
#: Dimensions of a block, and of those the most that a grid is laid over.
WIDTH, GRID = 8, 3
#: Vectors that a part of a cell holds, and products that a task holds at once.
PART, TILE = 8192, 1 << 20
_SLACK = 1e-9


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotated(rows: np.ndarray) -> np.ndarray:
    """Unit vectors after a rotation fixed by their length. A row's result depends on that row alone, to the last bit."""
    n, d = rows.shape
    size = max(WIDTH, 1 << (d - 1).bit_length())
    out = np.zeros((n, size))
    out[:, :d] = unit(rows) * np.random.default_rng(d).choice([-1.0, 1.0], d)
    step = 1
    while step < size:
        pairs = out.reshape(n, -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return out / np.sqrt(size)


def block_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by block between rows of x and y, added in a fixed order."""
    t = ((x - y) ** 2).reshape(len(x), -1, WIDTH)
    while t.shape[2] > 1:
        t = t[:, :, : t.shape[2] // 2] + t[:, :, t.shape[2] // 2 :]
    return t[:, :, 0]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def share(size: int, cosine: float) -> float:
    """A block's share of the squared distance, with room for rounding."""
    return (2 - 2 * cosine) * WIDTH / size + _SLACK


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the links (i, j) connect it with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def _vectors(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of an array column, flat, and where each row's begin and end."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float), np.concatenate([[0], np.cumsum(lengths)])


def visits(vectors: DataFrame, cosine: float, grid: int) -> DataFrame:
    """(d, block, cell, own, node, weight, vector): each vector in its own cell of each block's grid, and in the cells after
    it that lie within the block's radius. Of two neighbouring cells one is visited by the other's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                values, starts = _vectors(batch, "vector")
                lengths = np.diff(starts)
                for d in np.unique(lengths):
                    rows = np.flatnonzero(lengths == d)
                    yield from placed(batch.take(pa.array(rows)), values[(starts[rows][:, None] + np.arange(d)).ravel()].reshape(-1, d))

    def placed(batch: pa.RecordBatch, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        where = rotated(rows)
        radius = np.sqrt(share(where.shape[1], cosine))
        for block in range(where.shape[1] // WIDTH):
            at = where[:, block * WIDTH : block * WIDTH + grid] / radius
            home = np.floor(at)
            for shift in np.ndindex(*[3] * grid):
                shift = np.array(shift) - 1
                nonzero = np.flatnonzero(shift)
                if len(nonzero) and shift[nonzero[0]] < 0:
                    continue  # that cell's vectors come here
                away = np.where(shift > 0, home + 1 - at, np.where(shift < 0, at - home, 0.0))
                near = np.flatnonzero((away * away).sum(axis=1) <= 1 + _SLACK)
                if not len(near):
                    continue
                # Radii of the reach: cells count from the least that a unit vector can lie in.
                cell = ((home[near] + shift + (1 << 19)).astype(np.int64) * (np.int64(1) << (20 * np.arange(grid)))).sum(axis=1)
                some, n = batch.take(pa.array(near)), len(near)
                column = lambda x: pa.array(np.broadcast_to(x, n))
                names = [column(np.int64(rows.shape[1])), column(np.int64(block)), pa.array(cell), column(not len(nonzero)), *some.columns]
                yield pa.RecordBatch.from_arrays(names, ["d", "block", "cell", "own", "node", "weight", "vector"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("node", "weight", "vector").mapInArrow(run, f"d long, block long, cell long, own boolean, node long, weight long, vector {kind}")


def cell_links(dealt: DataFrame, cosine: float) -> DataFrame:
    """(node, links, other): the weights that a node is linked with, counted in parts, and edges that connect what is linked.

    dealt: rows of ``visits`` with (part, parts, home), sorted so that a part's home rows come before its visitors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, pending = None, None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "block", "cell", "part", "parts")], axis=1)
            flags = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("home", "own")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (flags[1:] != flags[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if lo == hi:
                    continue
                if key is None or (keys[lo] != key).any():
                    key, home, pending = keys[lo], None, []
                node, weight = (batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in ("node", "weight"))
                d = int(key[0])
                values, _ = _vectors(batch.slice(lo, hi - lo), "vector")
                rows = (node, weight, values.reshape(-1, d))
                if flags[lo, 0]:
                    rows = (*rows, rotated(rows[2]))
                    if key[4] == 1:  # the cell's own vectors meet as they come
                        yield from compared(rows, rows, int(key[1]), "within")
                        if home is not None:
                            yield from compared(home, rows, int(key[1]), "both")
                    home = rows if home is None else tuple(np.concatenate([a, b]) for a, b in zip(home, rows, strict=True))
                elif home is not None:
                    yield from compared(home, (*rows, rotated(rows[2])), int(key[1]), "first" if flags[lo, 1] else "both")

    def compared(x: tuple, y: tuple, block: int, counted: str) -> Iterator[pa.RecordBatch]:
        """counted: 'both' ends of a link; the 'first' alone, where the pair comes the other way round too; 'within' a set."""
        wide = max(1, TILE // max(1, len(x[0])))
        for lo in range(0, len(y[0]), wide):
            yield from tile(x, tuple(a[lo : lo + wide] for a in y), block, counted, lo)

    def tile(x: tuple, y: tuple, block: int, counted: str, first: int) -> Iterator[pa.RecordBatch]:
        size = x[3].shape[1]
        most, at = share(size, cosine), slice(block * WIDTH, block * WIDTH + WIDTH)
        a, b = x[3][:, at], y[3][:, at]
        apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
        i, j = np.nonzero(apart <= most + _SLACK)
        # Of a set with itself, and of rows that come the other way round too, a node never meets itself.
        keep = i < first + j if counted == "within" else x[0][i] != y[0][j]
        i, j = i[keep], j[keep]
        linked = [np.zeros(0, np.int64)] * 2
        step = max(1, TILE // size)
        for lo in range(0, len(i), step):
            p, q = i[lo : lo + step], j[lo : lo + step]
            by_block = block_distances(x[3][p], y[3][q]) <= most
            good = by_block[:, block] & ~by_block[:, :block].any(axis=1)
            p, q = p[good], q[good]
            good = cosines(x[2][p], y[2][q]) >= cosine
            linked = [np.concatenate([old, new[good]]) for old, new in zip(linked, (p, q), strict=True)]
        if not len(linked[0]):
            return
        p, q = linked
        n, m = len(x[0]), len(y[0])
        node = np.concatenate([x[0], y[0]])
        links = np.concatenate([np.bincount(p, y[1][q], n), np.bincount(q, x[1][p], m) if counted != "first" else np.zeros(m)]).astype(np.int64)
        label = forest(n + m, p, q + n)
        some, hung = np.flatnonzero(links), np.flatnonzero(label != np.arange(n + m))
        out = pd.DataFrame({"node": node[np.concatenate([some, hung])], "links": np.concatenate([links[some], np.zeros(len(hung), np.int64)])})
        out["other"] = pd.array(np.concatenate([np.zeros(len(some), np.int64), node[label[hung]]]), "Int64")
        out.loc[: len(some) - 1, "other"] = pd.NA
        yield pa.RecordBatch.from_pandas(out, schema=pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())]), preserve_index=False)

    return dealt.mapInArrow(run, "node long, links long, other long")


def linked_vectors(vectors: DataFrame, cosine: float, within: str) -> DataFrame:
    """(node, links, other) of distinct vectors (node, weight, vector), as ``cell_links`` gives them."""
    n = vectors.count()
    grid = min(GRID, max(1, round(np.log(max(n, 1) / 2000) / np.log(4))))
    rows = stored(visits(vectors, cosine, grid), "visits", within)
    cell = ["d", "block", "cell"]
    crowded = rows.filter("own").groupBy(*cell).count().filter(F.col("count") > PART)
    crowded = stored(crowded.select(*cell, F.ceil(F.col("count") / PART).alias("parts")), "crowded", within)
    held = rows.join(crowded, cell, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.when(F.col("own"), F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(F.lit(-1))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    place = lambda part, home: F.struct(part.alias("part"), home.alias("home"))
    roles = F.when(F.col("own") & (F.col("parts") == 1), F.array(place(F.lit(0).cast("long"), F.lit(True))))
    roles = roles.otherwise(F.concat(F.when(F.col("own"), F.array(place(own, F.lit(True)))).otherwise(F.array().cast("array<struct<part:bigint,home:boolean>>")), F.transform(every, lambda p: place(p, F.lit(False)))))
    key = [*cell, "part", "parts"]
    dealt = held.withColumn("role", F.explode(roles)).select(*cell, "role.part", "parts", "role.home", "own", "node", "weight", "vector")
    ready = dealt.repartition(*key).sortWithinPartitions(*key, F.desc("home"), F.desc("own"))
    return stored(cell_links(ready, cosine), "links", within)


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """A row per input row: (vec_id, n_links, component_id, kept).

    n_links counts the other rows whose vectors have a cosine of at least ``cosine`` (0 < cosine <= 1) with this one, in
    double precision; component_id is the smallest id that links lead to, its own included (null if all are null); kept holds
    where it is the row's own. Vectors that are null, empty, zero, or hold null or not finite components link with nothing,
    and vectors of different lengths not with each other. Repeated rows are rows: they link. A repeated id is kept as
    often as it comes. No rows: no rows.
    """
    with workspace(df.sparkSession, "vectors") as within:
        return stored(_near(df, vec_id, vector, cosine, within), "near-vectors")


def _near(df: DataFrame, vec_id: str, vector: str, cosine: float, within: str) -> DataFrame:
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    plain = F.size("vector") > 0
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(plain & ~bad & some, F.lit(False))
    digest = F.sha2(F.col("vector").cast("string"), 256)
    rows = stored(rows.select("vec_id", F.when(usable, F.col("vector")).alias("vector"), F.when(usable, digest).alias("digest")), "rows", within)

    once = rows.filter("digest IS NOT NULL").groupBy("digest", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    once = stored(once.withColumn("node", F.monotonically_increasing_id()), "once", within)
    found = linked_vectors(once.select("node", "weight", "vector"), cosine, within)

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    labels = components(edges, within)
    reached = labels.join(once.select("node", "first"), "node")
    least = {"least": (F.min("first"), F.min("least"))}
    reached = with_group(reached, ["component"], ["node"], least, F.lit(True)).select("node", "least")
    classes = once.join(links, "node", "left").join(reached, "node", "left")
    classes = classes.select("digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    classes = stored(classes, "classes", within)

    parts = salts(df.sparkSession)
    salted = rows.select("vec_id", "digest").withColumn("part", F.when(F.col("digest").isNotNull(), F.pmod(F.xxhash64("vec_id"), F.lit(parts))))
    many = salted.filter("digest IS NOT NULL").select("digest", "part").distinct()
    whole = salted.join(many.join(classes, "digest"), ["digest", "part"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("vec_id") == component, F.lit(False))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))


def op11_near_vectors(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.k AS a, b.k AS b FROM v a JOIN v b ON a.k <> b.k AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT k AS a, k AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT r.a AS k, min(w.vec_id) AS component_id FROM reach r JOIN v w ON w.k = r.b GROUP BY 1),
n AS (SELECT a AS k, count(*) AS n_links FROM l GROUP BY 1)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept
FROM v JOIN c USING (k) LEFT JOIN n USING (k)
UNION ALL
SELECT vec_id, 0, vec_id, vec_id IS NOT NULL FROM embeddings WHERE NOT coalesce(len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
"""
