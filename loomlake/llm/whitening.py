"""Whitening of embeddings by a compensated covariance.

Sums are kept in double-double (a high part and the rounding errors that it left) by error-free transformations: in a task
rows are added pairwise, tasks hand over both parts, and the parts of all tasks are merged, in several rounds where there
are many. The covariance is summed from outer products of centred vectors, so a mean far above the spread costs no
digits. Its eigenvectors come from Householder's tridiagonal form by divide and conquer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.llm.shared import stored, unused, workspace

#: Components that the query returns.
COMPONENTS = 8
#: Entries of a sum that travel together, partial sums that one task merges, and products that a task holds at once.
ENTRIES, FAN, HELD = 1 << 16, 64, 1 << 20
_EPS = np.finfo(float).eps
Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """a + b and what rounding took from it, exactly."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _quick(a: np.ndarray, b: np.ndarray) -> Pair:
    s = a + b
    return s, b - (s - a)


def _halves(a: np.ndarray) -> Pair:
    c = a * 134217729.0
    high = c - (c - a)
    return high, a - high


def two_product(a: np.ndarray, b: np.ndarray) -> Pair:
    """a * b and what rounding took from it, exactly."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def add(x: Pair, y: Pair) -> Pair:
    """The sum of two double-doubles."""
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = _quick(s, e + t)
    return _quick(s, e + f)


def total(x: Pair) -> Pair:
    """The sum over the first axis, pairwise."""
    high, low = x
    while len(high) > 1:
        half = len(high) // 2
        both = add((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        rest = slice(2 * half, None)
        high, low = np.concatenate([both[0], high[rest]]), np.concatenate([both[1], low[rest]])
    return high[0], low[0]


def compensated_sum(vectors: DataFrame, d: int, terms: Callable[[np.ndarray], Pair], m: int, within: str) -> Pair:
    """The sum over all rows of ``terms``, which gives m double-doubles for each row of a block of vectors.

    vectors: (vector array<double>), each of length d, without nulls. No rows: zeros.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, step = (np.zeros(m), np.zeros(m)), max(1, HELD // m)
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for i in range(0, len(rows), step):
                held = add(held, total(terms(rows[i : i + step])))
        blocks = range(0, m, ENTRIES)
        parts = [pa.array([x[i : i + ENTRIES].tobytes() for i in blocks], pa.binary()) for x in held]
        n, part = len(blocks), TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([part] * n, pa.int64()), *parts], ["block", "part", "high", "low"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        both = [np.stack([np.frombuffer(b) for b in pdf.sort_values("part")[c]]) for c in ("high", "low")]
        high, low = total((both[0], both[1]))
        return pd.DataFrame({"block": pdf["block"][:1], "part": pdf["group"][:1], "high": [high.tobytes()], "low": [low.tobytes()]})

    schema = "block long, part long, high binary, low binary"
    sums = stored(vectors.select("vector").mapInArrow(partial, schema), "sums", within)
    while True:
        groups = -(-((sums.agg(F.max("part")).first()[0] or 0) + 1) // FAN)
        sums = stored(sums.withColumn("group", F.col("part") % groups).groupBy("block", "group").applyInPandas(merge, schema), "sums", within)
        if groups == 1:
            break
    high, low = np.zeros(m), np.zeros(m)
    for r in sums.collect():  # a row for each block of ENTRIES
        at = slice(r["block"] * ENTRIES, r["block"] * ENTRIES + ENTRIES)
        high[at], low[at] = np.frombuffer(r["high"]), np.frombuffer(r["low"])
    return high, low


def _over(x: Pair, n: int) -> Pair:
    """A double-double divided by a whole number."""
    q = x[0] / n
    p, e = two_product(q, np.full_like(q, n))
    return _quick(q, ((x[0] - p) - e + x[1]) / n)


def centred(rows: np.ndarray, mean: Pair) -> Pair:
    s, e = two_sum(rows, -mean[0])
    return _quick(s, e - mean[1])


def covariance(vectors: DataFrame, d: int, n: int, within: str) -> tuple[Pair, Pair, np.ndarray]:
    """Sums, means and the covariance (divisor n) of n > 0 vectors of length d."""
    sums = compensated_sum(vectors, d, lambda rows: (rows, np.zeros_like(rows)), d, within)
    mean = _over(sums, n)
    i, j = np.triu_indices(d)

    def products(rows: np.ndarray) -> Pair:
        high, low = centred(rows, mean)
        ah, al = _halves(high)
        p = high[:, i] * high[:, j]
        e = ((ah[:, i] * ah[:, j] - p) + ah[:, i] * al[:, j] + al[:, i] * ah[:, j]) + al[:, i] * al[:, j]
        return _quick(p, e + (high[:, i] * low[:, j] + low[:, i] * high[:, j]))

    found = _over(compensated_sum(vectors, d, products, len(i), within), n)
    out = np.zeros((d, d))
    out[i, j] = out[j, i] = found[0] + found[1]
    return sums, mean, out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and Q with a = Q T Q', by Householder reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        scale = np.abs(x).max()
        if scale == 0 or not np.abs(x[1:]).max():
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def divide_and_conquer(diag: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors of a symmetric tridiagonal matrix: it is torn in two by a matrix of rank
    one, and the halves' solutions are joined by the roots of the secular equation."""
    n = len(diag)
    if n == 1:
        return diag.copy(), np.ones((1, 1))
    cut = n // 2
    beta = off[cut - 1]
    low, high = diag[:cut].copy(), diag[cut:].copy()
    low[-1] -= abs(beta)
    high[0] -= abs(beta)
    (w1, z1), (w2, z2) = divide_and_conquer(low, off[: cut - 1]), divide_and_conquer(high, off[cut:])
    w, vectors = np.concatenate([w1, w2]), np.zeros((n, n))
    vectors[:cut, :cut], vectors[cut:, cut:] = z1, z2
    z = np.concatenate([z1[-1], np.copysign(1.0, beta) * z2[0]])
    return _joined(w, vectors, z, abs(beta))


def _joined(w: np.ndarray, vectors: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The solution of diag(w) + rho z z', in the basis ``vectors``."""
    order = np.argsort(w, kind="stable")
    w, z, vectors = w[order], z[order] / np.linalg.norm(z), vectors[:, order]
    rho *= 2  # the norm of z was the root of two
    tol = 8 * _EPS * max(np.abs(w).max(), rho)
    kept: list[int] = []
    for j in range(len(w)):  # entries without weight, and all but one of equal values, are solved as they are
        if rho * abs(z[j]) <= tol:
            continue
        if kept:
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if abs((w[j] - w[i]) * c * s) <= tol:
                vectors[:, [i, j]] = np.stack([c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]], axis=1)
                w[i], w[j] = w[i] * c * c + w[j] * s * s, w[i] * s * s + w[j] * c * c
                z[i], z[j] = 0.0, r
                kept.pop()
        kept.append(j)
    if kept:
        k = np.array(kept)
        roots, gaps = _secular(w[k], z[k], rho)
        # Weights for which the computed roots are exact keep the vectors orthogonal.
        d, m = w[k], len(k)
        ratio = np.ones(m)
        for a in range(m - 1):
            ratio *= -gaps[a] / (np.where(np.arange(m) > a, d[a], d[a + 1]) - d)
        weight = np.copysign(np.sqrt(np.abs(ratio * -gaps[m - 1] / rho)), z[k])
        u = weight[None] / gaps
        u /= np.linalg.norm(u, axis=1)[:, None]
        w[k], vectors[:, k] = roots, vectors[:, k] @ u.T
    order = np.argsort(w, kind="stable")
    return w[order], vectors[:, order]


def _secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho sum z_j^2 / (d_j - x) = 0, one above each d, and d_j - root for each root.

    A root is sought as a distance from the nearer pole, by halving in the order of floating-point numbers: every
    distance comes out to the last bit, however small.
    """
    n, weight = len(d), rho * z * z
    gap = np.append(np.diff(d), weight.sum())
    middle = 1 + (weight / ((d[None] - d[:, None]) - (gap / 2)[:, None])).sum(axis=1)
    right = (middle < 0) & (np.arange(n) < n - 1)
    pole = d[np.arange(n) + right]
    apart = d[None] - pole[:, None]
    sign = np.where(right, -1.0, 1.0)
    top = np.where(np.arange(n) < n - 1, gap / 2, gap) * (1 + 4 * _EPS)
    low, high = np.zeros(n, np.int64), top.view(np.int64).copy()
    while (high - low > 1).any():
        mid = low + (high - low) // 2
        t = mid.view(float)
        f = 1 + (weight / (apart - (sign * t)[:, None])).sum(axis=1)
        beyond = np.where(right, f < 0, f > 0)
        low, high = np.where(beyond, low, mid), np.where(beyond, mid, high)
    t = sign * high.view(float)
    return pole + t, apart - t[:, None]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    scale = np.abs(a).max() or 1.0
    diag, off, q = tridiagonal(a / scale)
    w, z = divide_and_conquer(diag, off)
    return w[::-1] * scale, (q @ z)[:, ::-1]


class Whitening(NamedTuple):
    """n vectors with exact ``sums``; components are columns, by falling eigenvalue; ``explained`` are shares of the trace."""

    n: int
    sums: list[int | float]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty, and holds neither nulls nor values that aren't finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(~odd)


def whiten(df: DataFrame, vector: str, components: int = COMPONENTS, out: str = "whitened") -> tuple[DataFrame, Whitening]:
    """``df`` with a column ``out`` (array<double>): the centred vector in each component, over the root of its eigenvalue.

    Rows whose vector is null, empty or holds nulls or values that aren't finite are left out, and of lengths other than
    the commonest (of equally common ones the longest) too. Equal rows all count. There are no more components than the
    vectors are long. A component without variance (an eigenvalue below rounding) gives nulls; identity_error, the largest
    entry of the covariance of ``out`` minus the identity, is over the others, and null without any. No rows: no rows.
    """
    spark = df.sparkSession
    size = F.size(vector).cast("long")
    rows = usable(df.withColumn(vector, F.col(vector).cast("array<double>")), vector)
    common = rows.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).head(1)
    if not common:
        return rows.withColumn(out, F.lit(None).cast("array<double>")), Whitening(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0), None)
    d, n = common[0]["d"], common[0]["n"]
    rows = rows.filter(size == d)
    with workspace(spark, "whitening") as within:
        vectors = stored(rows.select(F.col(vector).alias("vector")), "vectors", within)
        sums, mean, v = covariance(vectors, d, n, within)
        values, basis = eigen(v)
        k = min(components, d)
        real = values[:k] > d * _EPS * max(values[0], 0.0)
        scaled = basis[:, :k] / np.sqrt(np.where(real, values[:k], 1.0))
        projected = stored(_projected(rows, vector, out, mean, scaled, real), "whitened")
        error = None
        if real.any():
            live = [c for c in range(k) if real[c]]
            seen = projected.select(F.array(*[F.col(out)[c] for c in live]).alias("vector"))
            error = float(np.abs(covariance(seen, len(live), n, within)[2] - np.eye(len(live))).max())
    whole = [int(h) + int(e) if float(h).is_integer() and float(e).is_integer() else h + e for h, e in zip(*sums, strict=True)]
    trace = np.trace(v)
    explained = values[:k] / trace if trace > 0 else np.full(k, np.nan)
    return projected, Whitening(n, whole, values[:k], basis[:, :k], explained, error)


def _projected(rows: DataFrame, vector: str, out: str, mean: Pair, scaled: np.ndarray, real: np.ndarray) -> DataFrame:
    d, k = scaled.shape

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        high, low = centred(np.stack(list(x)), mean) if len(x) else (np.zeros((0, d)), np.zeros((0, d)))
        found = high @ scaled + low @ scaled
        return pd.Series([[y if r else None for y, r in zip(row, real, strict=True)] for row in found.tolist()], dtype=object)

    return rows.withColumn(out, project(vector))


def quantised(column: str):
    """floor(1024 c) + 100000 of each entry c, as long; entries beyond 2^52 are held at it, where doubles stay exact."""
    return F.transform(column, lambda c: F.floor(F.greatest(F.least(c.cast("double") * 1024, F.lit(2.0**52)), F.lit(-(2.0**52)))) + F.lit(100000))


def deviations(df: DataFrame, vector: str, model: Whitening, out: str) -> DataFrame:
    """Adds sum((n x - S)^2) over the dimensions of a whole-number vector, exact; null where a long can't hold it."""
    (least,) = unused(df, "least")
    low, high = df.agg(F.min(F.array_min(vector)), F.max(F.array_max(vector))).first()
    if low is None:
        return df.withColumn(out, F.lit(None).cast("long"))
    fits = len(model.sums) * (model.n * (high - low)) ** 2 < 1 << 63 and model.n * max(abs(low), abs(high)) < 1 << 63
    sums = F.array(*[F.lit(s).cast("long" if fits else "decimal(38,0)") for s in model.sums])
    if fits:
        value = F.aggregate(F.zip_with(vector, sums, lambda x, s: x * F.lit(model.n).cast("long") - s), F.lit(0).cast("long"), lambda a, u: a + u * u)
    else:
        exact = F.zip_with(vector, sums, lambda x, s: (x.cast("decimal(19,0)") * F.lit(model.n).cast("decimal(18,0)")).cast("decimal(38,0)") - s)
        square = lambda u: F.try_multiply(u.try_cast("decimal(19,0)"), u.try_cast("decimal(19,0)"))
        value = F.aggregate(exact, F.lit(0).cast("decimal(38,0)"), lambda a, u: (a + square(u)).try_cast("decimal(38,0)")).try_cast("long")
    return df.withColumn(least, value).withColumn(out, F.col(least)).drop(least)


def op12_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    whole = usable(vectors, "embedding").select("vec_id", quantised("embedding").alias("x"))
    rows, model = whiten(whole, "x")
    longs = rows.withColumn("x", F.col("x").cast("array<bigint>"))
    flat = deviations(longs, "x", model, "deviation").select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.explained) else F.array().cast("array<double>")
    share = F.get(shares, F.col("at"))
    return flat.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.when(~F.isnan(share), share).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
