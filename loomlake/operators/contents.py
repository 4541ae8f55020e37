"""Whether two tables hold the same rows, by sums of row hashes over ranges of the key: only ranges that differ are read on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.functions.names import quote

#: Ranges that a range is split into, rows of a range that are compared one by one, ranges that a filter names (of more,
#: those with the least gaps are read as one), and differing ranges of a level up to which it pays to split on.
FAN, LEAF, NAMED, MOST = 64, 5000, 64, 4096


def _place(df: DataFrame, key: str) -> Column:
    """The key as a number: itself where it is one (then filters on ranges reach the scan) or a time, else its hash."""
    kind, c = df.schema[key].dataType, F.col(quote(key))
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    return F.xxhash64(c)


def _sums(df: DataFrame, by: Column) -> DataFrame:
    """(range, rows, a, b): rows and two sums of their hashes; equal rows count as often as they are there."""
    return df.groupBy(by.alias("range")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("_a").cast("decimal(38,0)")).alias("a"), F.sum(F.col("_b").cast("decimal(38,0)")).alias("b"))


def differences(left: DataFrame, right: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """(key, status, left_rows, right_rows) of the keys whose rows differ: missing (not in right), extra (not in left), repeated (other
    numbers of equal rows) or changed. columns: those that are compared, default all that both have.

    Sums are compared over FAN ranges of the key, then only the ranges that differ are read (of whole-number keys the scan
    skips the others), split again, and so on until a range has at most LEAF rows: there rows are compared. Rows whose key
    is null are compared as one key. Rows are told apart by two 64-bit hashes.
    """
    both = columns or [c for c in left.columns if c in right.columns]
    values = F.to_json(F.struct(*[F.col(quote(c)).alias(c) for c in both if c != key]), {"ignoreNullFields": "false"}) if [c for c in both if c != key] else F.lit("")
    sides = [df.select(F.col(quote(key)).alias("key"), _place(df, key).alias("_k"), F.xxhash64(F.col(quote(key)).cast("string"), values).alias("_a"), F.xxhash64(values, F.lit(7)).alias("_b")) for df in (left, right)]
    ends = [s.agg(F.min("_k").alias("lo"), F.max("_k").alias("hi")).head() for s in sides]
    known = [e for e in ends if e["lo"] is not None]
    leaves: list[tuple[int, int]] = []
    if known:
        start, end = min(e["lo"] for e in known), max(e["hi"] for e in known) + 1
        ranges, wide = [(start, end)], -(-(end - start) // FAN)
        while ranges:
            offset = f"(CAST(_k AS DECIMAL(20,0)) - {start}BD)"
            place = F.expr(f"{offset} - {offset} % {wide}BD")  # where the key's range begins, from the start
            x, y = (_sums(s.filter(_within(ranges)), place) for s in sides)
            differ = ~(x["rows"].eqNullSafe(y["rows"]) & x["a"].eqNullSafe(y["a"]) & x["b"].eqNullSafe(y["b"]))
            joined = x.join(y, x["range"] == y["range"], "full_outer").filter(differ)
            found = joined.select(F.coalesce(x["range"], y["range"]).alias("at"), F.greatest(x["rows"], y["rows"]).alias("n")).limit(MOST + 1).collect()
            if len(found) > MOST:  # little would be skipped: what is left is compared row by row
                leaves += ranges
                break
            split = [(start + int(r["at"]), start + int(r["at"]) + wide, r["n"]) for r in found]
            leaves += [(lo, hi) for lo, hi, n in split if n <= LEAF or wide == 1]
            ranges, wide = [(lo, hi) for lo, hi, n in split if n > LEAF and wide > 1], -(-wide // FAN)
    where = F.col("_k").isNull() | _within(leaves)
    x, y = (s.filter(where).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_a", "_b").alias("kinds"), F.sum(F.col("_a").cast("decimal(38,0)")).alias("a"), F.sum(F.col("_b").cast("decimal(38,0)")).alias("b"), F.min(F.struct("_a", "_b")).alias("first"), F.max(F.struct("_a", "_b")).alias("last")) for s in sides)
    joined = x.alias("x").join(y.alias("y"), F.expr("x.key <=> y.key"), "full_outer")
    there = joined.filter("NOT (x.n <=> y.n AND x.a <=> y.a AND x.b <=> y.b)")
    alike = F.expr("x.kinds = y.kinds AND x.first = y.first AND x.last = y.last AND x.kinds <= 2")
    status = F.when(F.expr("y.n IS NULL"), "missing").when(F.expr("x.n IS NULL"), "extra").when(alike, "repeated").otherwise("changed")
    return there.select(F.expr("CASE WHEN x.n IS NULL THEN y.key ELSE x.key END").alias("key"), status.alias("status"), F.expr("coalesce(x.n, 0)").alias("left_rows"), F.expr("coalesce(y.n, 0)").alias("right_rows"))


def _within(ranges: list[tuple[int, int]]) -> Column:
    where = F.lit(False)
    for lo, hi in _named(ranges):
        where = where | ((F.col("_k") >= lo) & (F.col("_k") <= min(hi, 1 << 63) - 1))
    return where


def _named(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges to be read: neighbours in one, and where there are more than NAMED the ones between the widest gaps."""
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    while len(out) > NAMED:
        i = min(range(len(out) - 1), key=lambda j: out[j + 1][0] - out[j][1])
        out[i : i + 2] = [[out[i][0], out[i + 1][1]]]
    return [(lo, hi) for lo, hi in out]
