"""Set comparisons, lookups and joins that the platform's bookkeeping needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, status): present, missing (only expected) or orphan (only actual)."""
    e = expected.select(key).distinct().withColumn("_e", F.lit(True))
    a = actual.select(key).distinct().withColumn("_a", F.lit(True))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "orphan").otherwise("present")
    return e.join(a, key, "full_outer").select(key, status.alias("status"))


def union_ids(*sides: DataFrame) -> DataFrame:
    out = sides[0]
    for s in sides[1:]:
        out = out.union(s)
    return out.distinct()


def either_key_join(left: DataFrame, right: DataFrame, first: str, second: str) -> DataFrame:
    """Left join where ``first`` is equal, or where the right side has no ``first`` and ``second`` is equal: two equal
    joins instead of an OR, so that neither becomes a nested loop. Right columns other than the keys come back."""
    rest = [c for c in right.columns if c not in (first, second)]
    by_first = right.filter(F.col(first).isNotNull()).select(first, *[F.col(c).alias(f"_a_{c}") for c in rest], F.lit(True).alias("_a"))
    by_second = right.filter(F.col(first).isNull()).select(second, *[F.col(c).alias(f"_b_{c}") for c in rest])
    joined = left.join(by_first, first, "left").join(by_second, second, "left")
    return joined.select(*left.columns, *[F.when(F.col("_a"), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in rest])


def any_column_join(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``left`` with rows of ``right`` whose ``key`` is any of the left ``columns``; each pair once."""
    keyed = left.withColumn("_key", F.explode(F.array_distinct(F.array(*columns))))
    return keyed.join(right, keyed["_key"] == right[key]).drop("_key")


def ranked(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Sorted by the place of ``key`` in a list, others last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), key)
    return df.orderBy(F.when(place == 0, len(order) + 1).otherwise(place), key)


def clamp_limit(n: int, most: int) -> int:
    return max(1, min(n, most))
