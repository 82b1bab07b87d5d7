"""First-n, random-n and top-n reports that stay cheap on large tables.

An ordered limit keeps n whole rows per partition and merges all of them in one
task, which for n in the thousands and 100,000 partitions is far too much. Here
a few narrow counting passes over the key alone find a bound that about n rows
satisfy; only those rows are then ordered. The result is the exact top n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import uniform_key

_BINS = 1024
# Tables up to this size are ordered directly.
DIRECT_ROWS = 200_000


def _upper_bound(keys: DataFrame, n: int, slack: int, direct_rows: int) -> int | None:
    """A value that at least n keys do not exceed, and few more than n + slack."""
    low, high, total = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
    if total <= max(n, direct_rows):
        return None
    below = 0  # keys smaller than `low`
    while low < high:
        width = max(1, -(-(high - low + 1) // _BINS))
        bins = (
            keys.filter(F.col("k").between(low, high))
            .groupBy(F.expr(f"(k - ({low})) div {width}").alias("b"))
            .count()
            .orderBy("b")
            .collect()  # at most 1,024 rows
        )
        for b, count in bins:
            if below + count >= n:
                break
            below += count
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)
        if below + count <= n + slack:
            break
    return high


def smallest_n(
    df: DataFrame,
    key: Column,
    n: int,
    ties: list[Column] | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """The n rows with the smallest integer key, ties broken by further columns.

    Rows with a null key come last.
    """
    keyed = df.withColumn("_k", key)
    bound = _upper_bound(
        keyed.select(F.col("_k").alias("k")), n, max(n, 1000), direct_rows
    )
    if bound is not None:
        keyed = keyed.filter(F.col("_k") <= F.lit(bound))
    return keyed.orderBy(F.col("_k").asc_nulls_last(), *(ties or [])).limit(n).drop("_k")


def first_n(df: DataFrame, n: int, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """First n rows in corpus order."""
    return smallest_n(df, F.col("ord"), n, direct_rows=direct_rows)


def sample_n(
    df: DataFrame, n: int, seed: int = 7, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Exactly n pseudo-random rows (all rows when there are fewer).

    Deterministic for a seed and independent of the partitioning.
    """
    return smallest_n(
        df, uniform_key(F.col("ord"), seed), n, [F.col("ord")], direct_rows
    )


def longest_docs(
    df: DataFrame, n: int = 5, shown: int = 2000, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Longest documents; equal lengths in descending text order."""
    top = smallest_n(
        df.select("ord", "text"), -F.length("text"), n,
        [F.desc("text"), F.col("ord")], direct_rows,
    )
    return top.select(
        "ord",
        F.length("text").cast("bigint").alias("n_chars"),
        F.substring("text", 1, shown).alias("shown"),
    )
