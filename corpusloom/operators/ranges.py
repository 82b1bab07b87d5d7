"""Running totals over a whole table in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialise


def running_totals(rows: DataFrame, order: list[Column], values: dict[str, str], name: str) -> DataFrame:
    """Adds, per column of `values`, its sum over all rows that come earlier in `order`, 0 for the first.

    values: column to add up -> column of the result. Rows are range-partitioned by `order` and written;
    the totals of the ranges, one row each, are added up, and each range goes on from its own offset. So
    no task sees more than a range, however few groups the order has. `order` should be total: rows that
    are equal in it share a range and come in any order. `rows` is evaluated twice (ranges are sampled),
    so it should be a written table. An empty table gives an empty table.
    """
    # Ids of the ranges rise with the order; writing them fixes what was sampled.
    dealt = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = materialise(dealt, name)
    totals = dealt.groupBy("_range").agg(*[F.sum(v).alias(f"_{to}") for v, to in values.items()])
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        F.col("_range"), *[F.coalesce(F.sum(f"_{to}").over(ranges), F.lit(0)).alias(f"_{to}") for to in values.values()]
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    both = dealt.join(F.broadcast(ahead), "_range")
    sums = [
        (F.col(f"_{to}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).cast("long").alias(to)
        for v, to in values.items()
    ]
    return both.select(*rows.columns, *sums)
