"""Chat formatting with cumulative-snapshot collapse.

A log often holds a conversation several times, each time with the turns so far. Every turn gets the
rolling hash of its conversation up to it; a conversation whose whole hash is a proper prefix's hash of
another is a snapshot of that one and is left out, by an anti-join. Of equal conversations the one with
the smallest id stays. What remains is rendered with one template.

Rolling hashes are running sums of hashes of (position, role, text), so that a conversation of any
length can be summed in pieces: turns are range-partitioned, summed within each partition, and
shifted by the sums of the earlier partitions. Conversations are rendered in parts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

#: Turns of a rendered part.
PART_TURNS = 64


def _running(rows: DataFrame, new: dict[str, Column], order: list) -> DataFrame:
    """Adds running sums along a conversation; rows have `piece`, the range partition they are in."""
    inside = Window.partitionBy("piece", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(c).over(inside).alias(f"_{n}") for n, c in new.items()])
    # A conversation has one row per partition that it lies in.
    pieces = rows.groupBy("conv_id", "piece").agg(*[F.sum(c).alias(f"_p_{n}") for n, c in new.items()])
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"),
        *[F.coalesce(F.sum(f"_p_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in new],
    )
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    joined = local.join(shifts, on)
    return joined.select(*rows.columns, *[(F.col(f"_{n}") + F.col(f"_s_{n}")).alias(n) for n in new])


def _hash(seed: int) -> Column:
    """48 bits of a turn at its position; their sums are exact decimals."""
    return F.pmod(F.xxhash64(F.lit(seed), "pos", "role", "text"), F.lit((1 << 48) - 59))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, piece, h1, h2): position from 1, and the hash of all turns up to it.

    Turns are ordered by turn, then role and text; null turns come first, null roles and texts are
    empty. Repeated rows are turns of their own. A null conv_id is a conversation like any other.
    """
    spark = turns.sparkSession
    order = ["turn", "role", "text"]
    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range partitions cut the longest conversation; the next step must see the same cuts.
    dealt = own.repartitionByRange(n, "conv_id", *order).withColumn("piece", F.spark_partition_id())
    placed = _running(materialise(dealt, "turns"), {"pos": F.lit(1)}, order)
    placed = materialise(placed.select("conv_id", "turn", "role", "text", "piece", "pos"), "turn-positions")
    sums = {f"h{i}": _hash(i).cast("decimal(38,0)") for i in (1, 2)}
    return _running(placed, sums, ["pos"]).drop("turn")


def maximal(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, pos, role, text) of conversations that are no snapshot of a longer or equal one."""
    hashed = materialise(prefix_hashes(turns).drop("piece"), "turn-prefixes")
    length = hashed.groupBy("conv_id").agg(F.max("pos").alias("n"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    ends = hashed.join(length.withColumnRenamed("conv_id", "_c"), same("conv_id", "_c"))
    whole = ends.filter("pos = n").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    inner = ends.filter("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    # Both sides have each hash once: no conversation, however often logged, is a hot key.
    kept = whole.join(inner, ["n", "h1", "h2"], "left_anti").select(F.col("conv_id").alias("_c"))
    return hashed.join(kept, same("conv_id", "_c"), "left_semi").select("conv_id", "pos", "role", "text")


def render(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, n_turns, text): the parts of a conversation, in order, are its rendering.

    A turn is `<|role|>`, a line end, its text and `<|end|>`, and a line end.
    """
    line = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("<|end|>\n"))
    part = F.floor((F.col("pos") - 1) / part_turns).alias("part")
    lines = turns.select("conv_id", part, F.struct("pos", line.alias("line")).alias("l"))
    collected = lines.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("l")).alias("l"))
    return collected.select(
        "conv_id", "part", F.size("l").cast("long").alias("n_turns"), F.array_join("l.line", "").alias("text")
    )


def format_chats(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rendered maximal conversations; an empty table gives an empty result."""
    return render(maximal(turns), part_turns)
