"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents, shuffled by a hash. A queue is served in proportion to its
target: the virtual finish time of a document is the number of words its source has sent by then, over
the source's target. Sources smaller than their target are sent again, up to a number of repeats. All
queues are merged by one global range sort on the finish time, and the merged stream is truncated at
the total budget. As in a network, what is queued is a packet: documents above `packet` words are sent
as several, so that no long document delays the others or moves its source off the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise
from corpusloom.llm.ranges import running_totals

#: Weights by rank of a source, times that a document may be taken, per cent of all words to take.
WEIGHTS, REPEATS, SHARE = (1, 2, 3), 3, 100
#: Words of a packet.
PACKET = 1024
SEED = "2024"

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def n_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    one_space = F.translate(text, _SPACE, " " * len(_SPACE))
    return F.coalesce(F.size(F.array_remove(F.split(one_space, " "), "")), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row, written; other columns are left behind."""
    text = F.col("text").cast("string")
    size = F.when(text.isNull(), F.lit(0)).otherwise(n_words(text)).cast("long")
    return materialise(
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size")), "sizes"
    )


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: int = SHARE
) -> tuple[DataFrame, int]:
    """(source, rank, source_size, sent_before, target) and the budget in words.

    Sources in code point order, null last, get the weights in turn. Targets share the budget by weight,
    but stop at `repeats` times the source; what is above goes to the others by weight, until none is
    above. In order of size over weight the sources that stop come first: a source stops if its limit
    is not above what is left, shared by what weight is left.
    """
    each = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_name = [F.col("source").asc_nulls_last()]
    ranked = running_totals(each.withColumn("one", F.lit(1)), by_name, {"one": "rank", "source_size": "sent_before"}, "ranks")
    turn = F.get(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))).cast("int"))
    ranked = materialise(
        ranked.withColumn("weight", turn.cast("long")).withColumn("limit", F.col("source_size") * repeats).drop("one"),
        "ranked",
    )
    words, weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    budget = words * share // 100
    lean = [(F.col("limit") / F.col("weight")).asc(), F.col("rank").asc()]
    filled = running_totals(ranked, lean, {"limit": "limit_before", "weight": "weight_before"}, "filled")
    # Products in doubles: limits of a whole corpus times weights may pass a long.
    left_words = F.lit(budget).cast("double") - F.col("limit_before")
    left_weight = F.lit(weight).cast("double") - F.col("weight_before")
    stops = F.col("limit") * left_weight <= F.col("weight") * left_words
    filled = materialise(filled.withColumn("stops", stops), "stops")
    stopped, stopped_weight = filled.filter("stops").agg(
        F.coalesce(F.sum("limit"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    by_weight = F.col("weight") * F.lit(float(budget - stopped)) / F.lit(float(max(weight - stopped_weight, 1)))
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(by_weight)
    return filled.select("source", "rank", "source_size", "sent_before", target.alias("target")), budget


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: int = SHARE,
    packet: int = PACKET, seed: str = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of (doc_id, text, source).

    taken: words that the mix takes of a document, at most `repeats` times its size; their sum is the
    budget. Only a document at the cut is taken in part, by whole packets, and one packet of all in part.

    Null or empty texts have size 0 and are taken 0 times; a null source is a source, the last one; a null
    doc_id is a document like any other. Repeated rows are documents of their own. Ties in the shuffle go
    to the smaller id (null first), then the smaller size. An empty table gives an empty result. Columns
    of other names take no part, whatever they are called.
    """
    sized = sizes(docs)
    table, budget = source_targets(sized, weights, repeats, share)
    table = materialise(table, "targets")
    # Few sources travel to the tasks; many shuffle, and adaptive execution splits a hot one.
    known = sized.join(table, sized["source"].eqNullSafe(table["source"])).select(
        "doc_id", sized["source"], "size", "rank", "source_size", "sent_before", "target",
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("dealt"),
    )
    known = materialise(known, "shuffled")
    shuffled = [F.col(c).asc() for c in ("rank", "dealt", "doc_id", "size")]
    queued = materialise(running_totals(known, shuffled, {"size": "place"}, "queues"), "queued")
    # place: words of all documents before this one, so unique among documents that have words.
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / packet)))
    packets = queued.filter("size > 0").select(
        "place", "rank", "size", "target", "source_size", (F.col("place") - F.col("sent_before")).alias("sent"),
        parts.alias("part"),
    ).select("*", F.explode(F.array(*[F.lit(i).cast("long") for i in range(repeats)])).alias("turn"))
    end = F.least((F.col("part") + 1) * packet, F.col("size"))
    sent = F.col("turn") * F.col("source_size") + F.col("sent") + end
    packets = materialise(
        packets.filter("target > 0").select(
            "place", "part", "turn", "rank", (end - F.col("part") * packet).alias("words"),
            (sent.cast("double") / F.col("target")).alias("finish"),
        ),
        "packets",
    )
    merged = [F.col(c).asc() for c in ("finish", "rank", "turn", "place", "part")]
    stream = running_totals(packets, merged, {"words": "before"}, "stream")
    served = stream.filter(F.col("before") < budget).groupBy("place").agg(
        F.sum(F.least("words", F.lit(budget) - F.col("before"))).alias("served")
    )
    # Documents without words meet nothing, each under a key of its own.
    key = F.when(F.col("size") > 0, F.col("place")).otherwise(-1 - F.abs(F.xxhash64("doc_id", "dealt") % (1 << 62)))
    out = queued.withColumn("key", key).join(served.withColumnRenamed("place", "key"), "key", "left")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("served", F.lit(0)).cast("long").alias("taken")
    )
