"""Exact and near de-duplication; the first document in corpus order stays."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions.hashing import doc_hash, hamming, low_md5
from corpusloom.functions.text import simhash_tokens, token_chunks
from corpusloom.session import broadcast_if_small, materialise

# Distinct signatures that may be compared pairwise inside one bucket.
BUCKET_ROWS = 512
# Flipped values per signature up to which crowded buckets are solved by flips.
FLIPS = 1_000


def keep_ords(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of df whose `ord` is in `kept`.

    `ord` is unique, so the shuffle is even. Only 8-byte keys are hashed on the
    build side; the documents stream past without being sorted.
    """
    return df.join(kept.select("ord").hint("shuffle_hash"), "ord", "left_semi")


def first_of_copies(df: DataFrame) -> DataFrame:
    """(ord, copies) of the first document of every distinct text.

    Only digest and key are shuffled, after map-side aggregation, so a text with
    millions of copies costs one row per map task.
    """
    return (
        df.select("ord", doc_hash(F.col("text")).alias("digest"))
        .groupBy("digest")
        .agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("copies"))
        .select("ord", "copies")
    )


def dedup_exact(df: DataFrame) -> DataFrame:
    """Keep the first row of every distinct text, all columns."""
    return keep_ords(df, first_of_copies(df))


def dedup_parsed(parsed: DataFrame) -> DataFrame:
    """The same on parsed lines: rows with text are grouped, MALFORMED rows pass
    through one by one, BAD_JSON rows are dropped.

    Pass a stage table: filters on a computed status would repeat the parsing.
    """
    with_text = parsed.filter(F.col("status").isin("OK", "EMPTY"))
    malformed = parsed.filter(F.col("status") == "MALFORMED").select("ord")
    return keep_ords(parsed, first_of_copies(with_text).select("ord").union(malformed))


def dedup_counts(df: DataFrame) -> DataFrame:
    """One row: kept, dropped."""
    kept = F.count(F.lit(1))
    return first_of_copies(df).agg(
        kept.alias("kept"), (F.coalesce(F.sum("copies"), F.lit(0)) - kept).alias("dropped")
    )


def simhash(df: DataFrame) -> DataFrame:
    """(ord, sig): 64-bit SimHash over disjoint chunks of 8 tokens.

    A bit is set when more than half of the chunk hashes have it. Two counters
    share one BIGINT (bits j and j + 32, 32 bits each: a text of at most 2 GiB
    cannot overflow them), so 32 sums replace 64; the chunks of a document are
    summed in the task that reads it and only the sums are shuffled.
    """
    # Hashed inside the array, so that each digest is computed once, not per sum.
    hashes = F.transform(token_chunks(simhash_tokens(F.col("text"))), low_md5)
    hashed = df.select("ord", F.explode_outer(hashes).alias("h"))
    lanes = F.lit(0x0000000100000001)
    sums = hashed.groupBy("ord").agg(
        F.count("h").alias("n"),
        *[
            F.sum(F.shiftrightunsigned("h", j).bitwiseAND(lanes)).alias(f"c{j}")
            for j in range(32)
        ],
    )
    sig = F.lit(0).cast("bigint")
    for j in range(32):
        low = F.col(f"c{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"c{j}", 32)
        top = F.lit(-(1 << 63) if j == 31 else 1 << (j + 32))
        zero = F.lit(0).cast("bigint")
        sig = sig.bitwiseOR(
            F.when(low * 2 > F.col("n"), F.lit(1 << j).cast("bigint")).otherwise(zero)
        ).bitwiseOR(F.when(high * 2 > F.col("n"), top.cast("bigint")).otherwise(zero))
    return sums.select("ord", sig.alias("sig"))


def distinct_signatures(signatures: DataFrame) -> DataFrame:
    """(sig, ord of its first document, docs)."""
    return signatures.groupBy("sig").agg(
        F.min("ord").alias("ord"), F.count(F.lit(1)).alias("docs")
    )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _narrower(mask: int, parts: int) -> list[int]:
    """Add to the bits of `mask` each of `parts` even groups of the other bits.

    Empty when fewer than `parts` bits are left: then a bucket holds at most
    2 ** (parts - 1) distinct signatures, all within the threshold.
    """
    rest = [b for b in range(64) if not mask >> b & 1]
    if len(rest) < parts:
        return []
    cuts = [len(rest) * i // parts for i in range(parts + 1)]
    return [
        mask | sum(1 << b for b in rest[lo:hi]) for lo, hi in zip(cuts, cuts[1:])
    ]


def _flips(mask: int, most: int) -> list[int]:
    """Every way to flip at most `most` of the bits outside of `mask`."""
    free = [1 << b for b in range(64) if not mask >> b & 1]
    return [sum(c) for k in range(most + 1) for c in combinations(free, k)]


def _flip_count(mask: int, threshold: int) -> int:
    free = 64 - mask.bit_count()
    halves = (threshold - threshold // 2, threshold // 2)
    return sum(comb(free, k) for most in halves for k in range(most + 1))


def _pairs_within(left: DataFrame, right: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Join two copies of (keys, ord, sig) and keep the near pairs."""
    a = left.select(*keys, F.col("ord").alias("ord_a"), F.col("sig").alias("sig_a"))
    b = right.select(*keys, F.col("ord").alias("ord_b"), F.col("sig").alias("sig_b"))
    distance = hamming(F.col("sig_a"), F.col("sig_b"))
    return (
        a.join(b, keys)
        .filter((F.col("ord_a") < F.col("ord_b")) & (distance <= threshold))
        .select("ord_a", "ord_b", distance.cast("bigint").alias("distance"))
    )


def _meet_halfway(rows: DataFrame, masks: list[int], threshold: int) -> DataFrame:
    """Near pairs inside crowded buckets, however crowded.

    Two signatures at most t bits apart have a value in the middle, half of the
    flips from either. Each row lists the values within half the distance and the
    pairs meet by equality. A value has a bounded number of neighbours, so no key
    is hot, whatever the data.
    """

    def reach(most: int) -> DataFrame:
        steps = [(_signed(m), [_signed(f) for f in _flips(m, most)]) for m in masks]
        table = rows.sparkSession.createDataFrame(steps, "mask bigint, flips array<bigint>")
        near = rows.join(F.broadcast(table), "mask")  # a constant of the threshold
        return near.select("mask", "ord", "sig", F.explode("flips").alias("flip")).select(
            "mask", "ord", "sig", F.col("sig").bitwiseXOR(F.col("flip")).alias("middle")
        )

    far, near = threshold - threshold // 2, threshold // 2
    return _pairs_within(reach(far), reach(near), ["mask", "middle"], threshold)


def near_pairs(
    distinct: DataFrame,
    threshold: int = fx.HAMMING_THRESHOLD,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Pairs of distinct signatures at most `threshold` bits apart.

    threshold + 1 bands: such a pair agrees on at least one whole band, so
    signatures meet by an equality join on (band, bits). A bucket that is too
    full is not compared but cut into threshold + 1 finer bands of the bits it
    does not fix yet, by the same argument; what stays crowded when few enough
    bits are free is solved by `_meet_halfway`. No candidate is dropped. At the
    default threshold that is at most two levels; a wide threshold costs far
    more on crowded data, as its bands are short.
    """
    parts, masks = threshold + 1, _narrower(0, threshold + 1)
    nodes = distinct.select("ord", "sig")
    rows = nodes.withColumn("mask", F.explode(F.lit([_signed(m) for m in masks])))
    rows = rows.withColumn("bits", F.col("sig").bitwiseAND(F.col("mask")))
    buckets = halfway = None
    while True:
        crowded = materialise(
            rows.groupBy("mask", "bits").count()
            .filter(F.col("count") > bucket_rows).select("mask", "bits"),
            "crowded",
        )
        finer = [(m, n) for m in masks for n in _narrower(m, parts)]
        done = crowded.isEmpty() or not finer
        hot = broadcast_if_small(crowded)
        ready = rows if done else rows.join(hot, ["mask", "bits"], "left_anti")
        buckets = ready if buckets is None else buckets.unionByName(ready)
        if done:
            break
        crowd = rows.join(hot, ["mask", "bits"], "left_semi")
        if max(_flip_count(m, threshold) for m in masks) <= FLIPS:
            halfway = _meet_halfway(crowd, masks, threshold)
            break
        step = distinct.sparkSession.createDataFrame(
            [(_signed(m), _signed(n)) for m, n in finer], "mask bigint, finer bigint"
        )
        rows = (
            crowd.join(F.broadcast(step), "mask")  # a constant of the threshold and level
            .select("ord", "sig", F.col("finer").alias("mask"))
            .withColumn("bits", F.col("sig").bitwiseAND(F.col("mask")))
        )
        masks = [n for _, n in finer]
    pairs = _pairs_within(buckets, buckets, ["mask", "bits"], threshold)
    return (pairs if halfway is None else pairs.unionByName(halfway)).distinct()


def _dropped_signatures(pairs: DataFrame) -> DataFrame:
    """Nodes that the in-order scan drops, given all near pairs (ord_a < ord_b).

    Round by round: a node no open pair points to is kept, its later neighbours
    are dropped, and all their pairs are closed. The kept nodes are the
    first-in-order maximal independent set, which is what the scan selects.
    """
    open_pairs = materialise(pairs.select("ord_a", "ord_b"), "pairs")
    dropped = None
    while not open_pairs.isEmpty():
        later = open_pairs.select(F.col("ord_b").alias("ord_a")).distinct()
        kept = open_pairs.select("ord_a").distinct().join(later, "ord_a", "left_anti")
        gone = materialise(
            open_pairs.join(kept, "ord_a", "left_semi").select("ord_b").distinct(),
            "dropped",
        )
        gone_a = gone.withColumnRenamed("ord_b", "ord_a")
        open_pairs = materialise(
            open_pairs.join(gone, "ord_b", "left_anti").join(gone_a, "ord_a", "left_anti"),
            "pairs",
        )
        dropped = gone if dropped is None else dropped.union(gone)
    if dropped is None:
        dropped = open_pairs.select("ord_b")
    return dropped.select(F.col("ord_b").alias("ord"))


def near_kept(signatures: DataFrame, threshold: int = fx.HAMMING_THRESHOLD) -> DataFrame:
    """`ord` of the documents the in-order near-duplicate scan keeps."""
    distinct = materialise(distinct_signatures(signatures), "signatures")
    dropped = _dropped_signatures(near_pairs(distinct, threshold))
    return distinct.select("ord").join(dropped, "ord", "left_anti")


def dedup_near(df: DataFrame, threshold: int = fx.HAMMING_THRESHOLD) -> DataFrame:
    """Drop every document near an earlier kept one, all columns."""
    return keep_ords(df, near_kept(simhash(df), threshold))
