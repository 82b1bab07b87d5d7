"""SimHash near-dedup by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most d bits share at least 8 - d of their 8 positional bytes.
The index therefore lists fingerprints under sets of positional bytes: the eight positions form d + 2
groups, and a pair within d bits agrees on at least two whole groups, so it meets in the list of such
a pair of groups. For each pair that meets, the positional bytes it shares are tallied; pairs below
the guaranteed minimum are dropped, and the others are verified by their differing bits. (Lists of
single bytes would have 256 keys per position, and pairs would grow with the square of the input.)

Lists longer than a bound are not compared pairwise: their fingerprints are linked through
the values halfway between them, which finds the same links at a fixed number of rows each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise
from corpusloom.llm.components import components

#: Words of a shingle, differing bits of a link, and fingerprints of a list that are compared in pairs.
SHINGLE, MAX_BITS, LIST_PAIRS = 3, 2, 200


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(joined)]
    one = xxhash.xxh64_digest
    set_bits = np.zeros(64, np.int64)
    for first in range(0, len(starts), 1 << 15):
        part = slice(first, first + (1 << 15))
        hashes = b"".join([one(joined[a:b], 42) for a, b in zip(starts[part], ends[part])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        set_bits += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): signed 64-bit fingerprints of whole texts; 0 without words or for null.

    text_key is a hash of id and text, under which equal rows meet.
    """

    def run(batches):
        for batch in batches:
            values = np.array([simhash(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "fp"])

    keyed = id_text(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("text_key"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_key long, fp long")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _byte_groups(max_bits: int) -> list[list[int]]:
    """The eight byte positions in max_bits + 2 groups."""
    n = max_bits + 2
    return [[p for p in range(8) if p * n // 8 == g] for g in range(n)]


def _shared_bytes(a: str, b: str) -> Column:
    differ = F.col(a).bitwiseXOR(F.col(b))
    same = [F.shiftrightunsigned(differ, 8 * p).bitwiseAND(F.lit(255)) == 0 for p in range(8)]
    return sum((s.cast("int") for s in same), F.lit(0))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, list_pairs: int = LIST_PAIRS) -> DataFrame:
    """Edges (u, v) between fingerprints: their components are those of `at most max_bits differ`.

    distinct: (fp), no repeats. Edges join fingerprints that link, and, for long lists, fingerprints
    with values halfway to a link; such a value joins only fingerprints that link.
    """
    if not 0 <= max_bits <= 6:
        raise ValueError("the eight bytes allow 0 to 6 differing bits")
    groups = _byte_groups(max_bits)
    masks = [
        (i, sum(0xFF << (8 * p) for g in pair for p in groups[g]))
        for i, pair in enumerate(combinations(range(len(groups)), 2))
    ]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    lists = F.array(*[
        F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bytes")) for i, m in masks
    ])
    index = distinct.select("fp", F.explode(lists).alias("l")).select("l.g", "l.bytes", "fp")
    sizes = index.groupBy("g", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    index = materialise(index.join(sizes, ["g", "bytes"]), "byte-index")
    short = index.filter(F.col("n") <= list_pairs)
    pairs = short.select("g", "bytes", F.col("fp").alias("u")).join(
        short.select("g", "bytes", F.col("fp").alias("v")), ["g", "bytes"]
    )
    near = (
        pairs.filter("u < v")
        .filter(_shared_bytes("u", "v") >= 8 - max_bits)
        .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
        .select(F.struct(F.lit(0).alias("half"), F.col("u").alias("fp")).alias("u"),
                F.struct(F.lit(0).alias("half"), F.col("v").alias("fp")).alias("v"))
    )
    crowded = index.filter(F.col("n") > list_pairs).select("fp").distinct()
    return near.distinct().union(_halfway(crowded, max_bits))


def _halfway(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Edges from each fingerprint to all values within half the distance (rounded up for one side)."""
    if max_bits % 2:
        raise ValueError("halfway values need an even number of bits")
    flips = [0]
    for k in range(1, max_bits // 2 + 1):
        flips += [sum(1 << b for b in c) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >> 63 else m for m in flips]
    values = F.explode(F.array(*[F.lit(m) for m in signed])).alias("flip")
    each = crowded.select("fp", values).withColumn("mid", F.col("fp").bitwiseXOR(F.col("flip")))
    shared = each.groupBy("mid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mid")
    return each.join(shared, "mid").select(
        F.struct(F.lit(0).alias("half"), F.col("fp").alias("fp")).alias("u"),
        F.struct(F.lit(1).alias("half"), F.col("mid").alias("fp")).alias("v"),
    )


def near_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id): one row per input row.

    component_id is the smallest doc_id that the document reaches by links, itself included; null ids
    are never the smallest, unless a component has no other. root names the component. Texts without
    words all have fingerprint 0 and link like any other; equal texts and repeated rows share one.
    """
    marked = materialise(fingerprints(docs, shingle), "simhash")
    ids = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    node = F.struct(F.lit(0).alias("half"), F.col("fp"))
    ids = materialise(ids, "simhash-distinct")
    found = components(links(ids.select("fp"), max_bits))
    rooted = ids.withColumn("u", node).join(found, "u", "left").select(
        "fp", "least", F.coalesce(F.col("root"), F.col("u")).alias("root")
    )
    rooted = materialise(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return marked.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")
