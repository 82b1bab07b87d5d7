"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

A window of an item is a set of word shingles. Shingles are ordered by rarity in the documents; since a
window must occur whole, its prefix is one shingle, the rarest. Documents are joined on these prefix
shingles only. Position and length bounds follow from where the shingle stands in window and document,
and each candidate is verified word by word over the item-sized window.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise
from corpusloom.session import broadcast_if_small

#: Words of a window and of a shingle; windows whose keys are sent to every executor at once.
WINDOW, SHINGLE, BLOCK_WINDOWS = 13, 3, 100_000

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """Lower-cases A-Z and takes runs of digits, letters and all that is not ASCII. Null has no words."""
    # lower() also changes other letters, so it serves only where there are none.
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), _SEPARATORS), "")


def _shingles(words: Column, size: int) -> Column:
    """The words from each position on, as an array of structs; short at the end."""
    later = [F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0))) for i in range(1, size)]
    return F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate([words, *later])])


def _exploded(rows: DataFrame, size: int) -> DataFrame:
    """Adds pos and key of every whole shingle to rows with `words`."""
    every = rows.select("*", F.posexplode(_shingles(F.col("words"), size)).alias("pos", "shingle"))
    whole = F.col("pos") <= F.size("words") - size
    key = F.xxhash64(*[F.col(f"shingle.{i}") for i in [f"w{j}" for j in range(size)]])
    return every.filter(whole).withColumn("key", key).drop("shingle")


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (w, words, size) and which items have them (w, item_id); size: words of a shingle."""
    words = items.select(F.col("item_id"), word_list(F.col("text").cast("string")).alias("all")).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    each = words.select("item_id", "all", F.explode(starts).alias("i")).select(
        "item_id", F.slice("all", F.col("i"), window).alias("words")
    )
    each = materialise(each, "item-windows")
    distinct = each.select("words").distinct().withColumn("w", F.monotonically_increasing_id())
    distinct = materialise(
        distinct.withColumn("size", F.least(F.size("words"), F.lit(shingle))), "distinct-windows"
    )
    return distinct, each.join(distinct, "words").select("w", "item_id").distinct()


def _blocks(table: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """Parts of about `rows` rows by a hash of the key, so that any of them can be broadcast."""
    n = max(1, math.ceil(table.count() / rows))
    part = F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(n))
    return [table.filter(part == i) for i in range(n)]


def rarest_shingles(docs: DataFrame, windows: DataFrame, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(w, words, key, off): each window with its rarest shingle and where it starts there.

    Counts are over all documents; ties go to the smaller hash. A window of which some shingle occurs in
    no document cannot occur and is left out. docs: (words, ...).
    """
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most SHINGLE values
    found = None
    for size in sizes:
        own = _exploded(windows.filter(F.col("size") == size), size)
        counts = None
        for part in _blocks(own.select("key").distinct(), "key", 4 * block):
            hits = _exploded(docs.select("words"), size).select("key").join(F.broadcast(part), "key")
            n = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            counts = n if counts is None else counts.union(n)
        rated = own.join(counts, "key", "left")
        first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", F.col("pos").alias("off")))
        best = rated.groupBy("w").agg(first.alias("best")).filter("best.n > 0")
        best = best.join(windows, "w").select("w", "words", "size", "best.key", "best.off")
        found = best if found is None else found.union(best)
    return found if found is not None else windows.selectExpr("w", "words", "size", "0L AS key", "0 AS off")


def find_windows(docs: DataFrame, prefixes: DataFrame, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, text_key, w, start, stop) of every occurrence of a window. docs: (doc_id, text_key, words)."""
    found = None
    for size in sorted(r[0] for r in prefixes.select("size").distinct().collect()):
        for part in _blocks(prefixes.filter(F.col("size") == size), "key", block):
            keyed = part.select("key", "off", "w", F.col("words").alias("window"))
            start = F.col("pos") - F.col("off")
            stop = start + F.size("window")
            near = _exploded(docs, size).join(F.broadcast(keyed), "key")
            bounded = near.filter((start >= 0) & (stop <= F.size("words")))
            same = bounded.filter(F.slice("words", start + 1, F.size("window")) == F.col("window"))
            hits = same.select("doc_id", "text_key", "w", start.alias("start"), stop.alias("stop"))
            found = hits if found is None else found.union(hits)
    if found is None:
        return docs.limit(0).selectExpr("doc_id", "text_key", "0L AS w", "0 AS start", "0 AS stop")
    return found


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids): one row per input row.

    n_hit counts the words inside any occurrence of an item's window; items of fewer words than a window,
    but not none, are one window; item_ids are sorted as strings. Null texts have no words; a repeated
    row is reported as often as it stands; items with a null id count as hits, but are not listed.
    Windows go to the executors in blocks of bounded size, so the items may be many.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("text_key"),
        word_list(F.col("text").cast("string")).alias("words"),
    )
    windows, items_of = item_windows(items, window, shingle)
    prefixes = materialise(rarest_shingles(keyed, windows), "window-prefixes")
    hits = materialise(find_windows(keyed, prefixes).distinct(), "window-hits")
    # Length of a union of intervals: walk over them by start, adding what lies beyond the last stop.
    spans = F.array_sort(F.collect_set(F.struct("start", "stop")))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(done: Column, span: Column) -> Column:
        more = F.greatest(span["stop"] - F.greatest(done["upto"], span["start"]), F.lit(0))
        return F.struct(
            F.greatest(done["upto"], span["stop"]).alias("upto"), (done["n"] + more).cast("long").alias("n")
        )

    covered = hits.groupBy("doc_id", "text_key").agg(F.aggregate(spans, zero, add)["n"].alias("n_hit"))
    named = (
        hits.select("doc_id", "text_key", "w").distinct().join(broadcast_if_small(items_of), "w")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    sizes = keyed.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    out = sizes
    for other in (covered, named):
        other = other.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
        on = (F.col("text_key") == F.col("_text_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        out = out.join(other, on, "left").drop("_doc_id", "_text_key")
    return out.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
