"""Order MinHash fingerprints, with DataFrame functions only.

The k-mers of a text are runs of words, numbered by occurrence, so that a repeated k-mer counts as often
as it stands. One hash of (k-mer, number) deals them into slots, and the smallest hash of a slot is
selected. A tuple has two slots of its own, or, where they are empty, the next slots around that are
not; so every tuple of a text of two k-mers or more holds two of its minimal k-mers, in short texts too.
They are hashed in the order in which they stand in the text. Texts share a tuple if they share its
k-mers in the same order, so the share of equal tuples falls with edits and with moves alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise

#: Tuples of a fingerprint. A tuple has two k-mers of two words each.
TUPLES = 32

_SPACE = r"[\x20\x09-\x0D]+"
_EMPTY = "-" * 8


def _kmers(rows: DataFrame, text: str) -> DataFrame:
    """Adds pos and kmer (hash) of every pair of neighbouring words; a single word is a k-mer itself."""
    words = F.array_remove(F.split(F.col(text), _SPACE), "")
    split = rows.withColumn("_words", words).drop(text)
    later = F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(0)))
    pairs = F.arrays_zip(F.col("_words").alias("a"), later.alias("b"))
    each = split.select("*", F.posexplode(pairs).alias("pos", "_pair"))
    whole = F.col("_pair").getField("b").isNotNull() | (F.size("_words") == 1)
    kmer = F.xxhash64(F.col("_pair").getField("a"), F.col("_pair").getField("b"))
    return each.filter(whole).withColumn("kmer", kmer).drop("_words", "_pair")


def _tuple(one: Column, other: Column) -> Column:
    """Hash of two selected k-mers in text order."""
    ahead = one["pos"] <= other["pos"]
    first, second = F.when(ahead, one["h"]).otherwise(other["h"]), F.when(ahead, other["h"]).otherwise(one["h"])
    return F.xxhash64(first, second).bitwiseAND(F.lit(0xFFFFFFFF))


def _tuples(selected: Column) -> Column:
    """The hashes of all tuples from the selected k-mers (slot, h, pos), in slot order.

    Tuple t takes the first slot from 2 t on that holds a k-mer, and the one after it, both around the
    end. A slot is thus the first of all tuples after the slot before it, up to its own.
    """
    n = F.size(selected)
    own = lambda e: F.floor(e["slot"] / 2).cast("int")
    place = lambda i: F.get(selected, i % n)

    def runs(e: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(own(F.get(selected, i - 1)))
        return F.array_repeat(_tuple(e, place(i + 1)), own(e) - before)

    rest = F.array_repeat(_tuple(place(F.lit(0)), place(F.lit(1))), TUPLES - 1 - own(F.get(selected, n - 1)))
    return F.concat(F.flatten(F.transform(selected, runs)), rest)


def sketches(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, hashes): the tuples of every text that has a word. The key must tell the rows apart.

    Keeps the partitioning of its input if that is by columns of the key.
    """
    kmers = _kmers(rows.select(*key, text), text)
    same = Window.partitionBy("kmer", *key).orderBy("pos")
    numbered = kmers.select(*key, "pos", F.xxhash64("kmer", F.row_number().over(same)).alias("h"))
    slots = numbered.withColumn("slot", F.pmod("h", F.lit(2 * TUPLES)).cast("int"))
    least = slots.groupBy(*key, "slot").agg(F.min("h").alias("h"), F.min_by("pos", "h").alias("pos"))
    # At most two per tuple.
    selected = least.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("slot", "h", "pos"))).alias("selected"))
    return selected.select(*key, _tuples(F.col("selected")).alias("hashes"))


def fingerprint(hashes: Column | str) -> Column:
    """All tuples as one string, 8 hex digits each; without words, dashes."""
    hashes = F.col(hashes) if isinstance(hashes, str) else hashes
    digits = F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")
    return F.coalesce(digits, F.lit(_EMPTY * TUPLES))


def likeness(left: str, right: str) -> Column:
    """Share of equal tuples; of texts without words, 1 with each other and 0 with any other."""
    same = F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda equal: equal)
    neither = F.col(left).isNull() & F.col(right).isNull()
    return F.when(neither, F.lit(1.0)).otherwise(F.coalesce(F.size(same) / F.lit(float(TUPLES)), F.lit(0.0)))


def _bucket(bounds: list[int]) -> Column:
    """How many bounds the id is below: 0 for the largest ids. A binary search in a constant array."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    down = F.array(*[F.lit(b) for b in sorted(bounds, reverse=True)])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, by: Column) -> Column:
        inside = at + by <= len(bounds)
        below = F.try_element_at(down, at + by) > F.col("doc_id")
        return F.when(inside & below, at + by).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(found)


def _next_texts(docs: DataFrame) -> DataFrame:
    """(bucket, rn, doc_id, text, next_bucket, next_rn, next_text) in descending doc_id order.

    Ids are dealt into ranges by their quantiles; each range is ordered alone. The last of a range is
    followed by the first of the next range, and the last of all by the first of all. Null ids
    come last; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 100 * n)).first()[0] or []  # n numbers
    dealt = docs.withColumn("bucket", _bucket(sorted(set(bounds)))).repartition(parts, "bucket")
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    rows = dealt.select(
        "*", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("own_next")
    )
    firsts = rows.filter("rn = 1").select("bucket", "text")
    # The ranges in order, one row each, without texts.
    names = materialise(firsts.select("bucket"), "ranges")
    along = Window.orderBy("bucket")
    turn = F.coalesce(F.lead("bucket").over(along), F.min("bucket").over(Window.partitionBy()))
    pairs = names.select("bucket", turn.alias("next_bucket"))
    heads = pairs.join(
        firsts.select(F.col("bucket").alias("next_bucket"), F.col("text").alias("head")), "next_bucket"
    )
    last = F.col("own_next").isNull()
    return rows.join(heads, "bucket").select(
        "bucket", "rn", "doc_id", "text",
        F.when(last, F.col("next_bucket")).otherwise(F.col("bucket")).alias("next_bucket"),
        F.when(last, F.lit(1)).otherwise(F.col("rn") + 1).alias("next_rn"),
        F.coalesce("own_next", "head").alias("next_text"),
    )


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints every text and its edited text, and compares them.

    The edited text ends with the beginning of the next document in place of its last third. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, one row
    per input row. Null texts are empty; texts without words have an empty fingerprint, equal to
    that of any other such text and unlike all others.
    """
    rows = _next_texts(id_text(docs))
    n_chars = F.length("text")
    cut = F.floor(n_chars / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n_chars - cut), F.substring("next_text", F.lit(1), cut)
    )
    rows = rows.withColumn("edited", F.coalesce(edited, F.lit("")))  # never null
    both = rows.select(
        "bucket", "rn", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("text")),
            F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")),
        )).alias("t"),
    ).select("bucket", "rn", "t.side", "t.text")
    tuples = sketches(both, ["bucket", "rn", "side"], "text")
    wide = tuples.groupBy("bucket", "rn").agg(
        *[F.max(F.when(F.col("side") == side, F.col("hashes"))).alias(name) for side, name in ((0, "o"), (1, "e"))]
    )
    facts = rows.select(
        "bucket", "rn", "next_bucket", "next_rn", "doc_id",
        n_chars.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
    )
    known = materialise(facts.join(wide, ["bucket", "rn"], "left"), "order-minhash")
    following = known.select(
        F.col("bucket").alias("next_bucket"), F.col("rn").alias("next_rn"),
        F.col("o").alias("n"),
    )
    return known.join(following, ["next_bucket", "next_rn"]).select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint("o").alias("fingerprint"), fingerprint("e").alias("edited_fingerprint"),
        likeness("o", "e").alias("near_edited"), likeness("o", "n").alias("near_next"),
    )
