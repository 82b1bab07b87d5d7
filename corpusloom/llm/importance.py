"""Target-distribution importance resampling.

Words of all documents and of the target texts are counted in hashed buckets; the logarithm of the
ratio of the two smoothed shares is the gain of a bucket. The gains travel to the tasks as one array
of fixed size, by which every document is scored. Noise that depends on the id alone is added (the
Gumbel trick), so that the highest scores are a sample without replacement by weight.

The cutoff among the scores is found by weighted median-of-medians selection: every partition of what
remains gives its median and its size; the weighted median of these medians has a guaranteed
share of the keys on either side; the side that cannot hold the cutoff is discarded. Nothing is sorted
as a whole but the winners.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise
from corpusloom.llm.ranges import running_totals

BUCKETS, LONGEST_RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
#: Keys that one task sorts by itself, the base case of the selection.
BASE = 50_000
#: Remembered features of a worker, and bytes of a text that are split into words at once.
_MEMO, _SLICE = 500_000, 1 << 22

# On UTF-8 bytes: digits, letters, and all of any character above U+007F.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def words_in_parts(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with A-Z in lower case, some megabytes at a time, cut between words only."""
    at = 0
    while at < len(text):
        gap = _BREAK.search(text, at + _SLICE)
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


class _Buckets(dict):
    """Feature -> bucket, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self._buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self._buckets
        if len(self) >= _MEMO:
            self.clear()
        if len(feature) < 64:
            self[feature] = bucket
        return bucket


@functools.lru_cache(maxsize=2)
def _memo(buckets: int) -> _Buckets:
    return _Buckets(buckets)


def features_in_parts(text: bytes, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs of 1 to `longest` words that end in them), part by part."""
    of = _memo(buckets).__getitem__
    before: list[bytes] = []
    for words in words_in_parts(text):
        found = list(map(of, words))
        if longest > 1:
            both = before + words
            for n in range(2, longest + 1):
                first = max(0, len(before) - n + 1)
                found += [of(b" ".join(both[i : i + n])) for i in range(first, len(both) - n + 1)]
            before = both[max(0, len(both) - longest + 1) :]
        yield len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Features of all texts per bucket. A task sends one row per bucket at most, so does the sum."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in features_in_parts(text.as_py() or b"", buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        (held,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    binary = texts.select(F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    sums = binary.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most `buckets` rows
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: the floored thousandfold logarithm of the target's smoothed share over the corpus's."""
    all_corpus, all_target, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array(
        [
            math.floor(1000 * math.log((int(t) + 1) * (all_corpus + n) / ((int(s) + 1) * (all_target + n))))
            for s, t in zip(corpus, target, strict=True)
        ],
        np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document; 0 without features."""

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = n = total = 0
                for more, found in features_in_parts(text.as_py() or b"", len(gain), longest):
                    words, n, total = words + more, n + len(found), total + int(gain[found].sum())
                rows.append((words, n, total // n if n else 0))
            table = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(table[:, i]) for i in range(3)]], ["doc_id", "n_words", "n_features", "weight"]
            )

    binary = id_text(docs).select("doc_id", F.encode("text", "UTF-8").alias("text"))
    return binary.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str = SEED) -> Column:
    """A standard Gumbel variate of the id, in floored thousandths."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


# --- selection ----------------------------------------------------------------

#: Smaller keys come first: higher scores, then smaller ids, null the last, then fewer features.
_KEY = ["low", "none", "id", "features"]
_KEY_SCHEMA = ", ".join(f"{c} long" for c in _KEY)


def _keys() -> list[Column]:
    return [
        (-F.col("score")).alias("low"), F.col("doc_id").isNull().cast("long").alias("none"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("n_features").alias("features"),
    ]


def _key() -> Column:
    return F.struct(*_KEY)


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(int(v)).cast("long").alias(c) for c, v in zip(_KEY, key, strict=True)])


def _sorted(batches) -> np.ndarray:
    parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1) for b in batches if b.num_rows]
    if not parts:
        return np.zeros((0, len(_KEY)), np.int64)
    rows = np.concatenate(parts)
    return rows[np.lexsort(rows.T[::-1])]


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(len(names))], names)


def partition_medians(keys: DataFrame) -> list[tuple[tuple, int]]:
    """(median, size) of every partition that has keys: as many rows as partitions."""

    def run(batches):
        rows = _sorted(batches)
        yield _batch([(*rows[(len(rows) - 1) // 2], len(rows))] if len(rows) else [], [*_KEY, "n"])

    found = keys.mapInArrow(run, f"{_KEY_SCHEMA}, n long").collect()
    return [(tuple(r[:-1]), r[-1]) for r in found]


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The median that half of all keys stand at or before, by the sizes of their partitions."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def kth_key(keys: DataFrame, k: int, base: int = BASE) -> tuple:
    """The k-th smallest key (from 1) of a written table of keys; 1 <= k <= number of keys.

    At least a quarter of what remains goes in each round, about half in a shuffled table. What remains is
    written anew once it has shrunk to a fourth, so all rounds together read the table a few times.
    At most `base` keys are left to one task.
    """
    left, size = keys, keys.count()
    written = size
    while size > base:
        pivot = weighted_median(partition_medians(left))
        at = _literal(pivot)
        before, equal = left.agg(
            F.count(F.when(_key() < at, 1)).alias("before"), F.count(F.when(_key() == at, 1)).alias("equal")
        ).first()
        if before < k <= before + equal:
            return pivot
        if k <= before:
            left, size = left.filter(_key() < at), before
        else:
            left, size, k = left.filter(_key() > at), size - before - equal, k - before - equal
        if 4 * size <= written:
            left, written = materialise(left, "remaining"), size

    def run(batches):
        yield _batch([tuple(_sorted(batches)[k - 1])], _KEY)

    return tuple(left.coalesce(1).mapInArrow(run, _KEY_SCHEMA).first())


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED, base: int = BASE,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    docs: (doc_id, text); target: (text). Null or empty texts have no feature and weight 0, and count in
    neither corpus. A null id hashes as an empty one and comes last among equal scores. Repeated rows
    are documents of their own; rows equal in score and id rank by their number of features, and equal
    rows are ranked in any order. Empty tables give empty results; without target texts the shares of
    the target are even. Columns of other names take no part.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = weights(docs, gain, longest).withColumn("score", (F.col("weight") + noise(seed)).cast("long"))
    scored = materialise(scored, "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.filter(able).count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not drawn:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    keys = materialise(scored.filter(able).select(*_keys()), "keys")
    cutoff = _literal(kth_key(keys, drawn, base))
    keyed = scored.select(*out, *_keys(), able.alias("able"))
    won = F.col("able") & (_key() <= cutoff)
    winners = materialise(keyed.filter(won).withColumn("one", F.lit(1)), "winners")
    ranked = running_totals(winners, [F.col(c).asc() for c in _KEY], {"one": "ahead"}, "ranked")
    # Rows equal to the cutoff may be more than are drawn.
    rank = F.when(F.col("ahead") < drawn, F.col("ahead") + 1)
    lost = keyed.filter(~won).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, rank.alias("rank")).unionByName(lost)
