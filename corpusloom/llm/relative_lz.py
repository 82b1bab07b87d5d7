"""Substring dedup by relative Lempel-Ziv parsing.

Every text is cut at content-defined anchors: the smallest 8-word hash of each window of 35 words.
Windows that share an anchor form a phrase, so equal windows always stand in phrases of the same anchor,
at the same distance from it. The phrases of all documents, indexed by anchor and spread over the
cluster, are the reference blocks. A document is parsed greedily against them: a phrase that stands
elsewhere extends the factor as a whole, and runs of such phrases are one long factor. Where a phrase
shares its anchor but not all its words, a factor ends inside it; there, and only there, single
windows are compared. The windows inside factors are the duplicate spans.

Words are hashed by prefix sums over the bytes of a text, so any run of words costs one subtraction.
Sums modulo 2 ** 64 are weak for regular runs of a thousand bytes, so a word of more than LONG_WORD bytes
goes in as one XXH64 value. Windows are compared by this hash and by the independent one of their anchor.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialise

#: Words of a window, and of the grams whose smallest hash is the anchor.
WINDOW, GRAM = 35, 8
#: Bytes of a word from which on it is hashed as a whole.
LONG_WORD = 32
#: A key with more than one in this many rows of a join is hot. So fewer keys than this can be hot.
HOT_KEYS = 4096
_U = np.uint64


@functools.lru_cache(maxsize=1)
def _fixed() -> tuple[np.ndarray, tuple[int, int]]:
    """A random value for each byte and two odd bases, the same in every worker."""
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


class RunHashes:
    """Hashes of word runs of a text: words joined by one space."""

    def __init__(self, words: list[bytes], lanes: tuple[int, ...] = (0, 1)):
        self.n = len(words)
        joined = b" ".join(words)
        data = np.frombuffer(joined, np.uint8)
        gaps = np.flatnonzero(data == 32)
        self.starts = np.concatenate([[0], gaps + 1]).astype(np.int64)
        self.ends = np.append(gaps, len(data)).astype(np.int64)
        self.values = _fixed()[0][data]
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist() if words else ():
            a, b = int(self.starts[i]), int(self.ends[i])
            self.values[a:b] = 0
            self.values[a] = xxhash.xxh64_intdigest(joined[a:b], 42)
        size = max(1 << 14, 1 << (len(data) + 1).bit_length())
        self.sums = {}
        for lane in lanes:
            base = _fixed()[1][lane]
            power = _powers(base, size)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.values * power[: len(data)], dtype=np.uint64, out=sums[1:])
            self.sums[lane] = (sums, _powers(pow(base, -1, 1 << 64), size))

    def runs(self, first: np.ndarray | slice, words: int | np.ndarray, lane: int) -> np.ndarray:
        """Hash of `words` words from each first word on."""
        sums, back = self.sums[lane]
        first = np.arange(self.n)[first] if isinstance(first, slice) else first
        a, b = self.starts[first], self.ends[first + words - 1]
        return _mixed((sums[b] - sums[a]) * back[a] + b.astype(np.uint64) - a.astype(np.uint64))


def _leftmost_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values the place of its smallest, the leftmost of equals; by doubling."""
    at, value, have = np.arange(len(h)), h, 1
    while have < width:
        by = min(have, width - have)
        left, right = value[:-by], value[by:]
        take = right < left
        at, value = np.where(take, at[by:], at[:-by]), np.where(take, right, left)
        have += by
    return at


def phrases(words: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """(first window, number of windows, anchor hash, phrase hash) of a text; None if it is too short."""
    if len(words) < window:
        return None
    hashes = RunHashes(words)
    grams = hashes.runs(slice(0, hashes.n - gram + 1), gram, 0)
    anchor = _leftmost_minimum(grams, window - gram + 1)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(first, append=len(anchor))
    place = anchor[first]
    whole = hashes.runs(first, count + window - 1, 1)
    # The same words around another place of the anchor are another phrase.
    whole = _mixed(whole + (place - first).astype(np.uint64))
    return first, count, grams[place].view(np.int64), whole.view(np.int64)


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_PHRASES = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int32()), ("n", pa.int32()),
     ("anchor", pa.int64()), ("phrase", pa.int64())]
)


def phrase_index(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All phrases of all texts. docs: (doc_id, text_key, text)."""

    def index(batches):
        for batch in batches:
            found, ids, keys = [], [], []
            for doc_id, key, text in zip(*batch.columns):
                one = phrases(text.as_py().encode().split(), window, gram)
                if one is not None:
                    found.append(one)
                    ids.extend([doc_id.as_py()] * len(one[0]))
                    keys.extend([key.as_py()] * len(one[0]))
            if found:
                yield _batch(_PHRASES, [ids, keys, *(np.concatenate(c) for c in zip(*found))])

    return docs.mapInArrow(index, "doc_id long, text_key long, first int, n int, anchor long, phrase long")


def _packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Texts compressed one by one: they are shuffled twice, and are most of what is shuffled."""
    names = ["doc_id", "text_key", *keep]

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            data = pa.array([squeeze(t.as_py().encode()) for t in columns["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([*(columns[c] for c in names), data], names=[*names, "packed"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, "text").mapInArrow(pack, f"{kinds}, packed binary")


def _same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joins on the key and the id, which may be null; columns of the left, then the right's others."""
    other = right.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    on = (F.col("text_key") == F.col("_text_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    return left.join(other, on, how).drop("_doc_id", "_text_key")


_WINDOWS = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("anchor", pa.int64()),
     ("hash", pa.int64()), ("copies", pa.int64())]
)


def _windows_at_factor_ends(packed: DataFrame, phrases_: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_key, at, anchor, hash, copies) for each window of the given phrases."""
    wanted = phrases_.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("first", "n", "anchor", "copies")).alias("wanted")
    )
    texts = _same_document(packed.select("doc_id", "text_key", "packed"), wanted, "inner")

    def windows(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for doc_id, key, data, wanted in zip(*batch.columns):
                hashes = RunHashes(expand(data.as_py()).split(), (1,))
                first, n, anchor, copies = (
                    np.array(c, np.int64) for c in zip(*(tuple(w.values()) for w in wanted.as_py()))
                )
                of = np.repeat(np.arange(len(n)), n)
                at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                whole = hashes.runs(at, window, 1).view(np.int64)
                same = [[doc_id.as_py()] * len(at), [key.as_py()] * len(at)]
                yield _batch(_WINDOWS, [*same, at.astype(np.int32), anchor[of], whole, copies[of]])

    kinds = "doc_id long, text_key long, at int, anchor long, hash long, copies long"
    return texts.mapInArrow(windows, kinds)


def _join_by(rows: DataFrame, keys: DataFrame, on: list[str], places: str, total: int) -> DataFrame:
    """Inner join without a hot task. keys: one row a key, with its number of `places` among `total` rows.

    Hot keys, fewer than HOT_KEYS of them however large the input, are broadcast, so their rows stay where they
    are. Only the others are shuffled.
    """
    hot = F.col(places) * HOT_KEYS > F.lit(total)
    few, rest = F.broadcast(keys.filter(hot).drop(places)), keys.filter(~hot).drop(places)
    others = rows.join(F.broadcast(keys.filter(hot).select(*on)), on, "left_anti")
    return rows.join(few, on).unionByName(others.join(rest, on))


def duplicate_spans(
    texts: DataFrame, packed: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, text_key, at, n): n windows from word `at` on that stand elsewhere too."""
    index = materialise(phrase_index(texts, window, gram), "phrases")
    anchors = index.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("places"), (F.min("phrase") != F.max("phrase")).alias("mixed")
    )
    repeated = materialise(anchors.filter("places > 1"), "repeated-anchors")
    found = materialise(_join_by(index, repeated, ["anchor"], "places", index.count()), "repeated-phrases")
    factor = ["doc_id", "text_key", F.col("first").alias("at"), "n"]
    # An anchor with one phrase at several places: the factors run on through all of them.
    through = found.filter(~F.col("mixed")).select(*factor)
    mixed = found.filter("mixed").drop("mixed")
    # Copies of a phrase, and one place that stands for all of them. Sums of parts first: no hot key.
    kinds = materialise(
        mixed.groupBy("anchor", "phrase").agg(
            F.count(F.lit(1)).alias("copies"),
            F.first(F.struct("doc_id", "text_key", "first", "n")).alias("place"),
        ),
        "phrase-kinds",
    )
    copied = kinds.filter("copies > 1").select("anchor", "phrase", "copies")
    whole = _join_by(mixed, copied, ["anchor", "phrase"], "copies", index.count()).select(*factor)
    # A factor may end inside any phrase of such an anchor: compare the windows one by one.
    ends = kinds.select("place.*", "anchor", "copies")
    single = materialise(_windows_at_factor_ends(packed, ends, window), "windows-at-factor-ends")
    twice = single.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
    twice = materialise(twice, "repeated-windows")
    partly = _join_by(single.filter("copies = 1"), twice, ["anchor", "hash"], "places", single.count())
    return through.union(whole).union(partly.select("doc_id", "text_key", "at", F.lit(1).alias("n")))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, + `keep` columns): one row per input row.

    Removes each word that a window covers whose words also start anywhere else, in any document or
    the same one; all places are removed, none is spared as the first. Words are split at ASCII white
    space, unchanged; `kept` joins what is left by one space. Null and short texts lose nothing; repeated
    rows are copies of each other, whatever their ids. Columns named in `keep` are passed on, all
    others are ignored.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in keep], F.lit(0).alias("_")).alias("kept_columns"),
    ).withColumn("text_key", F.xxhash64("doc_id", "text"))
    packed = _packed(own, ["kept_columns"])
    spans = duplicate_spans(own.select("doc_id", "text_key", "text"), packed, window, gram)
    of_doc = spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    joined = _same_document(packed, of_doc, "left").drop("text_key")

    def cut(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            n_words, n_removed, kept = [], [], []
            for data, spans in zip(columns["packed"], columns["spans"]):
                words = expand(data.as_py()).split()
                n_words.append(len(words))
                if not spans.is_valid:
                    n_removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                edges = np.zeros(len(words) + 1, np.int64)
                for span in spans.as_py():
                    edges[span["at"]] += 1
                    edges[span["at"] + span["n"] + window - 1] -= 1
                stay = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                n_removed.append(len(words) - len(stay))
                kept.append(b" ".join([words[i] for i in stay.tolist()]))
            yield pa.RecordBatch.from_arrays(
                [columns["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), columns["kept_columns"]],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_columns"],
            )

    kinds = docs.select(F.struct(*[F.col(c) for c in keep], F.lit(0).alias("_")).alias("s")).schema["s"]
    out = joined.mapInArrow(
        cut,
        "doc_id long, n_words long, n_removed long, kept string, "
        f"kept_columns {kinds.dataType.simpleString()}",
    )
    return out.select("doc_id", "n_words", "n_removed", "kept", *[F.col(f"kept_columns.`{c}`") for c in keep])
