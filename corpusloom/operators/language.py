"""Language identification from character trigrams.

A profile is fitted on labelled documents and holds, per trigram, one integer
weight per language: the smoothed log-probability in millionths. Integer sums
are exact in any order, so results do not depend on the partitioning.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions.text import strip_space
from corpusloom.operators.sample import sample_n, smallest_n
from corpusloom.session import materialise, work_dir

# Languages of a profile: each is a column. More are refused, never dropped.
MAX_LANGUAGES = 1_000
MICRO = 1_000_000
# Characters that are looked at together, bytes of one part of a model, and parts a worker holds.
SLICE_CHARS, PART_BYTES, PARTS_HELD = 2_000_000, 32 << 20, 8
_BLANK = 32


def letters_only(col: Column) -> Column:
    """Lower-cased words bounded by single spaces."""
    words = F.btrim(F.regexp_replace(F.lower(col), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, rows, ends): texts one after the other, at most about `chars` characters at a time.

    `rows` are the places of the texts in the input and `ends` where they end in the slice. A longer text
    spans several slices; each goes on two characters before the end of the last, so every trigram is
    inside exactly one.
    """
    held: list[str] = []
    rows: list[int] = []
    size = 0

    def flush():
        codes = np.frombuffer("".join(held).encode("utf-32-le"), "uint32").astype("int64")
        return codes, np.array(rows), np.cumsum([len(t) for t in held])

    for row, text in enumerate(texts):
        at = 0
        while text and (at == 0 or at + 2 < len(text)):
            part = text[at : at + chars]
            if size + len(part) > chars + 2 and held:
                yield flush()
                held, rows, size = [], [], 0
            held.append(part)
            rows.append(row)
            size += len(part)
            at += max(len(part) - 2, 1)
    if held:
        yield flush()


def trigrams(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, inside): the trigram that starts at each place, and whether it ends in the same text.

    21 bits hold any code point, so a trigram is one 63-bit integer.
    """
    if len(codes) < 3:
        return np.zeros(0, "int64"), np.zeros(0, bool)
    inside = np.ones(len(codes) - 2, bool)
    for back in (1, 2):
        edge = ends[ends >= back] - back
        inside[edge[edge < len(inside)]] = False
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], inside


def _gram(key: int) -> str:
    return chr(key >> 42) + chr(key >> 21 & 0x1FFFFF) + chr(key & 0x1FFFFF)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n): letter trigrams over (text, lang).

    Each slice of a batch is counted where it is read, so one row per distinct trigram
    and slice is shuffled instead of one per character.
    """

    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in sorted({x for x in langs if x is not None}):
                own = (t.as_py() for t, x in zip(batch.column(1), langs, strict=True) if x == lang)
                for codes, _, ends in slices(own):
                    keys, inside = trigrams(codes, ends)
                    keys, n = np.unique(keys[inside], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(map(_gram, keys.tolist()), pa.string()),
                         pa.array(n, pa.int64())],
                        ["lang", "gram", "n"],
                    )

    letters = labelled.select(
        F.upper("lang").alias("lang"), letters_only(F.col("text")).alias("letters")
    )
    counted = letters.mapInArrow(count, "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_profile(labelled: DataFrame, grams: int | None = None) -> DataFrame:
    """(lang, gram, n, weight) for all trigrams, or for the `grams` most frequent ones."""
    counts = materialise(gram_counts(labelled), "grams")
    totals = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    if grams is None:
        seen, n_top = counts, totals.count()
    else:
        top = smallest_n(totals, -F.col("n"), grams, [F.col("gram")]).select("gram")
        top = materialise(top, "top")
        seen, n_top = counts.join(F.broadcast(top), "gram"), top.count()  # at most `grams` rows
    langs = [r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    totals = seen.groupBy("lang").agg(F.sum("n").alias("total"))
    # Every language gets a weight for every kept gram: grams x languages rows.
    wide = seen.groupBy("gram").pivot("lang", sorted(langs)).agg(F.sum("n"))
    every = wide.unpivot("gram", sorted(langs), "lang", "n").fillna(0, ["n"])
    weight = F.round(F.log((F.col("n") + 1) / (F.col("total") + n_top)) * MICRO)
    return every.join(F.broadcast(totals), "lang").select(  # one row per language
        "lang", "gram", "n", weight.cast("bigint").alias("weight")
    )


@dataclass(frozen=True)
class Part:
    """A run of trigrams in key order: a file of their keys, then their weights, a column per language."""

    first: int
    n: int
    path: str


@functools.lru_cache(maxsize=PARTS_HELD)
def _loaded(path: str, n: int, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and weights of a part: mapped where the folder is a local one, else read."""
    system, place = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        data = np.memmap(place, "int64", "r")
    else:
        with system.open_input_file(place) as source:
            data = np.frombuffer(source.read(), "int64")
    return data[:n], data[n:].reshape(n_langs, n)


def _store(wide: DataFrame, n_langs: int, part_bytes: int) -> list[Part]:
    """Writes (key, weights) in key order to the shared folder, in parts of bounded size."""
    folder = f"{work_dir(wide.sparkSession)}/language-{uuid.uuid4().hex}"
    wide = materialise(wide, "language-weights")
    n_parts = max(1, math.ceil(wide.count() * 8 * (n_langs + 1) / part_bytes))

    def write(batches):
        keys, weights = [], []
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            weights.append(batch.column(1).flatten().to_numpy().reshape(-1, n_langs))
        keys = np.concatenate(keys) if keys else np.zeros(0, "int64")
        rows = []
        if len(keys):
            path = f"{folder}/{uuid.uuid4().hex}.weights"
            system, place = fs.FileSystem.from_uri(path)
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(place, compression=None) as out:
                out.write(np.ascontiguousarray(keys, "int64").tobytes())
                out.write(np.ascontiguousarray(np.concatenate(weights).T, "int64").tobytes())
            rows = [(int(keys[0]), len(keys), path)]
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["first", "n", "path"])

    dealt = wide.repartitionByRange(n_parts, "key").sortWithinPartitions("key")
    # One row per part. Only files of the attempts that counted are listed.
    found = materialise(dealt.mapInArrow(write, "first long, n long, path string"), "language-parts").collect()
    return sorted((Part(r["first"], r["n"], r["path"]) for r in found), key=lambda p: p.first)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in name order and the files of the weights; the model itself never meets the driver."""

    langs: list[str]
    parts: list[Part]

    @classmethod
    def load(cls, profile: DataFrame, part_bytes: int = PART_BYTES) -> "LanguageModel":
        """From a profile table of any size."""
        profile = materialise(profile, "profile")
        names = sorted(r[0] for r in profile.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
        if len(names) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        if not names:
            return cls([], [])
        points = [F.ascii(F.substring("gram", i, 1)).cast("long") for i in (1, 2, 3)]
        key = F.shiftleft(points[0], 42).bitwiseOR(F.shiftleft(points[1], 21)).bitwiseOR(points[2])
        wide = profile.groupBy(key.alias("key")).pivot("lang", names).agg(F.first("weight"))
        weights = F.array(*[F.col(f"`{x}`") for x in names])
        return cls(names, _store(wide.select("key", weights.alias("weights")), len(names), part_bytes))

    def scores(self, col: Column) -> Column:
        """Array of one sum per language (name order) and the known trigrams.

        Only the letters travel to Python, and some millions of characters at a time become trigrams, so
        memory depends neither on the batch nor on the length of a text.
        """
        parts, n_langs = self.parts, len(self.langs)

        @F.arrow_udf("array<bigint>")
        def sums(texts: pa.Array) -> pa.Array:
            out = np.zeros((len(texts), n_langs + 1), "int64")
            for codes, rows, ends in slices(t.as_py() for t in texts):
                keys, inside = trigrams(codes, ends)
                if len(keys):
                    starts = np.concatenate([[0], ends[:-1]])
                    _add_scores(out, keys, inside, rows, starts, parts, n_langs)
            offsets = np.arange(0, out.size + 1, n_langs + 1, dtype="int32")
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

        return sums(letters_only(col))

    def best(self, scores: Column) -> Column:
        """Name of the best language; ties by name; no known trigram: UNKNOWN."""
        names = F.lit(self.langs)
        by_lang = F.slice(scores, 1, len(self.langs))
        place = F.array_position(by_lang, F.array_max(by_lang)).cast("int")
        known = F.element_at(scores, len(self.langs) + 1) > 0
        return F.when(known, F.get(names, place - 1)).otherwise(F.lit(fx.UNKNOWN_LANG))


def _add_scores(out, keys, inside, rows, starts, parts: list[Part], n_langs: int) -> None:
    """Adds the weights of the trigrams of a slice to the rows of their texts."""
    firsts = np.array([p.first for p in parts], "int64")
    of = np.searchsorted(firsts, keys, "right") - 1
    # Texts of one or two characters at the end of a slice have no trigram to start at.
    held = starts < len(keys)
    for i in np.unique(of[inside]).tolist():
        if i < 0:
            continue
        known, weights = _loaded(parts[i].path, parts[i].n, n_langs)
        mine = inside & (of == i) if len(parts) > 1 else inside
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = mine & (known[at] == keys)
        for j in range(n_langs + 1):
            worth = np.where(hit, weights[j][at], 0) if j < n_langs else hit.astype("int64")
            np.add.at(out[:, j], rows[held], np.add.reduceat(worth, starts[held]))


def fit_language(labelled: DataFrame, grams: int | None = None) -> LanguageModel:
    return LanguageModel.load(fit_profile(labelled, grams))


def detect_language(
    df: DataFrame, model: LanguageModel, col: str = "text", out: str = "lang"
) -> DataFrame:
    """Add the upper-case language code. A narrow step: no shuffle, no join."""
    scored = df.withColumn("_scores", model.scores(F.col(col)))
    return scored.withColumn(out, model.best(F.col("_scores"))).drop("_scores")


def language_distribution(
    df: DataFrame, model: LanguageModel, n: int = 5000, seed: int = 7
) -> DataFrame:
    """Histogram of the language over a random sample, blank documents skipped."""
    sampled = sample_n(df.select("ord", "text"), n, seed)
    detected = detect_language(sampled.filter(strip_space(F.col("text")) != ""), model)
    counts = detected.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    total = F.sum("docs").over(Window.partitionBy())  # one row per language
    return counts.select(
        "lang", "docs", (F.col("docs") * F.lit(100.0) / total).alias("pct")
    )
