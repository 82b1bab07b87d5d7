"""Tokenisation: byte-pair ids per document, decoding, length statistics.

Two encoders share one vocabulary. The base encoder knows the end of text as its only special token,
the last base id; the extended one knows four others, with the ids after it, and reads a literal end of
text as ordinary text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions import pretokenise
from corpusloom.functions.text import strip_space
from corpusloom.operators import bpe
from corpusloom.operators.lookup import split_hot
from corpusloom.operators.sample import first_n, smallest_n
from corpusloom.session import materialise

#: Bytes of text, and ids, that are worked on together.
SLICE_BYTES, SLICE_IDS = 2 << 20, 1 << 20


def _parts(col: Column, special: list[str]) -> Column:
    """A text cut before and after each literal special token, the longest first; null for null."""
    whole = F.when(col.isNotNull(), F.array(F.make_valid_utf8(col)))
    if not special:
        return whole
    names = sorted(special, key=lambda t: (-len(t), t))
    any_special = "(?:" + "|".join(r"\Q" + t + r"\E" for t in names) + ")"
    holds = functools.reduce(Column.__or__, [F.contains(col, F.lit(t)) for t in names])
    return F.when(holds, F.split(col, f"(?={any_special})|(?<={any_special})")).otherwise(whole)


def pretokens(col: Column, special: list[str] = fx.SPECIAL_TOKENS) -> Column:
    """Published pre-tokeniser pattern on the parts of a text; literal special tokens stay whole."""
    names = list(special)

    @F.arrow_udf("array<string>")
    def pieces(lists: pa.Array) -> pa.Array:
        tokens, sizes = pretokenise.cut(lists.flatten(), names)
        upto = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(_sizes(lists)))]
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), tokens, mask=lists.is_null())

    return pieces(_parts(col, names))


def pretoken_counts(df: DataFrame) -> DataFrame:
    """(token, n) over the stripped texts, special tokens left out; counted per batch, then added up."""
    names = list(fx.SPECIAL_TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = pretokenise.cut(rows.column(0).flatten(), names)[0].value_counts()
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.string()), found.field("counts")], ["token", "n"]
            )

    counts = df.select(_parts(strip_space(F.col("text")), names).alias("parts")).mapInArrow(run, "token string, n long")
    return (
        counts.groupBy("token").agg(F.sum("n").alias("n"))
        .filter(~F.col("token").isin(fx.SPECIAL_TOKENS))
    )


def fit_vocab(counts: DataFrame, size: int = fx.BASE_VOCAB_SIZE) -> DataFrame:
    """(token, id, n): ids from 0 by falling count, then token."""
    top = smallest_n(materialise(counts, "pretokens"), -F.col("n"), size, [F.col("token")])
    by_rank = Window.orderBy(F.desc("n"), "token")  # at most `size` rows
    return top.select("token", (F.row_number().over(by_rank) - 1).alias("id"), "n")


@dataclass(frozen=True)
class Encoder:
    """Merges in rank order and the ids of the special tokens. Lossless: every text comes back.

    The merges are a table of bounded size (a parameter of the training) and travel to the tasks.
    """

    merges: tuple[bpe.Pair, ...]
    special: dict[str, int] = field(hash=False)

    @classmethod
    def base(cls, merges: tuple[bpe.Pair, ...]) -> "Encoder":
        return cls(merges, {fx.END_OF_TEXT: 256 + len(merges)})

    @classmethod
    def extended(cls, merges: tuple[bpe.Pair, ...]) -> "Encoder":
        first = 256 + len(merges) + 1
        return cls(merges, {t: first + i for i, t in enumerate(fx.SPECIAL_TOKENS)})

    @property
    def vocab_size(self) -> int:
        return max(self.special.values()) + 1

    @property
    def bos(self) -> int:
        return self.special["<|bos|>"]

    @property
    def eos(self) -> int:
        return self.special["<|eos|>"]

    @property
    def pad(self) -> int:
        return self.special["<|pad|>"]

    def pretokens(self, col: Column) -> Column:
        return pretokens(col, list(self.special))

    def _applied(self, act: Callable, kind: str, lists: Column, whole: list[str] | None = None) -> Column:
        merges, special = self.merges, tuple(self.special.items())

        @F.arrow_udf(kind)
        def run(batch: pa.Array) -> pa.Array:
            return act(batch, bpe.coder(merges, special), whole)

        return run(lists)

    def _of_text(self, act: Callable, kind: str, col: Column) -> Column:
        names = list(self.special)
        return F.when(col.isNotNull(), self._applied(act, kind, _parts(F.coalesce(col, F.lit("")), names), names))

    def ids_of(self, tokens: Column) -> Column:
        """Ids of an array of pre-tokens, ARRAY<INT>; each distinct one is merged once per slice of a batch."""
        return self._applied(_gathered, "array<int>", tokens)

    def counts_of(self, tokens: Column) -> Column:
        """Number of ids of an array of pre-tokens."""
        return self._applied(_counted, "int", tokens)

    def encode(self, col: Column) -> Column:
        """Ids of a text, ARRAY<INT>; null for null."""
        return self._of_text(_gathered, "array<int>", col)

    def count(self, col: Column) -> Column:
        """Number of ids of a text; null for null."""
        return self._of_text(_counted, "int", col)

    def token_bytes(self) -> list[bytes]:
        """What each id stands for; ids without a token of this encoder stand for nothing."""
        back = {s: b for b, s in bpe.byte_alphabet().items()}
        out = [b""] * self.vocab_size
        for i, b in enumerate(bpe.byte_order()):
            out[i] = bytes([b])
        for i, pair in enumerate(self.merges):
            out[256 + i] = bytes(back[c] for c in "".join(pair))
        for token, i in self.special.items():
            out[i] = token.encode()
        return out

    def decode(self, ids: Column) -> Column:
        """The text of an array of ids. Bytes are joined before they are read as UTF-8, as a character may
        be spread over several ids; what is no UTF-8 (a cut character) becomes U+FFFD."""
        table = pa.array(self.token_bytes(), pa.binary())

        @F.arrow_udf("binary")
        def join(lists: pa.Array) -> pa.Array:
            parts = []
            for some in _slices(lists, np.append(0, np.cumsum(_sizes(lists))), SLICE_IDS):
                taken = table.take(some.flatten())
                lengths = np.append(0, np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False)))
                offsets = np.concatenate([[0], lengths[np.cumsum(_sizes(some))]]).astype("int32")
                data = taken.buffers()[2] or pa.py_buffer(b"")
                parts.append(pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), data]))
            return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

        text = F.make_valid_utf8(join(F.coalesce(ids, F.array().cast("array<int>"))).cast("string"))
        return F.when(ids.isNotNull(), text)


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("int64")


def _slices(lists: pa.Array, upto: np.ndarray, most: int) -> Iterator[pa.Array]:
    """Some arrays of a batch at a time, or a single larger one; `upto` is their running size from 0."""
    at = 0
    while at < len(lists):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        yield lists.slice(at, stop - at)
        at = stop


def _encoded(
    lists: pa.Array, coder: bpe.Coder, whole: list[str] | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids of the distinct tokens of a slice, their ends, the token of each element, the size of each list.

    The lists hold tokens or, with `whole`, parts of texts that are cut here. What is worked out in between takes
    many times the bytes of the texts, so it is made for a slice of a batch at a time.
    """
    lengths = pc.fill_null(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False)
    upto = np.append(0, np.cumsum(lengths, dtype=np.int64))[np.append(0, np.cumsum(_sizes(lists)))]
    for some in _slices(lists, upto, SLICE_BYTES):
        tokens, sizes = some.flatten(), _sizes(some)
        if whole is not None:
            tokens, cuts = pretokenise.cut(tokens, whole)
            sizes = np.diff(np.append(0, np.cumsum(cuts))[np.cumsum(sizes)], prepend=0)
        found = tokens.dictionary_encode()
        ids, lengths = coder.encode(found.dictionary)
        yield ids, np.cumsum(lengths, dtype=np.int64), found.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes


def _gathered(lists: pa.Array, coder: bpe.Coder, whole: list[str] | None = None) -> pa.Array:
    """Ids of each list."""
    found, numbers = [np.empty(0, "int32")], [np.zeros(1, "int64")]
    for ids, ends, of, sizes in _encoded(lists, coder, whole):
        lengths = np.diff(ends, prepend=0)[of]
        # Place of each id in the dictionary's ids: where its token starts, and on from there.
        upto = np.cumsum(lengths)
        at = np.repeat(ends[of] - upto, lengths) + np.arange(int(lengths.sum()))
        found.append(ids[at].astype("int32"))
        numbers.append(np.diff(np.append(0, upto)[np.cumsum(sizes)], prepend=0))
    offsets = np.cumsum(np.concatenate(numbers))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))


def _counted(lists: pa.Array, coder: bpe.Coder, whole: list[str] | None = None) -> pa.Array:
    """Number of ids of each list."""
    numbers = [np.empty(0, "int64")]
    for _, ends, of, sizes in _encoded(lists, coder, whole):
        upto = np.append(0, np.cumsum(np.diff(ends, prepend=0)[of]))
        numbers.append(np.diff(upto[np.cumsum(sizes)], prepend=0))
    return pa.array(np.concatenate(numbers), pa.int32())


def special_tokens(spark: SparkSession, encoder: Encoder) -> DataFrame:
    """(token, id) of an encoder."""
    return spark.createDataFrame(list(encoder.special.items()), "token string, id long")


def encode_docs(df: DataFrame, encoder: Encoder) -> DataFrame:
    """(ord, input_ids) of every non-blank document. No shuffle."""
    text = strip_space(F.col("text"))
    return df.filter(text != "").select("ord", encoder.encode(text).alias("input_ids"))


def encode_pretokens(counts: DataFrame, encoder: Encoder) -> DataFrame:
    """(token, n, ids) from (token, n): each distinct pre-token is merged once in the whole job."""
    return counts.select("token", "n", encoder.ids_of(F.array("token")).alias("ids"))


def encode_docs_by_join(df: DataFrame, encoder: Encoder) -> DataFrame:
    """The same ids, with each distinct pre-token merged once in the whole job and joined back.

    For texts with long or many rare tokens. Frequent pre-tokens, the only ones that can be skewed,
    are joined by broadcast, the others by shuffle; the ids of a document are flattened in place order.
    """
    text = strip_space(F.col("text"))
    tokens = df.filter(text != "").select("ord", F.posexplode(encoder.pretokens(text)).alias("pos", "token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    table = materialise(encode_pretokens(counts, encoder), "encoded-pretokens")
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot, cold = split_hot(table, total)
    first = tokens.join(hot.select("token", "ids"), "token").unionByName(
        tokens.join(hot, "token", "left_anti").join(cold.select("token", "ids"), "token")
    )
    gathered = first.groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("parts"))
    return gathered.select("ord", F.flatten("parts.ids").alias("input_ids"))


def decode_docs(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    """(ord, text) from (ord, input_ids)."""
    return encoded.select("ord", encoder.decode(F.col("input_ids")).alias("text"))


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return df
    return first_n(df.filter(strip_space(F.col("text")) != ""), limit)


def tokenize(
    df: DataFrame, encoder: Encoder, max_seq_len: int = fx.BLOCK_SIZE,
    limit: int | None = None,
) -> DataFrame:
    """(ord, input_ids, length): ids cut to max_seq_len."""
    encoded = encode_docs(_limited(df, limit), encoder)
    ids = F.slice("input_ids", 1, max_seq_len)
    return encoded.select("ord", ids.alias("input_ids")).withColumn(
        "length", F.size("input_ids")
    )


def tokenize_ext(
    df: DataFrame, encoder: Encoder, max_seq_len: int = fx.BLOCK_SIZE,
    limit: int | None = None,
) -> DataFrame:
    """(ord, input_ids, length, n_tokens): bos + ids + eos; a cut text still ends with eos.

    n_tokens counts the ids without bos and eos and before the cut.
    """
    encoded = encode_docs(_limited(df, limit), encoder)
    eos = F.array(F.lit(encoder.eos))
    room = F.slice("input_ids", 1, max_seq_len - 2)
    # With bos in front, the last kept place is always eos: cut or not.
    ids = F.concat(F.array(F.lit(encoder.bos)), room, eos)
    cut = encoded.select("ord", ids.alias("cut"), F.size("input_ids").alias("n_tokens"))
    return cut.select("ord", F.col("cut").alias("input_ids"), F.size("cut").alias("length"), "n_tokens")


def token_metrics() -> dict[str, Column]:
    """Length statistics as aggregates that the write of the tokens collects; see `token_length_stats`."""
    p50, p95, p99 = (F.percentile("n_tokens", p) for p in (0.5, 0.95, 0.99))
    return {
        "docs_counted": F.count(F.lit(1)), "avg_tokens": F.avg("n_tokens"), "median_tokens": p50, "p95_tokens": p95,
        "p99_tokens": p99, "max_tokens": F.max("n_tokens").cast("bigint"), "min_length": F.min("length").cast("bigint"),
        "max_length": F.max("length").cast("bigint"), "avg_length": F.avg("length"),
    }


def stats_of_metrics(spark: SparkSession, metrics: dict) -> DataFrame:
    kinds = {"docs_counted": "bigint", "avg_tokens": "double", "median_tokens": "double", "p95_tokens": "double",
             "p99_tokens": "double", "max_tokens": "bigint"}
    return spark.createDataFrame([tuple(metrics[k] for k in kinds)], ", ".join(f"{k} {t}" for k, t in kinds.items()))


def token_counts(df: DataFrame, encoder: Encoder, max_docs: int | None = None) -> DataFrame:
    """(ord, length): ids per non-blank document, without bos and eos, not cut."""
    rows = df if max_docs is None else first_n(df, max_docs)
    rows = rows.filter(strip_space(F.col("text")) != "")
    return rows.select("ord", encoder.count(F.col("text")).alias("length"))


def token_length_stats(
    df: DataFrame, encoder: Encoder, max_docs: int | None = None
) -> DataFrame:
    """Token counts per document without bos/eos and without truncation: one row."""
    from corpusloom.operators.stats import length_counts, quantiles

    counts = length_counts(token_counts(df, encoder, max_docs).select("length"))
    p50, p95, p99 = quantiles(0.5, 0.95, 0.99)
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("docs_counted"),
        F.try_divide(F.sum(F.col("length") * F.col("n")).cast("double"), F.sum("n")).alias("avg_tokens"),
        p50.alias("median_tokens"), p95.alias("p95_tokens"), p99.alias("p99_tokens"),
        F.max("length").cast("bigint").alias("max_tokens"),
    )
