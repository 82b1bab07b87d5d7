"""Byte-pair merges: trained by Spark aggregates, applied to distinct pre-tokens.

Words stay a DataFrame of (word, n, symbols); `symbols` is one string in which every symbol stands
between its own pair of brackets, "<a><b>". The brackets are characters the byte alphabet does not
contain.

The first merges touch most words. They are worked out by passes over all words, in arrays of symbol
numbers: a pass takes a step per merge, not one per word, and nothing is listed or shuffled by pair.

Later training keeps an index from each pair to the words that hold it, sorted by pair, so that a round reads
only the words that its merges touch. These words give the changes of the pair counts; the most
frequent pairs and their counts, a table of bounded size, are kept by the driver, which picks the next
merges. After a number of merges the words are rewritten and the index is built again: the only passes
over all words.
"""

from __future__ import annotations

import functools
import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions.text import let
from corpusloom.session import materialise

OPEN, CLOSE = "\u2039", "\u203a"
#: Most frequent pairs that the driver keeps, merges guessed per round, merges between rewrites.
TRACKED, GUESSES, REWRITE_EVERY = 100_000, 128, 512
#: First merges, learned by passes over all words.
SCANNED = 128

Pair = tuple[str, str]


# --- bytes and symbols ----------------------------------------------------------


def byte_alphabet() -> dict[int, str]:
    """The published printable stand-in of every byte value."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def byte_order() -> list[int]:
    """Byte values in the order of their ids: the printable ones first."""
    alphabet = byte_alphabet()
    return sorted(range(256), key=lambda b: (alphabet[b] != chr(b), b))


def byte_symbols(word: Column) -> Column:
    """UTF-8 bytes of a word as bracketed symbols."""
    names = F.lit([f"{OPEN}{byte_alphabet()[b]}{CLOSE}" for b in range(256)])

    def symbols(digits: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2))
        return F.transform(
            starts,
            lambda i: F.get(names, F.conv(F.substr(digits, i, F.lit(2)), 16, 10).cast("int")),
        )

    return F.array_join(let(F.hex(F.encode(word, "UTF-8")), symbols), "")


def split_symbols(symbols: Column) -> Column:
    return F.split(F.btrim(symbols, F.lit(OPEN + CLOSE)), CLOSE + OPEN)


def bracketed(symbols: Iterable[str]) -> str:
    return "".join(f"{OPEN}{s}{CLOSE}" for s in symbols)


def unbracketed(symbols: str) -> list[str]:
    return symbols[1:-1].split(CLOSE + OPEN)


def merge_symbols(symbols: list[str], ranks: dict[Pair, int]) -> list[str]:
    """Joins neighbours by falling rank, the leftmost first, until no pair has a rank.

    A heap of (rank, place) over a linked list, so a token of n symbols costs n log n.
    """
    n, out = len(symbols), list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [
        (r, i, out[i], out[i + 1]) for i in range(n - 1) if (r := ranks.get((out[i], out[i + 1]))) is not None
    ]
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        # Entries of pairs that other merges have changed are left in the heap and skipped here.
        if gone[i] or j >= n or out[i] != left or out[j] != right:
            continue
        out[i], gone[j], after[i] = left + right, True, after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (r := ranks.get((out[k], out[after[k]]))) is not None:
                heapq.heappush(heap, (r, k, out[k], out[after[k]]))
    return [s for s, lost in zip(out, gone, strict=True) if not lost]


# --- training -------------------------------------------------------------------


def word_symbols(counts: DataFrame) -> DataFrame:
    """(word, n, symbols) from (token, n), in single bytes."""
    return counts.filter(F.col("token") != "").select(
        F.col("token").alias("word"), "n", byte_symbols(F.col("token")).alias("symbols")
    )


def word_pairs(words: DataFrame) -> DataFrame:
    """(pair, times, word, n, symbols): the pairs of neighbours of each word, each once."""

    def pairs(s: Column) -> Column:
        return F.zip_with(
            F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, 2, F.size(s)),
            lambda a, b: F.concat(F.lit(OPEN), a, F.lit(CLOSE + OPEN), b, F.lit(CLOSE)),
        )

    each = words.select("word", "n", "symbols", let(split_symbols(F.col("symbols")), pairs).alias("pairs"))
    one = each.select("*", F.explode(F.array_distinct("pairs")).alias("pair"))
    times = F.size("pairs") - F.size(F.array_remove("pairs", F.col("pair")))
    return one.select("pair", times.alias("times"), "word", "n", "symbols")


class _Counts:
    """Counts of pairs and the most frequent one, ties to the pair that sorts first."""

    def __init__(self, counts: dict[Pair, int], floor: tuple[int, Pair] | None):
        #: Pairs that are not kept come after `floor`, by falling count and name.
        self.n, self.floor = counts, floor
        self._heap = [(-n, pair) for pair, n in counts.items()]
        heapq.heapify(self._heap)

    def add(self, changes: dict[Pair, int]) -> None:
        for pair, change in changes.items():
            self.n[pair] = n = self.n.get(pair, 0) + change
            heapq.heappush(self._heap, (-n, pair))

    def head(self, known: set[str], most: int) -> list[Pair]:
        """The next pairs that spell no known symbol, and each another one; none beyond the floor."""
        taken: list[tuple[int, Pair]] = []
        spelt: set[str] = set()
        while self._heap and len(taken) < most:
            n, pair = entry = self._heap[0]
            if n >= 0 or (self.floor and entry > self.floor):
                break
            heapq.heappop(self._heap)
            # Entries of earlier counts stay in the heap until they come up.
            if self.n[pair] == -n and pair[0] + pair[1] not in known and entry not in taken[-1:]:
                taken.append(entry)
        for entry in taken:
            heapq.heappush(self._heap, entry)
        return [p for _, p in taken if not (p[0] + p[1] in spelt or spelt.add(p[0] + p[1]))]


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words as numbers from 1, a 0 before, between and after words; the word of each place."""
    words = words.cast(pa.large_string())
    ends = np.frombuffer(words.buffers()[1], "int64")[words.offset : words.offset + len(words) + 1]
    sizes, data = np.diff(ends), np.frombuffer(words.buffers()[2] or b"", "uint8")[ends[0] : ends[-1]]
    of = np.repeat(np.arange(len(words), dtype="int32"), sizes)
    symbols = np.zeros(len(data) + len(words) + 1, "int32")
    symbols[np.arange(len(data)) + of + 1] = data.astype("int32") + 1
    return symbols, np.append(np.int32(0), np.repeat(np.arange(len(words), dtype="int32"), sizes + 1))


def _places(symbols: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where a merge joins a symbol and the next one, the leftmost first."""
    at = np.flatnonzero(symbols[:-1] == left)
    at = at[symbols[at + 1] == right]
    if left == right and len(at):
        # Every second place of a run of equal symbols.
        begins = np.diff(at, prepend=-2) > 1
        at = at[(at - at[begins][np.cumsum(begins) - 1]) % 2 == 0]
    return at


def _joined(symbols: np.ndarray, of: np.ndarray, at: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(at):
        return symbols, of
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    symbols[at] = made
    return symbols[keep], of[keep]


class _Scan:
    """All words, read once a round, and the merges learned since; the counts of all pairs are kept."""

    def __init__(self, words: DataFrame):
        self.words = materialise(words.select("word", "n"), "words")
        self.pending: list[Pair] = []
        self._names = ["", *(byte_alphabet()[b] for b in range(256))]
        names = self._names

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(257 * 257, "int64")
            for rows in batches:
                symbols, of = _flat(rows.column(0))
                n = rows.column(1).to_numpy(zero_copy_only=False)
                inside = np.flatnonzero((symbols[:-1] > 0) & (symbols[1:] > 0))
                pairs = symbols[inside] * 257 + symbols[inside + 1]
                found += np.bincount(pairs, n[of[inside]], len(found)).astype("int64")
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], ["pair", "n"])

        sums = self.words.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        # At most a row per pair of bytes.
        counts = {(names[r.pair // 257], names[r.pair % 257]): r.n for r in sums.collect()}
        self.counts = _Counts(counts, None)

    def changes(self, batch: list[Pair]) -> list[dict[Pair, int]]:
        """How the counts change with each merge of a sequence, from one pass over the words."""
        names = [*self._names, *(a + b for a, b in batch)]
        number = {s: i for i, s in enumerate(names)}
        steps = [(number[a], number[b], number[a + b]) for a, b in [*self.pending, *batch]]
        old, width = len(self.pending), len(names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Per merge: pairs lost after and before its places, pairs won after and before them; and its places.
            found = np.zeros((len(steps) - old, 4, width), "int64")
            places = np.zeros(len(steps) - old, "int64")
            for rows in batches:
                symbols, of = _flat(rows.column(0))
                n = rows.column(1).to_numpy(zero_copy_only=False)
                for step, (left, right, made) in enumerate(steps, -old):
                    at = _places(symbols, left, right)
                    if step < 0 or not len(at):
                        symbols, of = _joined(symbols, of, at, made)
                        continue
                    times = n[of[at]]
                    places[step] += times.sum()
                    # Between two places side by side there is one pair, not two.
                    first = np.diff(at, prepend=-3) > 2
                    sides = [(symbols[at + 2], -times), (symbols[at[first] - 1], -times[first])]
                    symbols, of = _joined(symbols, of, at, made)
                    at = at - np.arange(len(at))
                    sides += [(symbols[at + 1], times), (symbols[at[first] - 1], times[first])]
                    for kind, (other, change) in enumerate(sides):
                        found[step, kind] += np.bincount(other, change, width).astype("int64")
            found[:, :, 0] = 0  # the ends of words
            found[:, 0, 0] = places
            step, kind, other = np.nonzero(found)
            columns = [pa.array(c, pa.int32()) for c in (step, kind, other)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found[step, kind, other], pa.int64())], ["step", "kind", "other", "n"]
            )

        deltas = self.words.mapInArrow(run, "step int, kind int, other int, n long")
        out: list[Counter] = [Counter() for _ in batch]
        # At most four rows per merge and symbol of the vocabulary.
        for step, kind, other, n in deltas.groupBy("step", "kind", "other").agg(F.sum("n").alias("n")).collect():
            (left, right), name = batch[step], names[other]
            if other == 0:
                out[step][left, right] -= n
            else:
                out[step][[(right, name), (name, left), (left + right, name), (name, left + right)][kind]] += n
        return out

    def learn(self, pair: Pair, change: dict[Pair, int]) -> None:
        self.pending.append(pair)
        self._names.append(pair[0] + pair[1])
        self.counts.add(change)

    def rewritten(self) -> DataFrame:
        """All words with the pending merges applied."""
        return _rewritten(self.words.select("word", "n", byte_symbols(F.col("word")).alias("symbols")), self.pending)


def _rewritten(words: DataFrame, merges: list[Pair]) -> DataFrame:
    """(word, n, symbols) with merges applied."""
    ranks = {p: i for i, p in enumerate(merges)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            merged = [bracketed(merge_symbols(unbracketed(s), ranks)) for s in rows.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(merged, pa.string())], ["word", "n", "symbols"]
            )

    if not ranks:
        return words
    return words.select("word", "n", "symbols").mapInArrow(run, "word string, n long, symbols string")


class _Index:
    """The words at one time, listed under each of their pairs, and the merges learned since."""

    def __init__(self, words: DataFrame, tracked: int):
        self.words = materialise(words, "words")
        listed = word_pairs(self.words).repartitionByRange("pair").sortWithinPartitions("pair")
        self.listed = materialise(listed, "pair-index")
        sums = self.listed.groupBy("pair").agg(F.sum(F.col("n") * F.col("times")).alias("n"))
        sides = split_symbols(F.col("pair"))
        ranked = sums.select(F.get(sides, F.lit(0)).alias("left"), F.get(sides, F.lit(1)).alias("right"), "n")
        rows = ranked.orderBy(F.desc("n"), "left", "right").limit(tracked).collect()
        floor = (-rows[-1].n, (rows[-1].left, rows[-1].right)) if len(rows) == tracked else None
        self.counts = _Counts({(r.left, r.right): r.n for r in rows}, floor)
        self.pending: list[Pair] = []
        self._made: dict[str, str] = {}  # symbol made since -> a listed pair of all words that hold it

    def _listed_under(self, pair: Pair) -> str:
        """A pair of the index that all words with the given pair hold."""
        for symbol in pair:
            if symbol in self._made:
                return self._made[symbol]
        return bracketed(pair)

    def changes(self, batch: list[Pair]) -> list[dict[Pair, int]]:
        """How the counts change with each merge of a sequence, from the words that it touches."""
        wanted = {self._listed_under(p) for p in batch}
        touched = self.listed.filter(F.col("pair").isin(sorted(wanted))).select("pair", "n", "symbols")
        old = {p: i for i, p in enumerate(self.pending)}
        steps = {p: i for i, p in enumerate(batch)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for rows in batches:
                for key, n, symbols in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    first = unbracketed(symbols)
                    # A word that is listed under several of the pairs counts under the smallest one.
                    if len(wanted) > 1 and min(wanted & {bracketed(p) for p in zip(first, first[1:])}) != key:
                        continue
                    now = merge_symbols(first, old) if old else first
                    while hit := [steps[p] for p in zip(now, now[1:]) if p in steps]:
                        step = min(hit)
                        then = merge_symbols(now, {batch[step]: 0})
                        for sign, word in ((-n, now), (n, then)):
                            for pair in zip(word, word[1:]):
                                found[step, *pair] += sign
                        now = then
            kept = [(*k, n) for k, n in found.items() if n]
            columns = list(zip(*kept)) if kept else [[], [], [], []]
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["step", "left", "right", "n"]
            )

        deltas = touched.mapInArrow(run, "step int, left string, right string, n long")
        out: list[dict[Pair, int]] = [{} for _ in batch]
        # Neighbours of the merged symbols: at most a few per merge and symbol of the vocabulary.
        for step, left, right, n in deltas.groupBy("step", "left", "right").agg(F.sum("n").alias("n")).collect():
            out[step][left, right] = n
        return out

    def learn(self, pair: Pair, change: dict[Pair, int]) -> None:
        self._made[pair[0] + pair[1]] = self._listed_under(pair)
        self.pending.append(pair)
        # All of a pair with a symbol made since is seen; of the others only the kept ones are known.
        made = self._made
        self.counts.add({p: n for p, n in change.items() if p in self.counts.n or p[0] in made or p[1] in made})

    def rewritten(self) -> DataFrame:
        """All words with the pending merges applied."""
        return _rewritten(self.words, self.pending)


def train_bpe(
    counts: DataFrame, merges: int = 200, tracked: int = TRACKED, guesses: int = GUESSES,
    rewrite_every: int = REWRITE_EVERY, scanned: int = SCANNED,
) -> tuple[DataFrame, DataFrame]:
    """From (token, n): the merges (rank, left, right) and the encoded words, which are made when they are read.

    The most frequent pair is merged, ties going to the pair that sorts first; a pair that spells a known
    symbol is never learned. Fewer merges than asked for are learned if no pair is left.

    A round guesses a run of merges from the counts so far and has their changes worked out one after
    the other. As long as the next guess is still the most frequent pair it is learned; the rest of
    the guesses is thrown away. So the merges are those of one-by-one training, whatever is guessed.
    The first `scanned` merges come from passes over all words, the others from the index.
    """
    index = _Scan(counts.filter(F.col("token") != "").select(F.col("token").alias("word"), "n"))
    known = set(byte_alphabet().values())
    learned: list[Pair] = []
    guess = 2
    while len(learned) < merges:
        batch = []
        if isinstance(index, _Scan):
            if len(learned) >= scanned:
                index = _Index(index.rewritten(), tracked)
            batch = index.counts.head(known, min(guess, merges - len(learned)))
        # The first merges shorten the words most: they are rewritten sooner.
        elif len(index.pending) < min(rewrite_every, 64 + len(learned) // 2):
            batch = index.counts.head(known, min(guess, merges - len(learned)))
        if batch:
            right = 0
            for pair, change in zip(batch, index.changes(batch), strict=True):
                if index.counts.head(known, 1) != [pair]:
                    break
                index.learn(pair, change)
                learned.append(pair)
                known.add(pair[0] + pair[1])
                right += 1
            guess = min(guesses, max(2, 2 * right))
        elif isinstance(index, _Scan):
            break  # all pairs are counted: none is left
        elif index.pending:
            index = _Index(index.rewritten(), tracked)
        elif index.counts.floor:
            # All kept pairs spell known symbols.
            tracked *= 4
            index = _Index(index.words, tracked)
        else:
            break
    rows = [(i, left, right) for i, (left, right) in enumerate(learned)]
    table = counts.sparkSession.createDataFrame(rows, "rank bigint, left string, right string")
    return table, index.rewritten()


# --- vocabulary and encoding ------------------------------------------------------


def bpe_vocab(merges: DataFrame) -> DataFrame:
    """(id, token): the 256 bytes in the published order, the merged symbols by rank, the end of text."""
    alphabet = byte_alphabet()
    spark = merges.sparkSession
    singles = spark.createDataFrame([(i, alphabet[b]) for i, b in enumerate(byte_order())], "id long, token string")
    learned = merges.select((F.col("rank") + 256).alias("id"), F.concat("left", "right").alias("token"))
    end = merges.agg((F.count(F.lit(1)) + 256).alias("id"), F.lit(fx.END_OF_TEXT).alias("token"))
    return singles.unionByName(learned).unionByName(end)


class Coder:
    """Ids of distinct tokens. Short ones are merged together, in arrays; long ones each by a heap."""

    #: Bytes of a token from which on it is merged on its own; symbols up to which ranks are a square table.
    LONG, SQUARE = 100, 1_000

    def __init__(self, merges: tuple[Pair, ...], special: tuple[tuple[str, int], ...]):
        alphabet = byte_alphabet()
        self._byte = [alphabet[b] for b in range(256)]
        self._ranks = {pair: i for i, pair in enumerate(merges)}
        self._ids = {alphabet[b]: i for i, b in enumerate(byte_order())}
        self._ids |= {a + b: 256 + i for i, (a, b) in enumerate(merges)}
        self._special = dict(special)
        # Symbols are numbered by id from 1; 0 is the start of a word.
        self._first = np.array([0, *(self._ids[s] + 1 for s in self._byte)], "int32")
        self._width, self._none = 257 + len(merges), len(merges)
        # As trained: no two merges make one symbol, and a side of a merge is known before it.
        at = [(self._ids.get(a, self._none + 256), self._ids.get(b, self._none + 256)) for a, b in merges]
        self._trained = len(self._ids) == 256 + len(merges) and all(max(p) < 256 + i for i, p in enumerate(at))
        codes = np.array([(a + 1) * self._width + b + 1 for a, b in at], "int64")
        if self._width <= self.SQUARE:
            self._table = np.full(self._width**2, self._none, "int32")
            self._table[codes[codes < len(self._table)]] = np.flatnonzero(codes < len(self._table))
        else:
            self._order = np.argsort(codes).astype("int32")
            self._codes = codes[self._order]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where it has none."""
        codes = left.astype("int64") * self._width + right
        if self._width <= self.SQUARE:
            return self._table[codes]
        at = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        return np.where(self._codes[at] == codes, self._order[at], np.int32(self._none))

    def _short(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and their numbers.

        A round joins, in each word, all places of its pair of least rank; words without one leave.
        """
        symbols, of = _flat(words)
        symbols, of = self._first[symbols[:-1]], of[1:]
        out, whose = [np.empty(0, "int32")], [np.empty(0, "int32")]
        while len(symbols):
            rank = self._rank(symbols, np.append(symbols[1:], np.int32(0)))
            begins = np.flatnonzero(symbols == 0)
            best = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(symbols))))
            done = best == self._none
            ready = done & (symbols > 0)
            out.append(symbols[ready])
            whose.append(of[ready])
            at = np.flatnonzero((rank == best) & ~done)
            if len(at):
                # Every second place of a run of equal symbols.
                runs = np.diff(at, prepend=-2) > 1
                at = at[(at - at[runs][np.cumsum(runs) - 1]) % 2 == 0]
            symbols[at] = rank[at] + 257
            keep = ~done
            keep[at + 1] = False
            symbols, of = symbols[keep], of[keep]
        ids, words_of = np.concatenate(out), np.concatenate(whose)
        return ids[np.argsort(words_of, kind="stable")] - 1, np.bincount(words_of, minlength=len(words))

    def _long(self, token: str) -> list[int]:
        if token in self._special:
            return [self._special[token]]
        symbols = merge_symbols([self._byte[b] for b in token.encode()], self._ranks)
        return [self._ids[s] for s in symbols]

    def encode(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all tokens, one after the other, and their numbers."""
        own = pc.is_in(tokens, pa.array(list(self._special), tokens.type)).to_numpy(zero_copy_only=False)
        own = own | (pc.binary_length(tokens).to_numpy(zero_copy_only=False) >= self.LONG) | (not self._trained)
        if not own.any():
            return self._short(tokens)
        alone = [self._long(t) for t in tokens.filter(pa.array(own)).to_pylist()]
        ids, sizes = self._short(tokens.filter(pa.array(~own)))
        lengths = np.empty(len(tokens), "int64")
        lengths[own], lengths[~own] = [len(a) for a in alone], sizes
        out = np.empty(int(lengths.sum()), "int32")
        mine = np.repeat(own, lengths)
        out[mine] = np.fromiter((i for a in alone for i in a), "int32", int(mine.sum()))
        out[~mine] = ids
        return out, lengths


@functools.lru_cache(maxsize=2)
def coder(merges: tuple[Pair, ...], special: tuple[tuple[str, int], ...]) -> Coder:
    """One per worker and vocabulary."""
    return Coder(merges, special)


def load_merges(merges: DataFrame, most: int = fx.BASE_VOCAB_SIZE) -> tuple[Pair, ...]:
    """The merges in rank order; their number is a parameter of the training, checked here."""
    rows = merges.orderBy("rank").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} merges")
    return tuple((r["left"], r["right"]) for r in rows)
