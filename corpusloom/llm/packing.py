"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits one sequence. The program asks for the
fewest sequences that cover every length as often as it occurs. Multiplicative weights price all
lengths, and one knapsack dynamic program per round finds, for every length, the configuration of the
highest price that holds it. Configurations that waste nothing are columns at the program's bound; they
are taken in whole sequences, as often as their pieces last, which rounds the solution as it grows.
Lengths that many columns ask for lose weight, so the next round finds others. What is left over is
placed best fit, longest first. All of this sees only the histogram, at most `capacity` numbers. Spark
counts the histogram, numbers the pieces of each length, and looks up the place of each number.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise
from corpusloom.llm.token_ids import crc_of, tokenizer

#: Rounds of multiplicative weights, and how much weight the length most asked for loses in one.
ROUNDS, STEP = 100, 0.1

Configuration = tuple[tuple[int, int], ...]  # (length, times), longest first


def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest price within each room, and the last length taken there (a place, or -1 for none).

    lengths: rising. A length may be taken any number of times.
    """
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]) if len(lengths) else capacity + 1, capacity + 1):
        total = value[room - lengths[: fits[room]]] + price[: fits[room]]
        best = int(total.argmax())
        if total[best] > value[room - 1]:
            value[room], last[room] = total[best], best
        else:
            value[room] = value[room - 1]
    return value, last


def _traced(last: np.ndarray, lengths: list[int], room: int) -> Counter:
    """The configuration behind the price of a room."""
    found: Counter = Counter()
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            length = lengths[last[room]]
            found[length] += 1
            room -= length
    return found


def solve(
    histogram: dict[int, int], capacity: int, rounds: int = ROUNDS
) -> tuple[dict[Configuration, int], dict[int, int]]:
    """Whole sequences per configuration, and the pieces of each length that are left over.

    With weight 1 a length costs length / capacity, which is feasible for the dual program, so a column
    without waste is at the bound. Every length is priced in every round.
    """
    left = {n: k for n, k in histogram.items() if k}
    weight = dict.fromkeys(left, 1.0)
    found: Counter = Counter()
    for _ in range(rounds):
        lengths = np.array(sorted(n for n, k in left.items() if k), np.int64)
        if not len(lengths):
            break
        names = lengths.tolist()
        _, last = knapsack(lengths, lengths / capacity * np.array([weight[n] for n in names]), capacity)
        asked: Counter = Counter()
        for n in reversed(names):
            column = _traced(last, names, capacity - n)
            column[n] += 1
            asked.update(column.keys())
            copies = min(left[k] // times for k, times in column.items())
            if copies and sum(k * times for k, times in column.items()) == capacity:
                found[tuple(sorted(column.items(), reverse=True))] += copies
                for k, times in column.items():
                    left[k] -= copies * times
        most = max(asked.values())
        for k, times in asked.items():
            weight[k] *= math.exp(-STEP * times / most)
    return dict(found), {n: k for n, k in left.items() if k}


def best_fit(histogram: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Best fit, longest first, for all pieces of a length at once."""
    by_room: dict[int, dict[Configuration, int]] = {}
    rooms: list[int] = []

    def add(room: int, key: Configuration, copies: int) -> None:
        if room not in by_room:
            by_room[room] = {}
            bisect.insort(rooms, room)
        by_room[room][key] = by_room[room].get(key, 0) + copies

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                key, copies = by_room[room].popitem()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, key, copies = capacity, (), -(-left // (capacity // length))
            each = min(room // length, max(1, left // copies))
            used = min(copies, left // each)
            if used < copies:
                if key:
                    add(room, key, copies - used)
            add(room - each * length, (*key, (length, each)), used)
            left -= used * each
    return {k: n for group in by_room.values() for k, n in group.items()}


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[Configuration, int]]:
    """(configuration, sequences) that hold every piece exactly once; never more than best fit alone takes."""
    columns, left = solve(histogram, capacity, rounds)
    packed = [*columns.items(), *best_fit(left, capacity).items()]
    alone = [*best_fit({n: k for n, k in histogram.items() if k}, capacity).items()]
    return min(packed, alone, key=lambda x: sum(copies for _, copies in x))


def quality(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> dict[str, float]:
    """Sequences of the plan, the bound of the program, and the share of the pieces that its columns place."""
    _, left = solve(histogram, capacity, rounds)
    pieces = sum(histogram.values())
    return {
        "sequences": sum(copies for _, copies in plan(histogram, capacity, rounds)),
        "bound": -(-sum(n * k for n, k in histogram.items()) // capacity),
        "placed_by_columns": 1 - sum(left.values()) / pieces if pieces else 1.0,
    }


@dataclass(frozen=True)
class Places:
    """For pieces numbered from 0 within their length: sequence and offset, by binary search."""

    key: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, packed: list[tuple[Configuration, int]]) -> Places:
        taken: dict[int, int] = {}
        rows, base = [], 0
        for key, copies in packed:
            offset = 0
            for length, times in key:
                start = taken.get(length, 0)
                rows.append(((length << 48) + start, start, base, times, offset))
                taken[length] = start + copies * times
                offset += length * times
            base += copies
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return cls(*np.ascontiguousarray(table.T))

    def look_up(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) + number, "right") - 1
        copy, slot = np.divmod(number - self.first[at], self.times[at])
        return self.sequence[at] + copy, self.offset[at] + slot * length


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and end id, cut only if longer."""

    def cut(batches):
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tok.array(text.as_py(), end_id)
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), crc_of(part)))
            columns = zip(*rows) if rows else ([],) * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return id_text(docs).mapInArrow(cut, _PIECES)


def pack(pieces: DataFrame, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to a table with a `length` from 1 to the capacity.

    Any piece has exactly one place; sequences are filled from 0 without gaps. Pieces of equal length
    are alike, so ties do not matter. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    staged = materialise(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = staged.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    # Numbers within a length: rows of earlier parts, then the place in the own part.
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    own = Window.partitionBy("_part", "length").orderBy(*columns)
    numbered = (
        staged.withColumn("_own", F.row_number().over(own) - 1)
        .join(bases, ["_part", "length"])
        .select(*columns, (F.col("_base") + F.col("_own")).alias("_number"))
    )
    histogram = {r[0]: r[1] for r in staged.groupBy("length").count().collect()}  # at most `capacity` rows
    shipped = spark.sparkContext.broadcast(Places.of(plan(histogram, capacity, rounds)))

    def place(batches):
        for batch in batches:
            whole = dict(zip(batch.schema.names, batch.columns))
            sequence, offset = shipped.value.look_up(
                whole["length"].to_numpy().astype(np.int64), whole["_number"].to_numpy().astype(np.int64)
            )
            kept = [whole[c] for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Whole documents in as few sequences of at most `capacity` tokens as the program finds.

    A null text counts as empty (its end id only); a null doc_id stays null; repeated rows are
    packed one by one.
    """
    return pack(cut_pieces(docs, tokenizer_path, end_id, capacity), capacity)
