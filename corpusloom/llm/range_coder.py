"""Token-id files written by an adaptive context-mixing range coder.

The next id is coded with a mixture of three distributions. Order 0 is the frequencies of all ids so far
(ids not seen yet share a part). Orders 1 and 2 are looked up by the one and the two ids before, and put
their mass on the id that they last saw there. How much mass each of them gets is learned per context,
a context being the confidences of both and whether they agree. The mixed distribution's interval of
the id narrows the range of a 64-bit coder that carries into what it has put out.

Blocks are independent: each starts with an empty model and has a checksum. Inside a block NumPy works
on lanes, runs of ids side by side that share the one model: a step codes the next id of every lane, and
the model learns from all of them before the next step. The decoder repeats these steps.

A file is a run of blocks and a footer: the blocks' positions and checksums, the documents' (id, length).
Files are written and read in tasks; Spark sorts the documents.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import id_text, materialise, open_shared, shared_folder
from corpusloom.llm.token_ids import tokenizer

#: Ids per block and lanes of a full one.
BLOCK, LANES = 1 << 22, 4096
#: Chunks that a writing task remembers, more than elsewhere: it does little else with its memory.
MEMO_CHUNKS = 900_000
MAGIC = b"CLRC3\n"

# Bits of an order-0 share and of a mixing weight; together 32, so that a mixed share needs no rounding.
_SHARE_BITS, _WEIGHT_BITS = 22, 10
_LEAST_WEIGHT = 16  # of order 0, which alone covers every id
_SURE = 7  # the highest confidence of orders 1 and 2; only an empty cell has 0
_CONTEXTS = 2 * (_SURE + 1) ** 2
_RUN = 32  # shares per entry of the table that finds an id by its share
_CELL_BITS = 20  # rows of the order-2 table
# What a miss or a hit (+ 8) adds to a cell; one that is not sure is set anew on a miss.
_STEP = np.array([0, 0, *[-1] * (_SURE - 1), *[1] * _SURE, 0], np.int32)
_EMPTY, _CELL_MASK = -8, np.uint32((1 << _CELL_BITS) - 1)
_TOTAL, _DIGIT = np.uint64(_SHARE_BITS + _WEIGHT_BITS), np.uint64(16)
_TOP, _WIDE = np.uint64(48), np.uint64(1 << 48)


class _Model:
    """The three predictors of a block of `n` lanes, their mixture, and what they learn from a step."""

    def __init__(self, n: int, alphabet: int):
        # Cells: id * 8 + confidence. What is looked up at random is kept narrow, for the processor's caches.
        self.order1 = np.full(1 << 16, _EMPTY, np.int32)
        self.order2 = np.full(1 << _CELL_BITS, _EMPTY, np.int32)
        self.at1, self.at2 = np.zeros(n, np.int32), np.zeros(n, np.int64)
        self.counts = np.zeros(alphabet, np.int64)
        self.hits = np.zeros((_CONTEXTS, 4), np.int64)
        self.steps, self.next_refresh, self.recent = 0, 0, []
        self._refresh()

    def _refresh(self) -> None:
        """Order-0 shares and mixing weights from the counts; ever rarer, so the cost grows with the logarithm."""
        if self.recent:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=len(self.counts))
            self.recent = []
        size, total = len(self.counts), 1 << _SHARE_BITS
        seen, kinds = int(self.counts.sum()), int(np.count_nonzero(self.counts))
        # New ids get the share of steps that brought one, as far as it goes round.
        least = max(1, total * (kinds or 1) // (seen + kinds or 1) // size)
        share = least + self.counts * (total - least * size) // max(seen, 1)
        self.edges = np.concatenate([[0], np.cumsum(share)]).astype(np.int32)
        self.edges[-1] = total
        self.at_run = None
        free = (1 << _WEIGHT_BITS) - _LEAST_WEIGHT
        tried = self.hits.sum(axis=1) + 2
        self.weight2 = free * self.hits[:, 2:].sum(axis=1) // tried
        self.weight1 = free * self.hits[:, 1] // tried
        self.weight0 = (1 << _WEIGHT_BITS) - self.weight1 - self.weight2
        self.weight1 <<= _SHARE_BITS
        self.weight2 <<= _SHARE_BITS
        self.next_refresh = self.steps + 1 + self.steps // 10

    def predict(self) -> None:
        """The ids named by orders 1 and 2 (-1: none), and the masses of all three orders."""
        self.cell1, self.cell2 = self.order1.take(self.at1), self.order2.take(self.at2)
        self.id1, self.id2 = self.cell1 >> 3, self.cell2 >> 3
        self.sure1, self.sure2 = self.cell1 & 7, self.cell2 & 7
        agree = (self.id1 == self.id2).view(np.int8) << np.int8(6)
        self.context = (self.sure2 << 3) + self.sure1 + agree
        self.mass0 = self.weight0.take(self.context)
        self.mass1, self.mass2 = self.weight1.take(self.context), self.weight2.take(self.context)

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of x in the mixed distribution."""
        edge = self.edges.take(x)
        share = self.edges.take(x + 1) - edge
        self.same1, self.same2 = self.id1 == x, self.id2 == x
        start = self.mass0 * edge + self.mass1 * (self.id1 < x) + self.mass2 * (self.id2 < x)
        width = self.mass0 * share + self.mass1 * self.same1 + self.mass2 * self.same2
        return start, width

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold the values. What orders 1 and 2 give an id stands before its order-0 part."""
        start1 = self.mass0 * self.edges.take(self.id1, mode="wrap") + self.mass2 * (self.id2 < self.id1)
        start2 = self.mass0 * self.edges.take(self.id2, mode="wrap") + self.mass1 * (self.id1 < self.id2)
        past1, past2 = value >= start1 + self.mass1, value >= start2 + self.mass2
        held1, held2 = (value >= start1) > past1, (value >= start2) > past2
        inner = ((value - self.mass1 * past1 - self.mass2 * past2) // self.mass0).astype(np.int32)
        np.putmask(inner, held1 | held2, 0)
        if self.at_run is None:
            # The last id that starts at or before each run of shares.
            runs = np.bincount((self.edges[1:-1] + _RUN - 1) // _RUN, minlength=(1 << _SHARE_BITS) // _RUN + 1)
            self.at_run = np.cumsum(runs).astype(np.uint16)
        x = self.at_run.take(inner // _RUN).astype(np.int32)
        for _ in range(2):
            x += self.edges.take(x + 1) <= inner
        far = np.flatnonzero(self.edges.take(x + 1) <= inner)
        if len(far):
            x[far] = np.searchsorted(self.edges, inner[far], "right") - 1
        np.putmask(x, held1, self.id1)
        np.putmask(x, held2, self.id2)
        return x

    def learn(self, x: np.ndarray) -> None:
        """After `interval` of the same ids. Lanes that meet in one cell: the last of them sets it."""
        # Outcomes 0: neither order had it, 1: order 1 alone, 2 and 3: order 2.
        same1, same2 = self.same1.view(np.int8), self.same2.view(np.int8)
        outcome = (self.context << 2) + (same1 + (same2 << np.int8(1)))
        self.hits += np.bincount(outcome, minlength=4 * _CONTEXTS).reshape(-1, 4)
        fresh = (x << 3) + 1
        for table, at, cell, sure, same in (
            (self.order1, self.at1, self.cell1, self.sure1, same1),
            (self.order2, self.at2, self.cell2, self.sure2, same2),
        ):
            state = sure + (same << np.int8(3))
            cell += _STEP.take(state)
            np.putmask(cell, state <= 1, fresh)
            table[at] = cell
        mixed = self.at1.view(np.uint32) * np.uint32(0x9E3779B1) + x.view(np.uint32) * np.uint32(0x85EBCA6B)
        self.at1, self.at2 = x, ((mixed ^ (mixed >> np.uint32(15))) & _CELL_MASK).astype(np.int64)
        self.recent.append(x)
        self.steps += 1
        if self.steps >= self.next_refresh:
            self._refresh()


def _shape(n_ids: int) -> tuple[int, int]:
    """Lanes and steps of a block: four times as many lanes as steps, or LANES in a long one."""
    lanes = max(1, min(LANES, math.isqrt(4 * n_ids)))
    return lanes, -(-n_ids // lanes)


def encode_block(ids: np.ndarray) -> bytes:
    """One coded block of ids below 2 ** 16; the last lane is filled up with its first id.

    The alphabet's size, then each lane's number of digits, then the lanes' digits.
    """
    lanes, steps = _shape(len(ids))
    if not steps:
        return b""
    alphabet = int(ids.max()) + 1
    grid = np.full(lanes * steps, int(ids[0]), np.int32)
    grid[: len(ids)] = ids
    model = _Model(lanes, alphabet)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    # A step puts out two digits at most. Digits are kept wider than 16 bits until the carries are in.
    # Lanes are about as far on, so their next digits are kept side by side.
    room = 2 * steps + 1
    digits = np.zeros(lanes * room, np.uint32)
    place = np.arange(lanes)
    for x in np.ascontiguousarray(grid.reshape(lanes, steps).T):
        model.predict()
        start, size = model.interval(x)
        width >>= _TOTAL
        before = low
        low = low + width * start.view(np.uint64)
        width *= size.view(np.uint64)
        carried = np.flatnonzero(low < before)
        digits[place[carried] - lanes] += np.uint32(1)
        # One digit of all lanes that have one; where none is due, the next one overwrites it.
        due = width < _WIDE
        digits[place] = low >> _TOP
        place += due * np.int64(lanes)
        shift = due.view(np.uint8) * _DIGIT
        low <<= shift
        width <<= shift
        short = np.flatnonzero(width < _WIDE)
        while len(short):
            part = low[short]
            at = place[short]
            digits[at] = part >> _TOP
            place[short] = at + lanes
            low[short] = part << _DIGIT
            part = width[short] << _DIGIT
            width[short] = part
            short = short[part < _WIDE]
        model.learn(x)
    # Any value of the last range will do: the least that ends in 48 zero bits.
    before = low
    low = low + (_WIDE - np.uint64(1))
    carried = np.flatnonzero(low < before)
    digits[place[carried] - lanes] += np.uint32(1)
    digits[place] = low >> _TOP
    n = place // lanes + 1
    digits = digits[: lanes * int(n.max())]
    over = np.flatnonzero(digits >> np.uint32(16))
    while len(over):
        digits[over] &= np.uint32(0xFFFF)
        digits[over - lanes] += np.uint32(1)
        over = (over - lanes)[digits[over - lanes] >> np.uint32(16) > 0]
    used = np.arange(len(digits) // lanes) < n[:, None]
    head = np.array([alphabet, *n.tolist()], "<u4").tobytes()
    return head + digits.astype("<u2").reshape(-1, lanes).T[used].tobytes()


def decode_block(data: bytes, n_ids: int) -> np.ndarray:
    """The ids of a coded block. Damage gives other ids or ValueError."""
    lanes, steps = _shape(n_ids)
    if not steps:
        return np.zeros(0, np.uint16)
    if len(data) < 4 * (lanes + 1):
        raise ValueError("a block is cut short")
    head = np.frombuffer(data, "<u4", lanes + 1).astype(np.int64)
    alphabet, n = int(head[0]), head[1:]
    if not 0 < alphabet <= 1 << 16 or len(data) != 4 * (lanes + 1) + 2 * int(n.sum()):
        raise ValueError("the head of a block is damaged")
    # Behind a lane's digits stand others, or zeros: the coder's last range holds any of them.
    digits = np.concatenate([np.frombuffer(data, "<u2", offset=4 * (lanes + 1)), np.zeros(8, np.uint16)])
    ends = np.cumsum(n)
    place = ends - n
    last = len(digits) - 1
    code = np.zeros(lanes, np.uint64)
    for k in range(4):
        code = code << _DIGIT | np.where(place + k < ends, digits.take(place + k, mode="clip"), np.uint16(0))
    place += 4
    width = np.full(lanes, (1 << 64) - 1, np.uint64)
    grid, model = np.empty((steps, lanes), np.uint16), _Model(lanes, alphabet)
    most = (1 << _SHARE_BITS + _WEIGHT_BITS) - 1
    for step in range(steps):
        model.predict()
        width >>= _TOTAL
        x = model.find(np.minimum(code // width, np.uint64(most)).view(np.int64))
        start, size = model.interval(x)
        code -= width * start.view(np.uint64)
        width *= size.view(np.uint64)
        due = width < _WIDE
        more = digits.take(place, mode="clip") * (due & (place < ends))
        shift = due.view(np.uint8) * _DIGIT
        code = code << shift | more
        width <<= shift
        place += due
        short = np.flatnonzero(width < _WIDE)
        while len(short):
            at = place[short]
            more = np.where(at < ends[short], digits[np.minimum(at, last)], np.uint16(0))
            code[short] = code[short] << _DIGIT | more
            place[short] = at + 1
            part = width[short] << _DIGIT
            width[short] = part
            short = short[part < _WIDE]
        grid[step] = x
        model.learn(x)
    return np.ascontiguousarray(grid.T).reshape(-1)[:n_ids]


class FileWriter:
    """Takes documents one by one; keeps at most one block of ids in memory."""

    def __init__(self, stream):
        self.stream, self.blocks, self.docs = stream, [], []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.at = len(MAGIC)
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """One document; ids from 0 to 65535, any other raises ValueError."""
        if len(ids) and (int(ids.max()) >= 1 << 16 or int(ids.min()) < 0):
            raise ValueError("token files hold 16-bit ids")
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        while len(ids):
            part = np.array(ids[: BLOCK - self.n_held], np.uint16)
            self.held.append(part)
            self.n_held += len(part)
            ids = ids[len(part) :]
            if self.n_held == BLOCK:
                self._flush()

    def _flush(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            payload = encode_block(ids)
            self.stream.write(payload)
            self.blocks.append((self.at, len(payload), len(ids), zlib.crc32(ids.astype("<u2"))))
            self.at += len(payload)
            self.held, self.n_held = [], 0

    def close(self) -> int:
        self._flush()
        ids = [d for d, _ in self.docs]
        foot = json.dumps({"blocks": self.blocks, "docs": ids, "lengths": [n for _, n in self.docs]})
        packed = zlib.compress(foot.encode(), 1)
        self.stream.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
        self.stream.close()
        return self.at + len(packed) + 8 + len(MAGIC)


def read_file(source):
    """(doc_id, ids) of a file, block by block. A damaged block raises ValueError."""
    size = source.size()
    tail = bytes(source.read_at(8 + len(MAGIC), size - 8 - len(MAGIC)))
    if tail[8:] != MAGIC:
        raise ValueError("not a token file, or cut short")
    n = int.from_bytes(tail[:8], "little")
    foot = json.loads(zlib.decompress(source.read_at(n, size - 8 - len(MAGIC) - n)))

    def blocks():
        for at, length, n_ids, crc in foot["blocks"]:
            ids = decode_block(bytes(source.read_at(length, at)), n_ids)
            if zlib.crc32(ids.astype("<u2")) != crc:
                raise ValueError(f"the block at {at} is damaged")
            yield ids

    source_blocks, held = blocks(), np.zeros(0, np.uint16)
    for doc_id, length in zip(foot["docs"], foot["lengths"]):
        parts, missing = [], length
        while missing:
            if not len(held):
                held = next(source_blocks)
            parts.append(held[:missing])
            held = held[missing:]
            missing -= len(parts[-1])
        yield doc_id, np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 0, parts: int | None = None) -> DataFrame:
    """Encodes whole texts into files in ascending doc_id order; (part, path, n_ids, n_bytes) per file.

    Null texts are empty (their end id only). Null doc_ids come first, equal ones stay side by side.
    A task that runs twice writes a new file; only the file of the attempt that counted is listed.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = id_text(docs).repartitionByRange(n, F.col("doc_id").asc_nulls_first())
    ordered = texts.sortWithinPartitions(F.col("doc_id").asc_nulls_first()).select(
        "doc_id", "text", F.spark_partition_id().alias("part")
    )

    def write(batches):
        tok, writer = tokenizer(tokenizer_path, MEMO_CHUNKS), None
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tok.arrays(batch.column(1), end_id)):
                if writer is None:
                    part, path = batch.column(2)[0].as_py(), f"{folder}/{uuid.uuid4().hex}.ids"
                    system, place = open_shared(path)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    writer = FileWriter(system.open_output_stream(place, compression=None))
                writer.add(doc_id, ids)
        if writer is not None:
            n_bytes = writer.close()
            columns = [[part], [path], [writer.n_ids], [n_bytes]]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "path", "n_ids", "n_bytes"]
            )

    files = ordered.mapInArrow(write, "part int, path string, n_ids long, n_bytes long")
    return materialise(files, "token-file-list")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from its file, one task per file."""
    # One row per file, so one task can number them; a file holds a whole range partition.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("part", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("start"))
    n = max(1, files.count())

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                system, place = open_shared(path)
                rows = []
                with system.open_input_file(place) as source:
                    for doc_id, ids in read_file(source):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                        start += len(ids)
                columns = zip(*rows) if rows else ([],) * 4
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    spread = listed.repartitionByRange(n, "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
