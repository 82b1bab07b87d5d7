"""The published pre-tokeniser pattern, worked out in arrays over the bytes of many texts at once.

The pattern (`fixed_values.PRETOKEN`) leaves no character out, so a text is known by where its tokens start:
where a run of letters, of numbers, of white space or of others starts, but for three rules. The last
character of white space before other text is a token of its own; a blank there is joined to what follows;
and an apostrophe that starts a token takes the letters of a contraction with it.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusloom.functions import fixed_values as fx

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Bytes of texts that are looked at together.
CHUNK = 4_000_000


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point."""
    major = np.frombuffer("".join(map(unicodedata.category, map(chr, range(0x110000)))).encode(), "uint8")[::2]
    out = np.full(0x110000, OTHER, "uint8")
    out[major == ord("L")] = LETTER
    out[major == ord("N")] = NUMBER
    # White space as Unicode has it; U+001C..U+001F are none.
    out[[ord(c) for c in fx.SPACE_CHARS if not "\x1c" <= c <= "\x1f"]] = SPACE
    return out


def _class_of_bytes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte is part of."""
    table = _classes()
    out = table[:256][data]
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        lead = data[high] >= 0xC0
        at = high[lead]
        more = np.append(data, np.zeros(3, "uint8"))
        a, b, c, d = more[at].astype("int32"), *(more[at + i].astype("int32") & 0x3F for i in (1, 2, 3))
        two, three, four = (a & 0x1F) << 6 | b, (a & 0xF) << 12 | b << 6 | c, (a & 7) << 18 | b << 12 | c << 6 | d
        code = np.where(a < 0xE0, two, np.where(a < 0xF0, three, four))
        out[high] = table[code][np.cumsum(lead) - 1]
    return out


def _starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a token starts at each byte of texts that end at ends[1:]."""
    if not len(data):
        return np.zeros(0, bool)
    kind = _class_of_bytes(data)
    first = np.zeros(len(data) + 3, bool)
    first[ends[:-1][ends[1:] > ends[:-1]]] = True
    starts = first[: len(data)].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # Runs of other characters that follow white space.
    after = np.flatnonzero(starts[1:] & ~first[1 : len(data)] & (kind[:-1] == SPACE)) + 1
    last = after - 1
    while (inner := (data[last] & 0xC0) == 0x80).any():
        last = last - inner
    starts[last] = True
    starts[after[data[after - 1] == 0x20]] = False
    # Contractions.
    at = np.flatnonzero((data == 0x27) & starts)
    more = np.append(data, np.zeros(3, "uint8"))
    one, two = more[at + 1].astype("int32"), more[at + 1].astype("int32") << 8 | more[at + 2]
    short = np.isin(one, [ord(c) for c in "sdmt"])
    long = np.isin(two, [ord(c) << 8 | ord(d) for c, d in ("ll", "ve", "re")]) & ~first[at + 2]
    held = (short | long) & ~first[at + 1]
    at, then = at[held], at[held] + np.where(short, 2, 3)[held]
    starts[at + 1] = False
    starts[then[then < len(data)]] = True
    return starts


def cut(texts: pa.Array, whole: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Tokens of all texts, one after the other, and how many each has; texts of `whole` are one token."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], "int64")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")[ends[0] : ends[-1]]
    ends = ends - ends[0]
    alone = np.flatnonzero(pc.is_in(texts, pa.array(whole, texts.type)).to_numpy(zero_copy_only=False))
    found, sizes, at = [np.empty(0, "int64")], np.zeros(len(texts), "int64"), 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, "right")) - 1)
        begin, part = ends[at], ends[at : stop + 1] - ends[at]
        starts = _starts(data[begin : ends[stop]], part)
        for i in alone[(alone >= at) & (alone < stop)] - at:
            starts[part[i] + 1 : part[i + 1]] = False
        places = np.flatnonzero(starts)
        sizes[at:stop] = np.diff(np.searchsorted(places, part))
        found.append(places + begin)
        at = stop
    bounds = np.append(np.concatenate(found), len(data))
    kind, width = (pa.string(), "int32") if len(data) < 2**31 else (pa.large_string(), "int64")
    buffers = [None, pa.py_buffer(bounds.astype(width)), pa.py_buffer(data)]
    return pa.Array.from_buffers(kind, len(bounds) - 1, buffers), sizes
