"""Token ids of whole texts by the tokenizers library, one call per distinct chunk.

A text is cut only where the tokenizer's own pattern always cuts; each distinct chunk is encoded
once per worker and remembered, up to a bounded number of chunks. Equal to encoding the whole text.
Special tokens that stand in a text as literals get their own ids, as the library has it, or are
ordinary text where the caller asks for that. `arrays` cuts many texts at once by array operations over
their bytes, and looks each distinct chunk up once.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker remembers; beyond them it starts again.
MEMO_CHUNKS = 400_000

_PLAIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = "[.,;:!?]+"
# A word, marks after it, or all up to the next white space.
_CHUNK = re.compile(rf"{_PLAIN}(?=[\s.,;:!?]|\Z)|{_MARKS}(?=\s|\Z)|\S+")
# The same, where a run of white space gives its last blank to what follows it.
_SPACED_CHUNK = re.compile(rf" ?{_PLAIN}(?=[\s.,;:!?]|\Z)|{_MARKS}(?=\s|\Z)|\s+(?!\S)| ?\S+|\s+")
_ONE = re.compile(rf" ?{_PLAIN}|{_MARKS}")
# White space for Python, but not for the tokenizers; a sigma's lower case depends on its place.
_ODD = re.compile("[\x1c-\x1fΣ]")

#: Bytes of texts that are cut together.
TOGETHER = 8_000_000
# Classes of bytes. Next to GLUE, bytes of characters beyond the first letters of Latin-1, only white space cuts.
_GLUE, _SPACE, _LETTER, _DIGIT, _OTHER = range(5)
_CLASSES = bytes(
    _GLUE
    if b >= 0x80
    else _SPACE
    if chr(b) in " \t\n\v\f\r"
    else _LETTER
    if chr(b).isalpha()
    else _DIGIT
    if chr(b).isdigit()
    else _OTHER
    for b in range(256)
)
# Texts that hold one of these are not cut by bytes: other white space, and what one side alone takes for it.
_UNCUT = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"


def _starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a chunk starts at each byte of texts that end at ends[1:], for a byte-level pre-tokenizer.

    Only where the published pattern cuts whatever stands around: where letters, digits and others meet, but
    not behind an apostrophe, and where white space starts. Its last blank goes to what follows.
    """
    kind = np.frombuffer(bytearray(data.tobytes().translate(_CLASSES)), np.uint8)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] & 0xDF) != 0x97]  # all of U+00C0 to U+00FF are letters but the two signs
    kind[lead] = kind[lead + 1] = _LETTER
    first = np.zeros(len(data) + 1, bool)
    first[ends[:-1]] = True
    first = first[: len(data)]
    space, glue, out = kind == _SPACE, kind == _GLUE, first.copy()
    held = glue[:-1] | glue[1:] | space[:-1] | (data[:-1] == 0x27)
    out[1:] |= (kind[1:] != kind[:-1]) & (~held | space[1:])
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:]) + 1
    out[after - 1] = True
    out[after[data[after - 1] != 0x20]] = True
    return out


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenIds:
    """ids(text): the little-endian ids of a text as bytes, `dtype` wide."""

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS, literal_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        # Chunks are ordinary text: special tokens are looked for in whole texts, before any lower-casing.
        self._tok.encode_special_tokens = True
        added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._special = () if literal_specials else tuple(added)
        self.dtype = np.dtype("<u2" if self._tok.get_vocab_size() <= 1 << 16 else "<u4")
        self._code, self._tokenize = self.dtype.char, self._tok.model.tokenize
        self._letters = str.maketrans(_byte_letters())
        literal = ["".join(f"\\x{{{ord(c):x}}}" for c in token) for token in self._special]
        self._uncut = "|".join([_UNCUT, *literal])
        self._spaced = self._tok.normalizer is None
        memo = _Memo(self._encode, memo_chunks)
        self._get, self._chunks = memo.__getitem__, (_SPACED_CHUNK if self._spaced else _CHUNK).findall

    def _encode(self, chunk: str) -> bytes:
        if not _ONE.fullmatch(chunk):
            return self._whole(chunk)
        letters = chunk.encode().decode("latin-1").translate(self._letters)
        return array(self._code, [t.id for t in self._tokenize(letters)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self._special):
            self._tok.encode_special_tokens = False
            ids = self._whole(text)
            self._tok.encode_special_tokens = True
            return ids
        if _ODD.search(text):
            return self._whole(text)
        if not self._spaced:
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                return self._whole(text)
            text = text.lower()
        return b"".join(map(self._get, self._chunks(text)))

    def array(self, text: str, end: int | None = None) -> np.ndarray:
        """Ids as unsigned 32-bit integers, with the end id where one is given."""
        ids = np.frombuffer(self.ids(text), self.dtype)
        out = np.empty(len(ids) + (end is not None), "<u4")
        out[: len(ids)] = ids
        if end is not None:
            out[-1] = end
        return out

    def arrays(self, texts: pa.Array, end: int | None = None) -> Iterator[np.ndarray]:
        """What `array` gives for each of the texts (none of them null)."""
        if not self._spaced or not len(texts):
            yield from (self.array(text, end) for text in texts.to_pylist())
            return
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, "right")) - 1)
            ids, places = self._together(texts[at:stop], ends[at : stop + 1])
            for start, after in zip(places[:-1].tolist(), places[1:].tolist()):
                out = np.empty(after - start + (end is not None), "<u4")
                out[: after - start] = ids[start:after]
                if end is not None:
                    out[-1] = end
                yield out
            at = stop

    def _together(self, texts: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that lie side by side, and where those of each text start."""
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(ends), np.int64)
        starts = _starts(data, ends)
        uncut = pc.match_substring_regex(texts, self._uncut)
        for i in np.flatnonzero(uncut.to_numpy(zero_copy_only=False)):
            starts[ends[i] + 1 : ends[i + 1]] = False
        places = np.flatnonzero(starts)
        bounds = pa.py_buffer(np.append(places, len(data)))
        buffers = [None, bounds, pa.py_buffer(data)]
        chunks = pa.Array.from_buffers(pa.large_string(), len(places), buffers).dictionary_encode()
        # No other chunk equals one of these texts, as none holds what kept them whole.
        whole = set(texts.filter(uncut).to_pylist())
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids_of = [self.ids(c) if c in whole else self._get(c) for c in distinct] if whole else list(map(self._get, distinct))
        found = pa.array(ids_of, pa.large_binary()).take(chunks.indices)
        id_ends = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] // self.dtype.itemsize
        ids = np.frombuffer(found.buffers()[2] or b"", self.dtype)[: id_ends[-1]]
        return ids, id_ends[np.searchsorted(places, ends)]


class _Memo(dict):
    def __init__(self, encode, most: int):
        super().__init__()
        self._encode, self._most = encode, most

    def __missing__(self, chunk: str) -> bytes:
        ids = self._encode(chunk)
        if len(self) >= self._most:
            self.clear()
        if len(chunk) < 100:
            self[chunk] = ids
        return ids


@functools.lru_cache(maxsize=2)
def tokenizer(path: str, memo_chunks: int = MEMO_CHUNKS, literal_specials: bool = False) -> TokenIds:
    """One per worker and file, with what it remembers."""
    return TokenIds(path, memo_chunks, literal_specials)


def crc_of(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), before)
