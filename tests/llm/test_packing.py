import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.token_ids import TokenIds

WORDS = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=12))
def test_a_plan_holds_every_piece_once(histogram):
    packed = packing.plan(histogram, 64, rounds=10)
    held = {}
    for key, copies in packed:
        assert sum(n * k for n, k in key) <= 64 and copies > 0
        for n, k in key:
            held[n] = held.get(n, 0) + k * copies
    assert held == histogram
    sequences = sum(c for _, c in packed)
    # No packing has fewer: by total length, and as at most j pieces longer than 64 / (j + 1) fit together.
    least = [-(-sum(n * k for n, k in histogram.items()) // 64)]
    least += [-(-sum(k for n, k in histogram.items() if n * (j + 1) > 64) // j) for j in range(1, 64)]
    assert max(least) <= sequences <= 1.23 * max(least) + 1 or max(histogram, default=0) > 32


def test_plan_is_close_to_the_least_number():
    lengths = np.clip(np.random.default_rng(1).lognormal(6.5, 1.2, 20_000).astype(int), 1, 4096)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    sequences = sum(c for _, c in packing.plan(histogram, 4096))
    assert sequences <= -(-int(lengths.sum()) // 4096) * 1.002 + 1
    # The columns of the program, not best fit, place most pieces: every length is priced.
    quality = packing.quality(histogram, 4096)
    assert quality["sequences"] == sequences and quality["placed_by_columns"] > 0.6


def test_columns_waste_nothing_and_beat_or_equal_best_fit():
    histogram = {60: 50, 40: 50, 35: 40, 30: 80, 25: 10, 5: 100}
    columns, left = packing.solve(histogram, 100)
    assert columns and all(sum(n * k for n, k in key) == 100 for key in columns)
    held = Counter(left)
    for key, copies in columns.items():
        held.update({n: k * copies for n, k in key})
    assert held == histogram
    alone = sum(packing.best_fit(histogram, 100).values())
    assert sum(c for _, c in packing.plan(histogram, 100)) <= alone
    assert packing.plan({}, 100) == [] and packing.plan({7: 0}, 100) == []


def test_knapsack_finds_the_highest_price():
    lengths, price = np.array([3, 5, 7]), np.array([0.4, 0.8, 1.0])
    value, last = packing.knapsack(lengths, price, 30)
    want = np.zeros(31)
    for room in range(1, 31):
        want[room] = max([want[room - 1]] + [want[room - n] + p for n, p in zip(lengths, price) if n <= room])
    assert np.allclose(value, want)
    traced = packing._traced(last, lengths.tolist(), 30)
    assert np.isclose(sum(price[list(lengths).index(n)] * k for n, k in traced.items()), value[30])


def test_pack_documents(make_docs, odd_pairs):
    rows = packing.pack_documents(make_docs(odd_pairs), WORDS, capacity=512).collect()
    tok = Tokenizer.from_file(WORDS)
    ids = [(i, tok.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in odd_pairs]
    expected = sorted(
        repr((i, p, s, len(own[s : s + 512]), zlib.crc32(np.array(own[s : s + 512], "<u4").tobytes())))
        for i, own in ids for p, s in enumerate(range(0, len(own), 512))
    )
    assert sorted(repr(tuple(r)[:5]) for r in rows) == expected
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512


def test_empty(make_docs):
    assert packing.pack_documents(make_docs([]), WORDS).collect() == []


ODD = [
    "", "  ", "a  b\n\n c", "İstanbul ΣΑΣ Σ", "x\x1cy", "don't can't I'll 12.50 a_b", "<|endoftext|> hi",
    "é é  x y　", "你好 世界。abc", "\ttab\r\n  x ", "a​b ½ ² Ⅷ", "!!! ?? !?", "à.b,c;",
    "'s 't x's", "\n", "word\n", "ǅ ŉ ẞ ß", "é café", "end. Start\nNext, word: x",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_equal_whole_ids(name):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    special = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|> hello", "a<|endoftext|>b", "<|ENDOFTEXT|> x", "x <|endoftext|>\n"]
    for literal in (False, True):
        own, tok.encode_special_tokens = TokenIds(path, literal_specials=literal), literal
        for text in [*ODD, *special, "".join(ODD), " ".join(ODD + special)]:
            assert own.array(text).tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_packed_ids_are_the_librarys(make_docs):
    texts = ["<|endoftext|> hello", "plain words", "a <|startoftext|>b", None]
    rows = packing.pack_documents(make_docs(list(enumerate(texts))), WORDS).collect()
    tok = Tokenizer.from_file(WORDS)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4"))) for i, ids in want.items()
    }


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB é.,!'\n\t  \x1f1Σ_&"), max_size=30))
def test_chunked_ids_of_random_texts(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        tok = _loaded(path)
        assert tok[0].array(text).tolist() == tok[1].encode(text, add_special_tokens=False).ids


_TOKS = {}


def _loaded(path):
    if path not in _TOKS:
        tok = Tokenizer.from_file(path)
        _TOKS[path] = TokenIds(path), tok
    return _TOKS[path]
