import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from corpusloom.llm import range_coder, token_ids, token_scan

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 65535), max_size=60), st.integers(1, 120), st.integers(1, 3000))
def test_any_ids_come_back(pattern, repeats, cut):
    ids = np.array(pattern * repeats, np.int64)[:cut]
    assert (range_coder.decode_block(range_coder.encode_block(ids), len(ids)) == ids).all()


def test_regular_ids_shrink():
    ids = np.tile(np.arange(50), 400)
    assert len(range_coder.encode_block(ids)) < len(ids) / 4


def _entropy(ids):
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return -(share * np.log2(share)).sum()


def test_ids_drawn_alone_take_their_entropy():
    """Nothing for orders 1 and 2 to find: order 0 must give each id its frequency, not one guess."""
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 200_000), 3000)
    coded = range_coder.encode_block(ids)
    assert 8 * len(coded) / len(ids) < _entropy(ids) + 0.4
    assert (range_coder.decode_block(coded, len(ids)) == ids).all()


@pytest.mark.parametrize("order", [1, 2])
def test_ids_that_follow_others_take_less_than_their_entropy(order):
    """Each id follows from the one or two before it, nine times in ten; alone, they look even."""
    rng = np.random.default_rng(order)
    n, kinds = 200_000, 40
    noise, odd = rng.integers(0, kinds, n), rng.random(n) < 0.1
    ids = noise.copy()
    for i in range(2, n):
        if not odd[i]:
            ids[i] = (7 * ids[i - 1] + 3 + (order == 2) * 5 * ids[i - 2]) % kinds
    coded = range_coder.encode_block(ids)
    assert 8 * len(coded) / len(ids) < 0.4 * _entropy(ids)
    assert (range_coder.decode_block(coded, len(ids)) == ids).all()


def test_the_least_likely_ids_carry_through_all_digits():
    """Ids at both ends of the alphabet, met after long runs of others, in one lane and in many."""
    for n in (3, 50, 5000):
        ids = np.zeros(n, np.int64)
        ids[n // 2 :: 7] = 65535
        ids[-1] = 65534
        assert (range_coder.decode_block(range_coder.encode_block(ids), n) == ids).all()


def test_files_of_real_documents_take_less_than_their_entropy(spark, make_docs, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    tok = Tokenizer.from_file(BYTES)
    docs = [(r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in rows]
    path = str(tmp_path / "real.ids")
    size = _write(docs, path)
    ids = np.concatenate([d for _, d in docs])
    assert 8 * size / len(ids) < 9
    assert [(i, x.tolist()) for i, x in range_coder.read_file(pa.PythonFile(open(path, "rb")))] == docs


def test_a_damaged_block_is_noticed_by_its_head_or_its_checksum():
    ids = np.arange(1000) % 17
    coded = range_coder.encode_block(ids)
    for bad in (b"", coded[:-2], b"\0" * 4 + coded[4:], coded + b"\0\0"):
        with pytest.raises(ValueError):
            range_coder.decode_block(bad, len(ids))


def _write(docs, path):
    system = fs.LocalFileSystem()
    writer = range_coder.FileWriter(system.open_output_stream(path, compression=None))
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids))
    return writer.close()


def test_files_hold_documents_and_find_damage(tmp_path, monkeypatch):
    monkeypatch.setattr(range_coder, "LANES", 4)
    monkeypatch.setattr(range_coder, "BLOCK", 128)
    rng = np.random.default_rng(0)
    docs = [(None, []), (3, [0]), (4, rng.integers(0, 50257, 1000).tolist()), (9, [7] * 128), (9, [65535])]
    path = str(tmp_path / "a.ids")
    size = _write(docs, path)
    data = open(path, "rb").read()
    assert len(data) == size
    read = lambda: [(i, x.tolist()) for i, x in range_coder.read_file(pa.PythonFile(open(path, "rb")))]
    assert read() == docs
    with open(path, "r+b") as f:
        f.seek(len(range_coder.MAGIC) + 40)
        f.write(bytes([data[len(range_coder.MAGIC) + 40] ^ 1]))
    with pytest.raises(ValueError):
        read()
    open(path, "wb").write(data[:-9])
    with pytest.raises(ValueError):
        read()


def test_ids_beyond_16_bits_are_refused(tmp_path):
    with pytest.raises(ValueError):
        _write([(1, [65536])], str(tmp_path / "a.ids"))


def test_files_hold_the_librarys_ids(make_docs):
    texts = ["<|endoftext|> hello", "plain words", "a<|endoftext|>b", None]
    files = range_coder.write_token_files(make_docs(list(enumerate(texts))), BYTES, parts=2)
    tok = Tokenizer.from_file(BYTES)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in range_coder.read_token_files(files).collect()} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4"))) for i, ids in want.items()
    }


@functools.cache
def _library():
    return Tokenizer.from_file(BYTES)


_ODD_TEXTS = st.lists(
    st.sampled_from(
        [*"aZ\u00e9\u00ff\u00d7\u00f7\u00aa 09.,!'-_\t\n\r\v\f\0\x1c\x1f\x85\u00a0\u200b\u2003\u2019\u3000\u4e2d\u0416\u0301\u0967\U0001f600"]
        + ["  ", " \n", "'s", "'ll", " 're", "word", "Voil\u00e0", " 12", "...", "x" * 120, "<|endoftext|>", "<|end"]
    ),
    max_size=12,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(_ODD_TEXTS, max_size=6), st.sampled_from([1, 20, 1 << 20]), st.booleans())
def test_texts_cut_together_get_the_librarys_ids(texts, together, literal):
    tok, plain = token_ids.tokenizer(BYTES, literal_specials=literal), _library()
    plain.encode_special_tokens = literal
    token_ids.TOGETHER, before = together, token_ids.TOGETHER
    try:
        # A slice, so that the array's own offset counts.
        got = [x.tolist() for x in tok.arrays(pa.array(["before", *texts])[1:], 7)]
    finally:
        token_ids.TOGETHER = before
    assert got == [[*plain.encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert list(tok.arrays(pa.array([], pa.string()))) == []


def test_a_chunk_is_looked_up_once_for_all_texts_of_a_batch():
    tok = token_ids.TokenIds(BYTES)
    calls, get = [], tok._get
    tok._get = lambda chunk: calls.append(chunk) or get(chunk)
    text = "some words, and the same words again; some words."
    want = tok.array(text, 0).tolist()
    calls.clear()
    assert [x.tolist() for x in tok.arrays(pa.array([text] * 500), 0)] == [want] * 500
    assert len(calls) == len(set(calls)) < 20


def test_a_full_block_takes_few_steps_and_small_ones_more_than_lanes_alone():
    """A step has some hundred array operations, whatever its lanes."""
    assert range_coder._shape(range_coder.BLOCK) == (4096, 1024)
    assert range_coder._shape(10_000) == (200, 50)


def test_written_and_read_by_spark(make_docs, odd_pairs):
    files = range_coder.write_token_files(make_docs(odd_pairs), BYTES, parts=3)
    rows = [tuple(r) for r in range_coder.read_token_files(files).collect()]
    tok = Tokenizer.from_file(BYTES)
    own = [(i, tok.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in odd_pairs]
    facts = lambda i, ids: repr((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(repr((r[0], *r[2:])) for r in rows) == sorted(facts(*o) for o in own)
    at = 0
    for doc_id, start, n, _ in sorted(rows, key=lambda r: r[1]):
        assert start == at
        at += n
    ids = [r[0] for r in sorted(rows, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_no_documents(make_docs):
    assert range_coder.read_token_files(range_coder.write_token_files(make_docs([]), BYTES)).collect() == []
    assert token_scan.document_token_counts(make_docs([]), BYTES).collect() == []


def test_counts_of_documents(make_docs, odd_pairs):
    got = token_scan.document_token_counts(make_docs(odd_pairs), BYTES).collect()
    tok = Tokenizer.from_file(BYTES)
    own = [(i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in odd_pairs]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, own))


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_scan_stitches_blocks(spark, tmp_path, monkeypatch, block_bytes):
    monkeypatch.setattr(token_scan, "GROUP_BLOCKS", 3)
    rng = np.random.default_rng(4)
    files, expected = [], []
    for k in range(4):
        ids = rng.integers(0, 4, 300) if k else np.array([1] * 100 + [0, 0] + [2] * 50)
        path = str(tmp_path / f"{k}.bin")
        ids.astype("<u2").tofile(path)
        files.append((path, 2 * len(ids)))
        ends = np.flatnonzero(ids == 0)
        expected += [(path, i, int(n)) for i, n in enumerate(np.diff(ends, prepend=-1))]
    files.append((str(tmp_path / "none.bin"), 0))
    listed = spark.createDataFrame(files, "path string, n_bytes long")
    got = token_scan.count_tokens(listed, 0, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
