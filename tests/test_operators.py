"""Operators against brute force, and invariants."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fixed
from corpusloom.operators import (
    bpe, clean, dedup, language, lookup, packing, perplexity, sample, sharding, stats, toxicity,
)
from corpusloom.operators import tokens as tk
from corpusloom.sources import jsonl, tables

LINES = [
    ('{"text": "hello", "url": "u"}', "OK", "hello"),
    ("", "BAD_JSON", None),
    ('{"text": "x"', "BAD_JSON", None),
    ('{"text": "x"},', "BAD_JSON", None),
    ('{"text": "x"}],[', "BAD_JSON", None),
    ('{"text": "x"} {"text": "y"}', "BAD_JSON", None),
    ('{"url": "u"}', "EMPTY", ""),
    ('{"text": null}', "MALFORMED", None),
    ('{"text": 5}', "MALFORMED", None),
    ('[1, 2]', "MALFORMED", None),
    ('"bare"', "MALFORMED", None),
    ('null', "MALFORMED", None),
    ('{"text": "a", "text": "b"}', "OK", "b"),
    ('{"text": " \\t"}', "EMPTY", " \t"),
    ('  {"text": "padded"}  ', "OK", "padded"),
]


def test_line_status(spark):
    rows = [(i, line) for i, (line, _, _) in enumerate(LINES)]
    parsed = jsonl.parse_lines(spark.createDataFrame(rows, "ord bigint, value string"))
    got = [(r.status, r.text) for r in parsed.orderBy("ord").collect()]
    assert got == [(status, text) for _, status, text in LINES]
    kept = dedup.dedup_parsed(parsed).select("ord").collect()
    # EMPTY rows have different texts here; MALFORMED rows all pass.
    assert sorted(r.ord for r in kept) == [0, 6, 7, 8, 9, 10, 11, 12, 13, 14]


def test_lines_without_limits(spark):
    """What a line-by-line parser reads: any length, deep nesting, NaN, long numbers, half surrogates."""
    long = "x" * 30_000_000
    lines = [
        ('{"text": "%s"}' % long, "OK", long),
        ('{"a": %s1%s, "text": "deep"}' % ("[" * 2000, "]" * 2000), "OK", "deep"),
        ('{"a": NaN, "b": -Infinity, "text": "n"}', "OK", "n"),
        ("NaN", "MALFORMED", None), ('{"text": NaN}', "MALFORMED", None),
        ('{"a": %s, "text": "number"}' % ("1" * 4000), "OK", "number"),
        ('{"text": "half \\ud800"}', "OK", "half ?"), ('{"text": "pair \\ud83d\\ude00"}', "OK", "pair \U0001f600"),
        ("\u3000{\"text\": \"\u2003\"}\x1f", "EMPTY", "\u2003"), (None, "BAD_JSON", None),
        ("\ufeff{}", "BAD_JSON", None), ("{'text': 1}", "BAD_JSON", None), ('{"text": true}', "MALFORMED", None),
    ]
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(lines)], "ord bigint, value string")
    rows = jsonl.parse_lines(df).select("ord", "status", "text", "keys").orderBy("ord").collect()
    for r, (_, status, text) in zip(rows, lines, strict=True):
        assert (r.status, r.text == text) == (status, True), r.ord
    assert rows[2]["keys"] == ["a", "b", "text"] and rows[3]["keys"] is None


def test_line_numbers_move_no_text(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "a"}\n' * 50)
    (tmp_path / "b.jsonl").write_text('{"text": "b"}\n' * 50)
    numbered = jsonl.with_line_numbers(jsonl.read_lines(spark, str(tmp_path)))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "parquet" in plan.lower()
    assert numbered.count() == 100 and numbered.agg(F.max("ord")).first()[0] == 99
    text = numbered._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in text.splitlines() if "Exchange" in x and "value" in x]
    assert not lines


def test_line_numbers_follow_the_files(spark, tmp_path):
    lines = [f'{{"text": "line {i}"}}' for i in range(500)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines[:20]) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join(lines[20:450]) + "\n")
    (tmp_path / "c.jsonl").write_text("\n".join(lines[450:]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = jsonl.read_jsonl(spark, str(tmp_path)).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.ord for r in rows] == list(range(500))
    assert [r.text for r in rows] == [f"line {i}" for i in range(500)]


@pytest.mark.parametrize("n", [1, 7, 60, 299, 300, 1000])
def test_narrowed_top_n_is_exact(spark, n):
    rng = random.Random(n)
    rows = [(i * 7919 - 10**12, rng.choice([3, 3, 3, rng.randint(-10**15, 10**15)])) for i in range(300)]
    df = spark.createDataFrame(rows, "ord bigint, k bigint")
    got = sample.smallest_n(df, F.col("k"), n, [F.col("ord")], direct_rows=0).collect()
    assert [(r.ord, r.k) for r in got] == sorted(rows, key=lambda r: (r[1], r[0]))[:n]
    first = sample.first_n(df, n, direct_rows=0).collect()
    assert [r.ord for r in first] == [r[0] for r in rows[:n]]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").alias("ord"))
    one = sample.sample_n(df.repartition(1), 50, direct_rows=0).collect()
    many = sample.sample_n(df.repartition(17), 50).collect()
    assert one == many and len({r.ord for r in one}) == 50


def near_scan(sigs, threshold):
    kept, out = [], []
    for i, s in enumerate(sigs):
        if all(bin((s ^ k) & (2**64 - 1)).count("1") > threshold for k in kept):
            kept.append(s)
            out.append(i)
    return out


def clustered(rng, n):
    sigs = [rng.getrandbits(64) for _ in range(5)]
    for _ in range(n - 5):
        s = rng.choice(sigs)
        for _ in range(rng.randint(0, 4)):
            s ^= 1 << rng.randrange(64)
        sigs.append(s)
    return [s - (1 << 64) if s >> 63 else s for s in sigs]


@pytest.mark.parametrize("threshold, bucket_rows", [(3, 512), (3, 4), (1, 2), (2, 3), (8, 512)])
def test_near_pairs_equal_brute_force(spark, threshold, bucket_rows):
    rng = random.Random(threshold * 100 + bucket_rows)
    sigs = list(dict.fromkeys(clustered(rng, 80)))
    df = spark.createDataFrame(list(enumerate(sigs)), "ord bigint, sig bigint")
    got = dedup.near_pairs(df, threshold, bucket_rows).collect()
    mask = 2**64 - 1
    want = {
        (i, j, bin((a ^ b) & mask).count("1"))
        for i, a in enumerate(sigs) for j, b in enumerate(sigs)
        if i < j and bin((a ^ b) & mask).count("1") <= threshold
    }
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_dedup_equals_the_scan(spark):
    rng = random.Random(5)
    sigs = clustered(rng, 200)
    df = spark.createDataFrame(list(enumerate(sigs)), "ord bigint, sig bigint")
    got = sorted(r.ord for r in dedup.near_kept(df).collect())
    assert got == near_scan(sigs, 3)


def test_near_dedup_chain(spark):
    # a-b and b-c are near, a-c is not: b goes, c stays.
    df = spark.createDataFrame([(0, 0), (1, 0b111), (2, 0b111111)], "ord bigint, sig bigint")
    assert sorted(r.ord for r in dedup.near_kept(df).collect()) == [0, 2]


def test_simhash_equals_the_definition(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["ab", "cd", "ef", "gh"], k=k)) for k in (0, 1, 8, 9, 40, 41, 200)]
    df = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string")
    got = {r.ord: r.sig & (2**64 - 1) for r in dedup.simhash(df).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        hashes = [
            int.from_bytes(hashlib.md5(" ".join(words[k:k + 8]).encode()).digest()[8:], "big")
            for k in range(0, len(words), 8)
        ]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i] == want


def test_exact_dedup_with_a_hot_text(spark):
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "ord bigint, text string").repartition(7)
    once = dedup.dedup_exact(df)
    seen, want = set(), []
    for i, t in rows:
        if t not in seen:
            seen.add(t)
            want.append(i)
    assert sorted(r.ord for r in once.collect()) == want
    counts = dedup.dedup_counts(df).first()
    assert (counts.kept, counts.dropped) == (len(want), 300 - len(want))
    assert dedup.dedup_exact(once).count() == len(want)


def pack_scan(lengths, size):
    out, block, fill = [], 0, 0
    for n in lengths:
        if fill + n > size:
            block, fill = block + 1, 0
        out.append((block, fill))
        fill += n
    return out


@pytest.mark.parametrize("span, fan_in", [(50_000, 1000), (7, 3), (1, 2), (16, 1000)])
def test_packing_equals_the_sequential_loop(spark, span, fan_in):
    rng = random.Random(span)
    lengths = [rng.choice([1, 2, 5, 10, 31, 32, rng.randint(1, 32)]) for _ in range(120)]
    ords = sorted(rng.sample(range(-200, 800), 120))
    df = spark.createDataFrame(list(zip(ords, lengths)), "ord bigint, length int").repartition(5)
    got = packing.assign_blocks(df, 32, span, fan_in).orderBy("ord").collect()
    assert [(r.block_id, r.offset) for r in got] == pack_scan(lengths, 32)


def test_packed_blocks(spark):
    ids = [[1] * 5, [2] * 3, [3] * 1, [4] * 8, [5] * 2]
    tokens = spark.createDataFrame(list(enumerate(ids)), "ord bigint, input_ids array<int>")
    placed = packing.plan_blocks(tokens.withColumn("length", F.size("input_ids")), 8, 9)
    fixed = packing.pack_fixed(tokens, placed, 0).orderBy("block_id").collect()
    assert [r.input_ids for r in fixed] == [
        [1] * 5 + [2] * 3, [3] + [0] * 7, [4] * 8, [5] * 2 + [0] * 6,
    ]
    free = packing.pack_variable(tokens, placed, 0).orderBy("block_id").collect()
    assert [r.length for r in free] == [8, 1, 8, 8]
    report = packing.diagnose(tokens, packing.pack_fixed(tokens, placed, 0), 8).first()
    assert report.all_exact and report.blocks == 4 and report.docs == 5
    with pytest.raises(ValueError):
        packing.assign_blocks(tokens.withColumn("length", F.size("input_ids")), 7)


@pytest.mark.parametrize("bucket, fan_in", [(40, 2), (100, 3), (10_000, 1000)])
def test_hashed_ids_give_even_buckets_and_the_same_blocks(spark, bucket, fan_in):
    rng = random.Random(bucket)
    # Ids all over 63 bits, most of them in one corner; some documents are empty.
    ords = sorted(rng.sample(range(1000), 150) + [rng.randrange(1 << 62) for _ in range(80)] + [-(1 << 61)])
    docs = [(o, [o % 1000] * rng.choice([0, 1, 3, 8, 20, 31, 32])) for o in ords]
    tokens = spark.createDataFrame(docs, "ord bigint, input_ids array<int>").repartition(6)
    plan = packing.plan_blocks(tokens.withColumn("length", F.size("input_ids")), 32, bucket, fan_in)
    sizes = plan.lengths.groupBy("node").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in sizes) <= bucket + 32
    want = {}
    for (_, ids), (block, _) in zip(docs, pack_scan([len(i) for _, i in docs], 32)):
        want.setdefault(block, []).extend(ids)
    got = packing.build_blocks(tokens, plan)
    assert {r.block_id: r.ids for r in got.collect()} == {b: i for b, i in want.items() if i}
    placed = {r.ord: (r.block_id, r.offset) for r in packing.place_docs(plan).collect()}
    assert [placed[o] for o in ords] == pack_scan([len(i) for _, i in docs], 32)


def test_token_arrays_are_exchanged_once(spark, monkeypatch):
    tokens = spark.createDataFrame([(i, [i] * 5) for i in range(50)], "ord bigint, input_ids array<int>")
    plan = packing.plan_blocks(tokens.withColumn("length", F.size("input_ids")), 8, 40)
    plans = []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(packing, "materialise", keep)
    packing.build_blocks(tokens, plan)
    assert plans[0].count("Exchange hashpartitioning(node") <= 2 and "Exchange rangepartitioning" not in plans[0]
    assert plans[0].count("Exchange") <= 2  # the narrow start states are the other side


@pytest.mark.parametrize("total", [0, 1, 99, 100, 1000])
def test_shards(spark, total):
    blocks = spark.range(total).select(F.col("id").alias("block_id"))
    sizes = sharding.split_sizes(total)
    counts = {r.split: r.blocks for r in sharding.split_counts(blocks).collect()}
    assert [counts[s] for s in ("train", "val", "test")] == sizes
    got = sharding.assign_shards(blocks, total, shard_size=10).collect()
    for split, first, n in zip(("train", "val", "test"), (0, sizes[0], sizes[0] + sizes[1]), sizes):
        assert sorted((r.block_id, r.shard) for r in got if r.split == split) == [
            (first + i, i // 10 + 1) for i in range(n)
        ]
    manifest = {r.split: r for r in sharding.shard_manifest(sharding.split_counts(blocks), 10).collect()}
    assert manifest["train"].ref_shards == sizes[0] // 10 + 1
    with pytest.raises(ValueError):
        sharding.split_sizes(10, (0.5, 0.1, 0.1))


def naive_bpe(counts, merges):
    names = bpe.byte_alphabet()
    words = {w: [names[b] for b in w.encode()] for w in counts}
    learned = []
    for _ in range(merges):
        pairs = {}
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] = pairs.get(p, 0) + counts[w]
        if not pairs:
            break
        # A pair that spells a known symbol is never learned.
        known = {a + b for a, b in learned} | set(names.values())
        pairs = {p: n for p, n in pairs.items() if p[0] + p[1] not in known}
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p[0].encode(), p[1].encode()))
        learned.append(best)
        for w, s in words.items():
            out, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == best:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            words[w] = out
    return learned


def test_bpe_equals_one_merge_at_a_time(spark):
    counts = {" the": 50, " then": 20, "aaaa": 9, " thé": 7, "aaa": 4, " hat": 3, "\U0001f600": 2}
    df = spark.createDataFrame(list(counts.items()), "token string, n bigint")
    table, words = bpe.train_bpe(df, 12)
    got = [(r["left"], r["right"]) for r in table.orderBy("rank").collect()]
    assert got == naive_bpe(counts, 12)
    for r in words.collect():
        assert r.symbols.count(bpe.OPEN) >= 1


@pytest.mark.parametrize("how", [{}, {"tracked": 4, "guesses": 3, "rewrite_every": 5}, {"guesses": 64}])
def test_bpe_on_random_words(spark, how):
    rng = random.Random(11)
    # Few letters: counts tie, pairs overlap, and different pairs spell the same symbol.
    words = {"".join(rng.choice("aab é") for _ in range(rng.randrange(1, 9))) for _ in range(120)}
    counts = {w: rng.randrange(1, 6) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "token string, n bigint").repartition(5)
    table, encoded = bpe.train_bpe(df, 70, **how)
    learned = [(r["left"], r["right"]) for r in table.orderBy("rank").collect()]
    assert learned == naive_bpe(counts, 70) and len(learned) > 40
    ranks = {p: i for i, p in enumerate(learned)}
    names = bpe.byte_alphabet()
    for r in encoded.collect():
        assert bpe.unbracketed(r.symbols) == bpe.merge_symbols([names[b] for b in r.word.encode()], ranks)


@pytest.mark.parametrize("scanned", [0, 1, 9, 40])
def test_bpe_scans_hand_over_to_the_index(spark, scanned):
    rng = random.Random(12)
    words = {"".join(rng.choice("aab\u00e9 ") for _ in range(rng.randrange(1, 12))) for _ in range(100)}
    counts = {w: rng.randrange(1, 6) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "token string, n bigint").repartition(3)
    table, encoded = bpe.train_bpe(df, 60, scanned=scanned)
    learned = [(r["left"], r["right"]) for r in table.orderBy("rank").collect()]
    assert learned == naive_bpe(counts, 60)
    ranks = {p: i for i, p in enumerate(learned)}
    names = bpe.byte_alphabet()
    got = {r.word: bpe.unbracketed(r.symbols) for r in encoded.collect()}
    assert got == {w: bpe.merge_symbols([names[b] for b in w.encode()], ranks) for w in counts}


def test_first_merges_list_no_word_under_its_pairs(spark, monkeypatch):
    def listed(*_):
        raise AssertionError("words listed under their pairs")

    monkeypatch.setattr(bpe, "_Index", listed)
    counts = {" the": 50, " then": 20, "aaaaa": 9, "aaa": 4, " hat": 3}
    df = spark.createDataFrame(list(counts.items()), "token string, n bigint")
    got = [(r["left"], r["right"]) for r in bpe.train_bpe(df, 9)[0].orderBy("rank").collect()]
    assert got == naive_bpe(counts, 9)


@pytest.mark.parametrize("square", [1_000, 10])
@pytest.mark.parametrize("order", [1, -1])
def test_tokens_merged_together_equal_each_on_its_own(monkeypatch, square, order):
    monkeypatch.setattr(bpe.Coder, "SQUARE", square)
    rng = random.Random(13)
    counts = {"".join(rng.choice("aab\u00e9 cd") for _ in range(rng.randrange(1, 20))): 1 for _ in range(100)}
    # Backwards, a merge makes sides of earlier ones.
    merges = tuple(naive_bpe(counts, 50))[::order]
    coder = bpe.Coder(merges, (("<|bos|>", 400),))
    texts = ["".join(rng.choice("aab<\u00e9 cdxz\U0001f600") for _ in range(rng.randrange(200))) for _ in range(200)]
    for tokens in ([*counts, *texts, "<|bos|>", "", "a" * 300], [*counts], ["ab"], []):
        ids, sizes = coder.encode(pa.array(tokens, pa.string()))
        want = [coder._long(t) for t in tokens]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_short_tokens_are_not_merged_one_by_one(monkeypatch):
    merges = (("t", "h"), ("th", "e"))
    want = bpe.Coder(merges, ())._long("the")
    monkeypatch.setattr(bpe, "merge_symbols", None)
    ids, sizes = bpe.Coder(merges, ()).encode(pa.array(["the", "that"]))
    assert ids[:1].tolist() == want and sizes.tolist() == [1, 3]


def test_bpe_without_words_or_pairs(spark):
    none = spark.createDataFrame([], "token string, n bigint")
    assert bpe.train_bpe(none, 5)[0].count() == 0
    single = spark.createDataFrame([("a", 3), ("", 9)], "token string, n bigint")
    assert bpe.train_bpe(single, 5)[0].count() == 0


def test_merging_long_tokens_is_fast():
    import time

    ranks = {("a", "a"): 0, ("aa", "aa"): 1, ("aa", "a"): 2}
    start = time.perf_counter()
    merged = bpe.merge_symbols(["a"] * 300_001, ranks)
    assert merged == ["aaaa"] * 75_000 + ["a"] and time.perf_counter() - start < 20


ODD_TEXTS = [
    None, "", " ", "the then théâtre", "a\x00b\x01", "\U0001f600\U0001f601 été naïve", "x" * 5000, "\r\n\t tail  ",
    "<|bos|> in <|eos|><|pad|>", "<|endoftext|>text<|unk|>", "<|bos", "日本語のテキスト", "ﬁne é e\u0301", " ",
]


@pytest.fixture(scope="module")
def small_merges(spark):
    counts = spark.createDataFrame(
        [(" the", 50), (" then", 20), ("aaaa", 9), (" thé", 7), ("xx", 4), ("日本", 9), ("text", 30)], "token string, n bigint"
    )
    return bpe.load_merges(bpe.train_bpe(counts, 25)[0])


@pytest.mark.parametrize("kind", ["base", "extended"])
def test_every_text_comes_back(spark, small_merges, kind):
    encoder = getattr(tk.Encoder, kind)(small_merges)
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "ord long, text string").repartition(3)
    coded = df.withColumn("ids", encoder.encode(F.col("text"))).withColumn("n", encoder.count(F.col("text")))
    rows = coded.withColumn("back", encoder.decode(F.col("ids"))).collect()
    assert len(rows) == len(ODD_TEXTS)
    ranks = {p: i for i, p in enumerate(small_merges)}
    names, order = bpe.byte_alphabet(), bpe.byte_order()
    ids = {names[b]: i for i, b in enumerate(order)} | {a + b: 256 + i for i, (a, b) in enumerate(small_merges)}
    for r in rows:
        assert r.back == r.text and (r.n is None) == (r.text is None)
        if r.text is None:
            assert r.ids is None
            continue
        assert r.n == len(r.ids)
        want, rest = [], r.text
        cut = re.compile("(" + "|".join(map(re.escape, encoder.special)) + ")")
        import regex
        for part in cut.split(rest):
            if part in encoder.special:
                want.append(encoder.special[part])
                continue
            for token in regex.findall(fixed.PRETOKEN, part):
                want += [ids[s] for s in bpe.merge_symbols([names[b] for b in token.encode()], ranks)]
        assert r.ids == want


def test_batches_are_encoded_a_slice_at_a_time(small_merges, monkeypatch):
    encoder = tk.Encoder.extended(small_merges)
    coder, names, cut = bpe.coder(encoder.merges, tuple(encoder.special.items())), list(encoder.special), tk.pretokenise.cut
    rows = [["the cat"], [], ["<|bos|>", "a th\u00e9", "<|eos|>"], [""], None, ["x" * 50, " 12"], ["the"], ["'ll go"]]
    lists = pa.array([["cut off"], *rows], pa.list_(pa.string())).slice(1)
    whole = tk._gathered(lists, coder, names).to_pylist()
    held = []
    monkeypatch.setattr(tk, "SLICE_BYTES", 20)
    monkeypatch.setattr(tk.pretokenise, "cut", lambda texts, w: held.append(sum(len(t.encode()) for t in texts.to_pylist())) or cut(texts, w))
    assert tk._gathered(lists, coder, names).to_pylist() == whole
    assert held == [7, 20, 53, 9]
    assert tk._counted(lists, coder, names).to_pylist() == [len(w) for w in whole]
    tokens = pa.array([cut(pa.array(r or [], pa.string()), names)[0].to_pylist() for r in rows], pa.list_(pa.string()))
    assert tk._gathered(tokens, coder).to_pylist() == whole and whole[2][0] == encoder.bos and whole[1] == whole[4] == []
    assert tk._gathered(lists.slice(0, 0), coder, names).to_pylist() == []


def test_texts_with_literals_are_dealt_to_small_tasks(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, tables.special_docs(spark, sf_dir).collect()))
    monkeypatch.setattr(tables, "SMALL_TASK_BYTES", 10_000)
    docs = tables.special_docs(spark, sf_dir)
    # Of a table of any size: it does not matter how its files are split.
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1)
    many = tables.special_docs(spark, sf_dir)
    for df in (docs, many):
        assert df.rdd.getNumPartitions() == -(-tables.file_bytes(spark, sf_dir, "documents") // 10_000) > 20
        assert sorted(map(tuple, df.collect())) == want


def test_joined_encoding_and_cut_characters(spark, small_merges):
    encoder = tk.Encoder.extended(small_merges)
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "ord long, text string")
    one = sorted(map(tuple, tk.encode_docs(df, encoder).collect()))
    assert one == sorted(map(tuple, tk.encode_docs_by_join(df, encoder).collect())) and len(one) > 8
    decoded = tk.decode_docs(tk.encode_docs(df, encoder), encoder).collect()
    assert {r.ord: r.text for r in decoded}[5] == ODD_TEXTS[5]
    # The first two bytes of an emoji alone are no character.
    first = df.filter("ord = 5").select(encoder.decode(F.slice(encoder.encode(F.col("text")), 1, 2)).alias("t")).first()
    assert first.t and set(first.t) == {"\ufffd"}


def test_the_two_encoders_differ_in_special_tokens_only(spark, small_merges):
    base, extended = tk.Encoder.base(small_merges), tk.Encoder.extended(small_merges)
    n = 256 + len(small_merges)
    assert base.special == {"<|endoftext|>": n} and base.vocab_size == n + 1
    assert list(extended.special.values()) == [n + 1, n + 2, n + 3, n + 4]
    df = spark.createDataFrame([("<|endoftext|>",), ("<|bos|>",)], "t string")
    rows = df.select(base.encode(F.col("t")).alias("b"), extended.encode(F.col("t")).alias("e")).collect()
    assert rows[0].b == [n] and len(rows[0].e) > 1 and max(rows[0].e) < n
    assert len(rows[1].b) > 1 and rows[1].e == [n + 1]


def test_pretokens_with_special_tokens(spark):
    tiktoken = pytest.importorskip("tiktoken")
    from corpusloom.functions import fixed_values as fx

    # One id per byte: token boundaries then show in decoded pieces only, so use
    # the pattern itself on the parts between special tokens.
    import regex

    texts = [
        "I'll go  now\n\n there\n x", "a  <|bos|> b!!<|eos|>", "<|pad|><|unk|>", "<<|bos|>>  ",
        "1234 été　x", "  lead", "tail  ", "<|bos", "",
    ]
    assert tiktoken is not None
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tk.pretokens(F.col("t"))).collect()]
    special = "(" + "|".join(regex.escape(t) for t in fx.SPECIAL_TOKENS) + ")"
    for text, pieces in zip(texts, got):
        want = []
        for part in regex.split(special, text):
            want += [part] if part in fx.SPECIAL_TOKENS else regex.findall(fx.PRETOKEN, part)
        assert pieces == want and "".join(pieces) == text


def test_language_on_held_out_documents(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    fold = F.conv(F.substring(F.md5(F.col("ord").cast("string")), 1, 4), 16, 10).cast("int") % 5
    model = language.fit_language(docs.filter(fold != 0))
    found = language.detect_language(
        docs.filter(fold == 0).withColumnRenamed("lang", "given"), model
    )
    rate = found.agg(F.avg((F.upper("given") == F.col("lang")).cast("double"))).first()[0]
    assert rate > 0.9
    odd = spark.createDataFrame([(1, "12 34"), (2, ""), (3, None)], "ord bigint, text string")
    assert {r.lang for r in language.detect_language(odd, model).collect()} == {"UNKNOWN"}
    # Neighbours in a batch do not influence each other.
    alone = language.detect_language(docs.select("ord", "text").repartition(17), model)
    together = language.detect_language(docs.select("ord", "text").coalesce(1), model)
    assert alone.exceptAll(together).isEmpty()


def test_cleaning_keeps_every_document_once(spark, sf_dir):
    noisy = tables.noisy_docs(spark, sf_dir)
    verdicts = clean.clean_verdicts(noisy, lang_col="lang")
    assert verdicts.count() == noisy.count() == verdicts.select("ord").distinct().count()
    assert verdicts.filter((F.col("verdict") == "KEPT") != F.col("text").isNotNull()).isEmpty()


def test_histogram_of_equal_values(spark):
    rows = stats.histogram(spark.createDataFrame([(5,), (5,)], "length int"), 4).orderBy("bin").collect()
    assert sum(r.docs for r in rows) == 2 and rows[0].low == 4.5 and rows[-1].high == 5.5


def test_special_tokens_are_cut_out_without_recursion(spark):
    texts = ["<|bos|>" + "<" * 1_000_000, "a  <|eos|> b<<|pad|>>c", "<|unk|><|unk|>", "plain <text|>"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(tk.pretokens(F.col("text"))).collect()]
    assert got[0] == ["<|bos|>", "<" * 1_000_000]
    assert got[1] == ["a", "  ", "<|eos|>", " b", "<", "<|pad|>", ">", "c"]
    assert got[2] == ["<|unk|>", "<|unk|>"]
    assert "".join(got[3]) == texts[3]


def test_null_texts_are_never_the_longest(spark):
    rows = [(i, "x" * i if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "ord long, text string")
    paths = [[r.ord for r in sample.longest_docs(df, 5, direct_rows=d).collect()] for d in (0, 1000)]
    assert paths[0] == paths[1] == [38, 37, 35, 34, 32]
    every = sample.longest_docs(df, 40).collect()
    assert len(every) == 40 and every[-1].n_chars is None


def test_model_of_a_sample_scores_like_the_whole_model(spark):
    texts = [(i, f"the cat {'sat ' * (i % 4)}on mat {i % 7}") for i in range(60)]
    df = spark.createDataFrame(texts, "ord long, text string")
    sample_ = df.filter("ord < 5")
    whole = perplexity.BigramModel.load(perplexity.fit_lm(df))
    part = perplexity.lm_for(df, sample_)
    scored = [perplexity.perplexity(sample_, m).orderBy("ord").collect() for m in (whole, part)]
    assert scored[0] == scored[1] and len(part.tokens) < len(whole.tokens) + 1


def test_model_of_a_sample_counts_its_grams_where_texts_are_read(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "\u00e9", "cc", "d1d", "E"]) for _ in range(rng.randrange(9))) for _ in range(50)]
    rows = [(i % 45, t) for i, t in enumerate([*texts, None, "", "one", texts[0]])]
    df = spark.createDataFrame(rows, "ord long, text string").repartition(3)
    whole = perplexity.BigramModel.load(perplexity.fit_lm(df))
    # The grams of all texts are neither made into rows nor shuffled.
    monkeypatch.setattr(perplexity, "ngram_pairs", None)
    monkeypatch.setattr(perplexity, "WORD_ROWS", 4)
    monkeypatch.setattr(perplexity, "SLICE_ROWS", 3)
    for scored in (df, df.filter("ord < 4"), df.filter("ord = 50"), df.filter("ord < 0")):
        part = perplexity.lm_for(df, scored)
        got = [sorted(map(str, perplexity.perplexity(scored, m).collect())) for m in (whole, part)]
        assert got[0] == got[1] and (part.total, part.vocabulary) == (whole.total, whole.vocabulary)


def test_report_of_a_sample_loads_only_the_weights_it_asks_for(spark, monkeypatch):
    from corpusloom.operators import quality

    words = [f"w{x}{y}" for x in "abcdefghij" for y in "klmnopqrst"]
    df = spark.createDataFrame([(i, f"the {w} cat {w}") for i, w in enumerate(words)], "ord long, text string")
    odds = toxicity.fit_toxicity(df.select("text", (F.col("ord") % 3 == 0).cast("int").alias("toxic")))
    whole = toxicity.ToxicityModel.load(odds)
    monkeypatch.setattr(quality, "detect_language", lambda df, _: df.withColumn("lang", F.lit("EN")))
    want = sorted(map(str, quality.quality_report(df, None, whole, n=5).collect()))
    loaded = []
    monkeypatch.setattr(toxicity, "small_table", lambda t: loaded.append(t.count()) or lookup.small_table(t))
    assert sorted(map(str, quality.quality_report(df, None, odds, n=5).collect())) == want
    assert loaded and max(loaded) < 20 < odds.count()


def test_fitted_models_of_the_jobs_pass_no_weights_through_the_driver(spark, sf_dir, monkeypatch):
    from corpusloom.plans import registry

    def loads(*_):
        raise AssertionError("all weights loaded")

    monkeypatch.setattr(toxicity.ToxicityModel, "load", loads)
    assert registry._fitted(spark, sf_dir).toxicity.columns == ["token", "n_toxic", "n_clean", "weight"]


def test_models_over_the_cap_score_by_join_like_models_in_memory(spark, monkeypatch):
    texts = [(i, f"the cat {'sat ' * (i % 4)}on mat {'abcdefg'[i % 7]} w{'xyz'[i % 3] * (i % 9)}") for i in range(60)]
    df = spark.createDataFrame([*texts, (60, None), (61, ""), (62, "one")], "ord long, text string")
    labels = df.select("text", (F.col("ord") % 3 == 0).cast("int").alias("toxic"))
    odds = toxicity.fit_toxicity(labels)
    whole = perplexity.BigramModel.load(perplexity.fit_lm(df))
    expected = perplexity.perplexity(toxicity.toxicity_score(df, toxicity.ToxicityModel.load(odds)), whole)
    columns = ("ord", "log_odds", "loss", F.round("perplexity", 9))
    expected = expected.select(*columns).orderBy("ord").collect()
    # No table may be loaded any more, and most grams are joined by shuffle.
    monkeypatch.setattr(lookup, "small_table", None)
    monkeypatch.setattr(perplexity, "small_table", None)
    monkeypatch.setattr(lookup, "HOT_KEYS", 20)
    scored = perplexity.corpus_perplexity(toxicity.toxicity_by_join(df, odds))
    got = scored.select(*columns).orderBy("ord").collect()
    assert [tuple(r)[:2] + tuple(r)[3:] for r in got] == [tuple(r)[:2] + tuple(r)[3:] for r in expected]
    assert [r.loss for r in got if r[3] is not None] == [r.loss for r in expected if r[3] is not None]


def test_profile_keeps_every_trigram(spark):
    df = spark.createDataFrame([("abcd", "en"), ("wxyz", "fr")], "text string, lang string")
    assert language.fit_profile(df).select("gram").distinct().count() == 8


def test_slices_hold_every_trigram_once():
    rng = random.Random(3)
    texts = [None, "", "a", "ab", "abc", "x" * 37] + ["".join(rng.choice("abé\U0001f600") for _ in range(rng.randrange(60))) for _ in range(80)]
    want = [[t[i : i + 3] for i in range(len(t or "") - 2)] for t in texts]
    for chars in (5, 16, 1000):
        got = [[] for _ in texts]
        for codes, rows, ends in language.slices(texts, chars):
            assert len(codes) == ends[-1] <= chars + 2
            keys, inside = language.trigrams(codes, ends)
            of = np.searchsorted(ends, np.arange(len(keys)), "right")
            for k, r in zip(keys[inside].tolist(), rows[of[inside]].tolist()):
                got[r].append(language._gram(k))
        assert [sorted(x) for x in got] == [sorted(x) for x in want]


def test_language_model_in_many_parts(spark, sf_dir, monkeypatch):
    docs = tables.documents(spark, sf_dir)
    profile = language.fit_profile(docs.select("text", "lang"))
    whole = language.LanguageModel.load(profile)
    split = language.LanguageModel.load(profile, part_bytes=20_000)
    assert len(whole.parts) == 1 and len(split.parts) > 5
    assert sum(p.n for p in split.parts) == whole.parts[0].n == profile.select("gram").distinct().count()
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x"), (-4, "\U0001f600 日本語 été"), (-5, "the " * 300_000)], "ord bigint, text string")
    every = docs.select("ord", "text").union(odd)
    one, many = (
        sorted((r.ord, r.s) for r in every.select("ord", m.scores(F.col("text")).alias("s")).collect()) for m in (whole, split)
    )
    assert one == many
    # Against sums by join, where a text is never cut.
    weights = {(r.lang, r.gram): r.weight for r in profile.collect()}
    letters = {r.ord: r.t for r in every.select("ord", language.letters_only(F.col("text")).alias("t")).collect()}
    for ord_, scores in one:
        grams = [letters[ord_][i : i + 3] for i in range(len(letters[ord_] or "") - 2)]
        known = [g for g in grams if (whole.langs[0], g) in weights]
        assert scores == [sum(weights[x, g] for g in known) for x in whole.langs] + [len(known)]


def test_full_report_scores_each_document_once(spark, monkeypatch):
    from corpusloom.operators import quality

    seen = []

    def measured(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn("perplexity", F.lit(1.0))

    monkeypatch.setattr(quality, "corpus_perplexity", measured)
    monkeypatch.setattr(quality, "detect_language", lambda df, _: df.withColumn("lang", F.lit("EN")))
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (2, "c"), (None, None)], "ord bigint, text string")
    toxic = spark.createDataFrame([("", 0), ("a", 5)], "token string, weight bigint")
    report = {(r.section, r.name): r.value for r in quality.quality_report(docs, None, toxic, n=None).collect()}
    assert report["sample", "samples_analyzed"] == 4 and report["language", "EN"] == 4
    assert "Relation" in seen[0] and "Join" not in seen[0]


def test_histogram_works_out_lengths_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def length(i):
        seen.add(1)
        return i % 7

    df = spark.range(50).select(length("id").alias("length"))
    assert sum(r.docs for r in stats.histogram(df, 5).collect()) == 50
    assert seen.value == 50


def test_buckets_of_a_small_table_are_placed_by_several_tasks(spark):
    lengths = spark.createDataFrame([(i, 5 + i % 11) for i in range(400)], "ord long, length int")
    plan = packing.plan_blocks(lengths, 32, 64, 4)
    placed = packing.place_docs(plan)
    assert placed.count() == 400 and placed.rdd.getNumPartitions() > 1
    with_rows = placed.select(F.spark_partition_id().alias("p")).distinct().count()
    assert with_rows > 1


def test_special_tokens_are_cut_out_wherever_they_stand(spark):
    texts = ["a <|pad|>b", "<|bos|><|eos|>", "<|pad|", "x <|unk|> <|unk|>", "no", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(tk.pretokens(F.col("t"))).collect()]
    assert got[0] == ["a", " ", "<|pad|>", "b"] and got[1] == ["<|bos|>", "<|eos|>"] and got[3].count("<|unk|>") == 2
    assert ["".join(g) for g in got] == texts


def test_pretokens_of_the_pattern_in_arrays(spark):
    """Tokens as the pattern cuts them, in chunks of any size; counts of them without a row per token."""
    import regex

    from corpusloom.functions import pretokenise

    space = fixed.SPACE_CLASS.replace(r"\x1c-\x20", r"\x20")
    pattern = regex.compile(
        rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{space}\p{{L}}\p{{N}}]+|[{space}]+(?![^{space}])|[{space}]+"
    )
    some = random.Random(7)
    signs = list("''''  \t\nstdmlrvea1.\u00e9\u0301\u00a0\u3000\x85\u0663\u4e2d\U0001f600\u00bd,\x1c")
    texts = ["".join(some.choices(signs, k=some.randint(0, 14))) for _ in range(20_000)]
    want = [pattern.findall(t) for t in texts]
    before = pretokenise.CHUNK
    try:
        for pretokenise.CHUNK in (50, before):
            tokens, sizes = pretokenise.cut(pa.array(["x", *texts]).slice(1), [])
            assert sizes.tolist() == [len(w) for w in want]
            assert tokens.to_pylist() == [token for w in want for token in w]
    finally:
        pretokenise.CHUNK = before
    tokens, sizes = pretokenise.cut(pa.array(["a b", "", "<|bos|>"]), ["<|bos|>"])
    assert tokens.to_pylist() == ["a", " b", "<|bos|>"] and sizes.tolist() == [2, 0, 1]
    df = spark.createDataFrame([(1, "it's<|bos|>it's"), (2, None), (3, " "), (4, "ité it")], "ord long, text string")
    counts = tk.pretoken_counts(df)
    assert {r.token: r.n for r in counts.collect()} == {"it": 2, "'s": 2, "ité": 1, " it": 1}
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    got = df.select("ord", tk.pretokens(F.col("text")).alias("p")).orderBy("ord").collect()
    assert [r.p for r in got] == [["it", "'s", "<|bos|>", "it", "'s"], None, [" "], ["ité", " it"]]


def test_large_tables_of_few_row_groups_are_dealt_out(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/one/documents.parquet")
    rows.repartition(32).write.parquet(f"{tmp_path}/many/documents.parquet")
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1)

    def dealt(folder):
        docs = tables.documents(spark, f"{tmp_path}/{folder}")
        assert docs.count() == 1000
        return "RepartitionByExpression" in docs._jdf.queryExecution().optimizedPlan().toString()

    assert dealt("one") and not dealt("many")


def test_shard_files_are_read_once(spark, sf_dir, monkeypatch):
    from corpusloom.plans import registry

    read, calls = sharding.read_shards, []
    monkeypatch.setattr(sharding, "read_shards", lambda *a: calls.append(a) or read(*a))
    shards = registry.all_queries()["shards_roundtrip"](spark, sf_dir).collect()
    assert len(calls) == 1 and all(r.files == 1 and r.tokens == r.blocks * fixed.BLOCK_SIZE for r in shards)
