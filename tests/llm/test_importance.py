"""Importance resampling against brute force; selection rounds; odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import importance
from corpusloom.llm.ranges import running_totals

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))


def runs(text, longest):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, buckets, longest, least, percent):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(of(f) for _, t in rows for f in runs(t, longest))
    t = Counter(of(f) for x in target for f in runs(x, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    out = []
    for doc_id, text in rows:
        found = runs(text, longest)
        weight = sum(gain[of(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, weight + noise, None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in out)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"Word{i}" for i in range(50)] + ["Été", "café", "\U0001f600", "it's", "a_b"]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 19, 20, 25, 60])))
    rows = [(i, text()) for i in range(n)]
    return rows + [(None, text() + " w" * 30), (None, None), (4, ""), (7, "a b " * 15), (7, "a b " * 15), (7, "a " * 31)]


def drawn(spark, rows, target, **how):
    docs = spark.createDataFrame(
        [(*r, "x", 1, "y", 2) for r in rows], "doc_id long, text string, low string, rank int, score string, none int"
    )
    found = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("longest,base", [(1, 50_000), (1, 3), (3, 10)])
def test_equals_brute_force(spark, longest, base):
    rows, target = random_rows(1), ["Word1 word2 café", None, "", "WORD3 word3 Été it's"]
    got = drawn(spark, rows, target, buckets=97, longest=longest, percent=30, base=base)
    assert got == brute(rows, target, 97, longest, 20, 30)


def test_no_rows_no_target_none_drawn(spark):
    assert drawn(spark, [], ["a"]) == Counter()
    rows = [(i, "a b c " * 10) for i in range(9)]
    assert drawn(spark, rows, [], buckets=10) == brute(rows, [], 10, 1, 20, 10)
    assert all(r[4] is None for r in drawn(spark, rows, [None], buckets=10))


@pytest.mark.parametrize("seed", range(4))
def test_selection_finds_every_kth_key(spark, seed):
    rng = random.Random(seed)
    keys = [(rng.randrange(20), 0, rng.randrange(5), 1) for _ in range(400)] + [(3, 0, 1, 1)] * 200
    table = spark.createDataFrame(keys, "low long, none long, id long, features long").repartition(7)
    table = importance.materialise(table, "test-keys")
    for k in (1, 2, 77, 300, 599, 600):
        assert importance.kth_key(table, k, base=20) == sorted(keys)[k - 1]


def test_weighted_median_has_half_of_the_keys_before_it():
    assert importance.weighted_median([((1,), 1), ((2,), 1), ((9,), 10)]) == (9,)
    assert importance.weighted_median([((5,), 3), ((1,), 3)]) == (1,)


def test_long_texts_in_parts(monkeypatch):
    text = " ".join(f"Wort{i % 91}é" for i in range(5000))
    whole = list(importance.features_in_parts(text.encode(), 1000, 3))
    monkeypatch.setattr(importance, "_SLICE", 64)
    parts = list(importance.features_in_parts(text.encode(), 1000, 3))
    assert len(whole) == 1 and len(parts) > 100
    assert sum(n for n, _ in parts) == 5000
    assert np.array_equal(np.sort(np.concatenate([p for _, p in parts])), np.sort(whole[0][1]))


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(50), i, rng.randrange(9)) for i in range(500)]
    table = spark.createDataFrame(rows, "a int, b int, n int").repartition(5)
    got = running_totals(table, [F.col("a").desc(), F.col("b").asc()], {"n": "before"}, "test-totals").collect()
    total = 0
    for want, r in zip(sorted(rows, key=lambda r: (-r[0], r[1])), sorted(got, key=lambda r: (-r.a, r.b))):
        assert (r.a, r.b, r.n, r.before) == (*want, total)
        total += r.n
    assert len(got) == 500
    assert running_totals(table.filter("a < 0"), [F.col("a").asc()], {"n": "before"}, "none").count() == 0
