import random

import xxhash

from corpusloom.llm import simhash
from corpusloom.llm.components import components


def slow_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, bits=2):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def check(df, pairs):
    fps = [slow_simhash(t) for _, t in pairs]
    root = slow_components(set(fps))
    least = {}
    for (i, _), f in zip(pairs, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    expected = [(i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(pairs, fps)]
    rows = df.select("doc_id", simhash.hex_fingerprint(simhash.F.col("fp")).alias("f"), "component_id").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))


def test_odd_rows(make_docs, odd_pairs):
    check(simhash.near_components(make_docs(odd_pairs)), odd_pairs)


def test_near_copies_meet(make_docs):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    pairs = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        pairs.append((i, " ".join(words)))
    pairs += [(100 + i, " ".join(f"v{rng.randrange(5000)}" for _ in range(50))) for i in range(40)]
    check(simhash.near_components(make_docs(pairs)), pairs)


def test_long_lists_find_the_same_links(spark):
    rng = random.Random(5)
    near = {rng.getrandbits(64)}
    seed = next(iter(near))
    near |= {seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    values = sorted(near | {rng.getrandbits(64) for _ in range(50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp long")
    groups = []
    for bound in (2, 10_000):
        found = components(simhash.links(distinct, 2, list_pairs=bound))
        of = {r.u.fp: (r.root.half, r.root.fp) for r in found.collect() if r.u.half == 0}
        parts = {}
        for v in signed:
            parts.setdefault(of.get(v, v), set()).add(v)
        groups.append(sorted(map(sorted, parts.values())))
    slow = {}
    for v, r in slow_components(values).items():
        slow.setdefault(r, set()).add(v - (1 << 64) if v >> 63 else v)
    assert groups[0] == groups[1] == sorted(map(sorted, slow.values()))


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


def test_empty(make_docs):
    assert simhash.near_components(make_docs([])).collect() == []
