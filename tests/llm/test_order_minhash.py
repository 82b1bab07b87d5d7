import hashlib
import random
import re
import struct

import xxhash

from corpusloom.llm import order_minhash as om


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def hashed(*values):
    """XXH64 over values, each seeding the next; nulls are skipped."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q" if isinstance(v, int) and abs(v) >= 2**31 or v is None else "<q", v)
            seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def hashed_mixed(kmer, number):
    seed = xxhash.xxh64_intdigest(struct.pack("<q", kmer), 42)
    # A row number is a 32-bit integer.
    return signed(xxhash.xxh64_intdigest(struct.pack("<i", number), seed))


def slow(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    pairs = list(zip(words, words[1:])) or [(w, None) for w in words]
    seen, slots = {}, {}
    for pos, (a, b) in enumerate(pairs):
        kmer = hashed(a, b)
        seen[kmer] = seen.get(kmer, 0) + 1
        h = hashed_mixed(kmer, seen[kmer])
        slot = h % (2 * om.TUPLES)
        slots[slot] = min(slots.get(slot, (h, pos)), (h, pos))
    out = []
    held = sorted(slots)
    for t in range(om.TUPLES if held else 0):
        # The two slots of the tuple, or the next ones around that hold a k-mer.
        around = [s for s in held if s >= 2 * t] + held
        two = sorted(slots[s][::-1] for s in (around[0], (around + held)[1]))
        out.append(f"{hashed(two[0][1], two[-1][1]) & 0xFFFFFFFF:08x}")
    return "".join(out) or om._EMPTY * om.TUPLES


def like(a, b):
    cut = lambda s: [s[i : i + 8] for i in range(0, len(s), 8)]
    pairs = [(x, y) for x, y in zip(cut(a), cut(b)) if x != om._EMPTY or y != om._EMPTY]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def expected(pairs):
    order = sorted(((i is None, -(i or 0), t or "") for i, t in pairs))
    rows = []
    for k, (none, i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        prints = [slow(x) for x in (text, edited, after)]
        rows.append((None if none else -i, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1],
                     like(prints[0], prints[1]), like(prints[0], prints[2])))
    return sorted(map(repr, rows))


def test_odd_rows(make_docs, odd_pairs):
    got = om.compare_edits(make_docs(odd_pairs)).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected(odd_pairs)


def test_many_ranges(make_docs):
    rng = random.Random(1)
    pairs = [(rng.randrange(50), " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(30)))) for _ in range(150)]
    got = om.compare_edits(make_docs(pairs)).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected(pairs)


def test_order_counts_and_edits_lower_the_likeness():
    words = [f"w{i}" for i in range(400)]
    rng = random.Random(2)
    edited = words[:]
    for at in rng.sample(range(400), 8):
        edited[at] = "x"
    own = slow(" ".join(words))
    assert like(own, slow(" ".join(edited))) > 0.6


def _kmer_set(text):
    words = text.split()
    return set(zip(words, words[1:]))


def test_moves_of_the_same_kmers_lower_the_likeness():
    """Long runs change places: nearly all k-mers stay, their order does not. Without order this fails."""
    for n, runs in ((400, 4), (24, 3)):
        words = [f"w{i}" for i in range(n)]
        size = n // runs
        parts = [words[i : i + size] for i in range(0, n, size)]
        moved = " ".join(w for part in parts[::-1] for w in part)
        text = " ".join(words)
        shared = len(_kmer_set(text) & _kmer_set(moved)) / len(_kmer_set(text) | _kmer_set(moved))
        assert shared > 0.8
        assert like(slow(text), slow(moved)) < 0.62 < shared


def test_every_tuple_of_a_short_text_holds_two_kmers(spark):
    text = "a b c d e f g h"
    found = om.sketches(spark.createDataFrame([(1, text)], "k int, text string"), ["k"], "text").first().hashes
    assert len(found) == om.TUPLES and "".join(f"{h:08x}" for h in found) == slow(text)
    words = text.split()
    single = {hashed(h, h) & 0xFFFFFFFF for p in zip(words, words[1:]) for h in [hashed_mixed(hashed(*p), 1)]}
    assert not single & set(found)


def test_empty_and_single(make_docs):
    assert om.compare_edits(make_docs([])).collect() == []
    row = om.compare_edits(make_docs([(5, "one text only here")])).first()
    assert row.near_next == 1.0


def test_no_python_in_the_plan(make_docs):
    plan = om.compare_edits(make_docs([(1, "a b"), (2, "c d")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
