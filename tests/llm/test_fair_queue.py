"""Fair queueing against a sequential loop; targets against repeated resharing; odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import fair_queue


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(1, 2, 3), repeats=3):
    """Shares by weight; what passes a limit is reshared until none does."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= repeats * sizes[s]}
        if not above:
            return target | share, names
        for s in above:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        free -= above
    return target, names


def brute(rows, packet, repeats=3):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += n_words(text)
    target, names = brute_targets(sizes)
    packets = []
    for rank, source in enumerate(names):
        own = [(d, n_words(t), i) for i, (d, t, s) in enumerate(rows) if s == source]
        own.sort(key=lambda r: (
            hashlib.md5(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1]))
        sent = 0
        for place, (_, size, i) in enumerate(own):
            for turn in range(repeats if target[source] else 0):
                for start in range(0, size, packet):
                    end = min(start + packet, size)
                    finish = (turn * sizes[source] + sent + end) / target[source]
                    packets.append((finish, rank, turn, place, start, i, end - start))
            sent += size
    left, taken = sum(sizes.values()), Counter()
    for *_, i, words in sorted(packets):
        taken[i] += min(words, left)
        left -= min(words, left)
    return Counter(
        (d, n_words(t), sizes[s], round(target[s], 6), taken[i]) for i, (d, t, s) in enumerate(rows)
    ), target


def mixed(spark, rows, packet=fair_queue.PACKET):
    docs = spark.createDataFrame(
        [(*r, "p", 1, 2, "q") for r in rows],
        "doc_id long, text string, source string, place string, size int, target int, rank string",
    )
    return fair_queue.mix(docs, packet=packet).collect()


def random_rows(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "é", "\U0001f600", "z", None, ""])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40, 300])), source))
    return rows + [(None, "x y", "hot"), (None, None, "a"), (3, "a \t b\nc", "hot"), (3, "a \t b\nc", "hot"), (500, None, "none")]


@pytest.mark.parametrize("packet", [7, 1024])
def test_equals_a_sequential_queue(spark, packet):
    rows = random_rows(1)
    got = mixed(spark, rows, packet)
    want, target = brute(rows, packet)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == want
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert sum(taken.values()) == sum(r.size for r in got)
    # A source is off its target by the packets at the cut only.
    assert all(abs(taken[s] - t) <= packet * len(target) + 1 for s, t in target.items())


def test_one_long_document_does_not_move_its_source(spark):
    rows = [(1, "w " * 50_000, "a"), (2, "w " * 300, "b"), (3, "w " * 40_000, "b"), (4, "w " * 20_000, "c")]
    got = mixed(spark, rows, 100)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 300 for s, t in target.items())


def test_reruns_and_partitions_agree(spark):
    rows = random_rows(2)
    first, again = sorted(map(repr, mixed(spark, rows))), sorted(map(repr, mixed(spark, rows[::-1])))
    assert first == again


def test_no_words_and_no_rows(spark):
    assert [tuple(r) for r in mixed(spark, [(1, None, "a"), (2, " ", None)])] in (
        [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)], [(2, None, 0, 0, 0.0, 0), (1, "a", 0, 0, 0.0, 0)],
    )
    assert mixed(spark, []) == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = fair_queue.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
