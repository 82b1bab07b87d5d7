import random
from collections import Counter

from corpusloom.llm import relative_lz


def slow(pairs, window=35):
    texts = [(t or "").encode().split() for _, t in pairs]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), words in zip(pairs, texts):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc_id, len(words), len(gone), kept))
    return sorted(map(repr, out))


def fast(docs, **options):
    return sorted(map(repr, map(tuple, relative_lz.remove_repeats(docs, **options).collect())))


def test_odd_rows(make_docs, odd_pairs):
    assert fast(make_docs(odd_pairs)) == slow(odd_pairs)


def test_planted_passages(make_docs):
    rng = random.Random(11)
    word = lambda n: f"w{rng.randrange(n)}"
    passage = [word(9999) for _ in range(80)]
    pairs = []
    for i in range(60):
        words = [word(9999) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            a, n = rng.randrange(len(passage)), rng.randrange(30, 80)
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[a : a + n]
        pairs.append((i, " ".join(words)))
    pairs += [(90, "the same line " * 40), (91, " ".join(passage[:35])), (92, " ".join(passage[:34]))]
    assert fast(make_docs(pairs)) == slow(pairs)


def test_hot_and_other_keys_give_the_same_spans(make_docs, monkeypatch):
    """A line that a third of all documents share, in contexts of their own, and rarer repeats beside it."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(9999)}"
    line, rare = [word() for _ in range(60)], [[word() for _ in range(45)] for _ in range(12)]
    pairs = []
    for i in range(150):
        words = [word() for _ in range(rng.randrange(30, 90))]
        words[20:20] = line if i % 3 == 0 else rare[i % 12]
        pairs.append((i, " ".join(words)))
    docs, want = make_docs(pairs), slow(pairs)
    for hot in (1, 8, 1 << 40):  # none, the shared line alone, all
        monkeypatch.setattr(relative_lz, "HOT_KEYS", hot)
        assert fast(docs) == want


def test_hot_keys_are_joined_without_a_shuffle_of_their_rows(spark):
    rows = spark.range(1000).selectExpr("if(id < 400, 7, id) AS k", "id AS v")
    keys = rows.groupBy("k").count()
    got = relative_lz._join_by(rows, keys.selectExpr("k", "count AS places"), ["k"], "places", 1000)
    assert sorted(map(tuple, got.collect())) == sorted((7 if i < 400 else i, i) for i in range(1000))
    assert got._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 2


def test_small_windows_on_few_words(make_docs):
    rng = random.Random(2)
    pairs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(40)]
    assert fast(make_docs(pairs), window=6, gram=2) == slow(pairs, 6)


def test_columns_are_kept(make_docs):
    row = relative_lz.remove_repeats(make_docs([(1, "a b")]), keep=("lang", "packed")).first()
    assert (row.lang, row.packed, row.kept) == ("en", "x", "a b")


def test_empty(make_docs):
    assert fast(make_docs([])) == []


def _thue_morse(order, a="a", b="b"):
    word, other = a, b
    for _ in range(order):
        word, other = word + other, other + word
    return word, other


def test_regular_words_and_runs_do_not_collide(make_docs):
    words = [f"w{i}" for i in range(34)]
    long = _thue_morse(10)
    # One word of 1,024 letters differs; so do words of 32, and runs of one-letter words.
    pairs = [(i, " ".join([*words[:20], long[i], *words[20:]])) for i in range(2)]
    pairs += [(10 + i, " ".join([*words[:9], w, *words[9:]])) for i, w in enumerate(_thue_morse(5))]
    pairs += [(20 + i, " ".join(t)) for i, t in enumerate(_thue_morse(6))]
    blocks = _thue_morse(5, "a" * 31, "b" * 31)
    pairs += [(30 + i, " ".join(b[k : k + 31] for k in range(0, len(b), 31)) + " x y z") for i, b in enumerate(blocks)]
    assert fast(make_docs(pairs)) == slow(pairs)
    assert fast(make_docs(pairs + [(40, pairs[0][1])])) == slow(pairs + [(40, pairs[0][1])])
