import random
import tracemalloc
import zlib

import numpy as np

from corpusloom.llm import toxicity

BAD = ["zorgle", "blamfit", "krunto"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
        bad = i % 4 == 0
        for _ in range(4 * bad):
            words[rng.randrange(60)] = rng.choice(BAD) + rng.choice(["", "s", "ed"])
        out.append((i, " ".join(words), int(bad)))
    return out


def test_learns_and_catches_misspellings(spark, make_docs):
    rows = corpus()
    docs = make_docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    truth = {i: y for i, _, y in rows}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in truth if got[i].held_out] == held
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.95
    clean = corpus(seed=9)[1][1]
    average = lambda t: toxicity.average(toxicity._Sums(model.logit).__getitem__, t)
    assert average(clean + " zorgless krunttos blamfitt zorglle") > average(clean)


def test_words_far_into_a_text_teach(spark, make_docs):
    front = "plain words of no kind " * 200
    rows = [(i, front + t, y) for i, t, y in corpus(200)]
    docs = make_docs([(i, t) for i, t, _ in rows])
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    average = lambda t: toxicity.average(toxicity._Sums(model.logit).__getitem__, t)
    assert all(average(front + bad) > average(front) for bad in BAD)


def test_rare_words_get_a_vector():
    texts = [f"{'vilest ' if i in (1, 7, 13, 19) else ''}calm {i % 2} tree" for i in range(600)]
    model = toxicity.fit(texts, [int("vilest" in t or i % 5 == 0) for i, t in enumerate(texts)], 0.2)
    assert model.logit[toxicity.subwords("vilest")].any()


def test_held_out_labels_are_never_read(spark, make_docs):
    rows = corpus(200)
    docs = make_docs([(i, t) for i, t, _ in rows])
    flip = lambda i, y: 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y
    models = [
        toxicity.train(docs, spark.createDataFrame([(i, f(i, y)) for i, _, y in rows], "doc_id long, toxic int"))
        for f in (lambda i, y: y, flip)
    ]
    assert (models[0].logit == models[1].logit).all() and models[0].offset == models[1].offset


def test_odd_rows(spark, make_docs, odd_pairs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs(odd_pairs)
    got = toxicity.score_documents(docs, toxicity.train(docs, none)).collect()
    assert len(got) == len(odd_pairs) and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    assert toxicity.score_documents(make_docs([]), toxicity.train(make_docs([]), none)).collect() == []


def test_sums_in_chunks_are_those_of_one_pass(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    rng = np.random.default_rng(3)
    values, weight = rng.normal(size=(40, 3)), rng.uniform(size=500)
    at, to = rng.integers(0, 40, 500).astype(np.int32), rng.integers(0, 11, 500).astype(np.int32)
    for w in (None, weight):
        each = [np.bincount(to, values[at, k] * (1.0 if w is None else w), 12) for k in range(3)]
        assert (toxicity._row_sums(values, at, to, 12, w) == np.stack(each, 1)).all()


def test_fit_holds_little_besides_its_arrays(monkeypatch):
    monkeypatch.setattr(toxicity, "PASSES", 1)
    rng = np.random.default_rng(4)
    texts = [" ".join(np.base_repr(w, 36) for w in rng.integers(10**9, 10**9 + 30_000, 2_000)) for _ in range(200)]
    tracemalloc.start()
    toxicity.fit(texts, [i % 2 for i in range(200)], 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000
