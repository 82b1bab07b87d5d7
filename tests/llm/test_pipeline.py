"""Every stage of the pipeline against brute force, on odd rows and clashing columns."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import toxicity as toxic

CLASHES = ["text_key", "_id", "_words", "_removed", "_kept", "_key", "_row_key", "_toxicity", "row", "key", "score", "kept", "packed"]


def table(spark, pairs):
    rows = [(i, t, len(t) if t is not None else None, {"a": str(i)}) for i, t in pairs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, tags map<string,string>")
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])


def plain(df):
    """Rows as (doc_id, text, n_chars); all other columns must have passed through."""
    rows = df.collect()
    for r in rows:
        assert r.tags == {"a": str(r.doc_id)}
        assert all(r[c] == (None if r.doc_id is None else f"{c}-{r.doc_id}") for c in CLASHES)
    return Counter((r.doc_id, r.text, r.n_chars) for r in rows)


def expected(pairs):
    return Counter((i, t, len(t) if t is not None else None) for i, t in pairs)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(1)
    bad, good = ["grubble", "snarkit", "vexling"], [f"calm{i}" for i in range(40)]
    text = lambda toxic: " ".join(rng.choice(bad if toxic and rng.random() < 0.5 else good) for _ in range(30))
    marks = [(i, int(i % 3 == 0)) for i in range(240)]
    labelled = [(i, text(m)) for i, m in marks]
    spark.createDataFrame([*marks, (None, 1), (5000, None)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, " ".join(f"item{i}" for i in range(20))), (2, "a short one"), (None, "null id item words"), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, labelled, items


@pytest.fixture(scope="module")
def pairs(folder):
    _, labelled, items = folder
    rng = random.Random(2)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(60))
    out = labelled + [(400 + i, f"{' '.join(f'u{i}x{j}' for j in range(50))} {passage} tail{i}") for i in range(4)]
    out += [(500, passage), (501, f"start {items[0][1]} end"), (502, "lots of words " * 30 + items[1][1])]
    out += [(600, "copy " * 50), (601, "copy " * 50), (601, "copy " * 50), (None, "no id here"), (None, None)]
    return out + [(700, None), (701, ""), (702, " \t"), (703, "two words"), (703, "two words"), (704, "Été \U0001f600")]


def test_toxicity_stage(spark, folder, pairs):
    path, labelled, _ = folder
    docs = table(spark, pairs)
    kept = plain(corpus_pipeline.toxicity(spark, docs, path))
    model = toxic.train(docs.select("doc_id", "text"), spark.read.parquet(f"{path}/labels.parquet"))
    sums = lambda w: complex(sum(float(x) for x in model.logit[toxic.subwords(w)]), len(toxic.subwords(w)))
    score = lambda t: float(model.probability(np.array([toxic.average(sums, t or "")]))[0])
    assert kept == expected([(i, t) for i, t in pairs if score(t) < 0.5])
    held = [r for r in toxic.score_documents(docs, model).collect() if r.held_out and r.doc_id < 240]
    assert all(r.score == pytest.approx(score(dict(labelled)[r.doc_id])) for r in held)
    assert sum((r.doc_id % 3 == 0) == (r.score >= 0.5) for r in held) > 0.9 * len(held) > 20


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicate_stage(spark, folder, pairs):
    got = plain(corpus_pipeline.near_duplicates(spark, table(spark, pairs), folder[0]))
    prints = [fingerprint(t) for _, t in pairs]
    group = list(range(len(pairs)))
    find = lambda i: i if group[i] == i else find(group[i])
    for i in range(len(pairs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                group[find(i)] = find(j)
    groups = {}
    for i in range(len(pairs)):
        groups.setdefault(find(i), []).append(pairs[i])
    assert sum(got.values()) == len(groups)
    kept = {}
    for members in groups.values():
        least = min(members, key=lambda p: (p[0] is None, p[0] or 0))[0]
        kept[frozenset(members)] = least
    assert Counter(i for i, *_ in got.elements()) == Counter(kept.values())


def test_substring_stage(spark, folder, pairs):
    got = plain(corpus_pipeline.substrings(spark, table(spark, pairs), folder[0]))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in pairs]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for (doc_id, text), w in zip(pairs, words):
        gone = {p for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
        if len(gone) < len(w) or not w:
            want.append((doc_id, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else text))
    assert got == expected(want) and len(want) < len(pairs)


def test_benchmark_stage(spark, folder, pairs):
    path, _, items = folder
    got = plain(corpus_pipeline.benchmark_passages(spark, table(spark, pairs), path))
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {tuple(w[i : i + 13]) for _, t in items if (w := find(t)) for i in range(max(len(w) - 12, 1))}
    want = []
    for doc_id, text in pairs:
        w = find(text)
        hit = {p for win in windows for i in range(len(w) - len(win) + 1) if tuple(w[i : i + len(win)]) == win for p in range(i, i + len(win))}
        if not (hit and 20 * len(hit) >= len(w)):
            want.append((doc_id, text))
    assert got == expected(want) and 501 not in {i for i, _ in want} and 502 in {i for i, _ in want}


def test_packing_stage(spark, folder, pairs):
    rows = corpus_pipeline.packed_sequences(spark, table(spark, pairs), folder[0]).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in pairs)
    assert Counter((r.doc_id, r.length) for r in rows) == lengths
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096


def test_empty_tables(spark, folder):
    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_stages_are_chained(spark, folder, pairs, tmp_path):
    path = str(tmp_path / "run")
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    packed = corpus_pipeline.run(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text"]
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
