import re

import pytest

from corpusloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(doc_id, text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, l) for p, l in licenses.BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return (doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({l for _, l in at})))


def test_odd_rows(make_docs, odd_pairs):
    pairs = [*odd_pairs, (20, "MIT-License, mit license MIT  LICENSE\nThe Affero General Public License"),
             (21, "permit license; mit licenses"), (22, "apache license " * 3000), (23, "é mit license é")]
    got = licenses.scan_documents(make_docs(pairs)).collect()
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(repr(slow(*p)) for p in pairs)
    of = {r.doc_id: r for r in got}
    assert of[20].labels == "agpl,gpl,mit" and of[20].base_labels == "gpl,mit"
    assert of[4].score == 0.0 and of[4].labels == "" and of[4].freedom is None
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize(("text", "labels", "freedom"), [
    ("MIT", {"mit"}, 0.9),
    ("GPL-2.0-only OR MIT", {"gpl", "mit"}, 0.9),
    ("GPL-2.0-or-later AND MIT", {"gpl", "mit"}, 0.4),
    ("MIT OR Apache-2.0 AND GPL-3.0", {"mit", "apache", "gpl"}, 0.9),
    ("(MIT OR Apache-2.0) AND GPL-3.0", {"mit", "apache", "gpl"}, 0.4),
    ("GPL-2.0+ WITH Classpath-exception-2.0", {"gpl"}, 0.5),
    ("BSD-3-Clause", {"bsd"}, 0.9),
])
def test_expressions(text, labels, freedom):
    assert licenses.evaluate(licenses.to_postfix(text)) == (labels, freedom)


@pytest.mark.parametrize("text", ["", "OR", "MIT OR", "(MIT", "MIT)", "MIT Apache-2.0", "()", "AND MIT", "MIT (GPL)"])
def test_malformed(text):
    with pytest.raises(ValueError):
        licenses.to_postfix(text)


def test_tags():
    found = licenses.scan("x SPDX-License-Identifier: (MIT OR Apache-2.0) -->\nSPDX-License-Identifier: )(")
    assert found["labels"] == "apache,mit" and found["n_base"] == 0 and found["score"] > 0.9


def test_long_and_wrapped_expressions():
    long = "SPDX-License-Identifier: " + " AND ".join(["MIT"] * 60_000 + ["GPL-3.0-only"]) + "\nISC"
    found = licenses.scan(long)
    assert found["labels"] == "gpl,mit" and found["freedom"] == 0.4
    found = licenses.scan("SPDX-License-Identifier: (MIT OR\n Apache-2.0) AND GPL-2.0\nAND ISC")
    assert found["labels"] == "apache,gpl,mit" and found["freedom"] == 0.4
    # What comes before the point at which it breaks off still counts.
    assert licenses.scan("License-Expression: MIT OR (ISC AND\nBSD-3-Clause")["labels"] == "mit"
    assert licenses.scan("License-Expression: MIT\nOR ISC")["labels"] == "mit"


def test_empty(make_docs):
    assert licenses.scan_documents(make_docs([])).collect() == []
