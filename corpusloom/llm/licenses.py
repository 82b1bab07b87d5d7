"""License scans: notice phrases and identifier tags by Aho-Corasick, expressions by a shunting-yard.

One automaton runs over the words of a text and finds notice phrases at word boundaries; another finds
identifier tags in the lower-cased text. What follows a tag is parsed as a licence expression with OR, AND
and WITH and evaluated: its labels, and how freely the text may be used (OR: the freest side, AND: the
strictest, WITH: an exception that loosens by one step).
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import id_text

# The phrases of the contract and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Further notices, by their words, and their labels.
MORE_PHRASES = {
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
# How freely a label lets a text be used, from 0 (not) to 1; labels that are not listed have 0.5.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "apache": 0.9,
    "cc-by": 0.8, "cc-by-sa": 0.6, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3,
    "cc": 0.5, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "reserved": 0.0,
}
#: Evidence of a tag and of a phrase; that of several adds up like independent witnesses.
TAG_WEIGHT, PHRASE_WEIGHT, WITH_STEP = 0.95, 0.7, 0.1

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_VERSION = re.compile(r"-?v?\d[\d.]*(-only|-or-later|\+)?$|\+$")


def _word_bytes() -> bytes:
    """Upper-case letters become lower-case; ASCII that is no letter or digit becomes a space."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(table)


_WORD_BYTES = _word_bytes()


def label_of(identifier: str) -> str:
    """Family of an identifier: without its version, so that all of one family share a label."""
    family = _VERSION.sub("", identifier)
    if family.startswith("bsd"):
        return "bsd"
    return family or identifier


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard; raises ValueError where the expression is not well formed."""
    out, waiting, operand = [], [], True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand:
                raise ValueError("operator expected")
            waiting.append(token)
        elif token == ")":
            if operand or "(" not in waiting:
                raise ValueError("unmatched parenthesis")
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif token in _PRECEDENCE:
            if operand:
                raise ValueError("identifier expected")
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                raise ValueError("operator expected")
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        raise ValueError("incomplete")
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """(labels, freedom). The name after WITH is an exception, not a licence."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, min(1.0, a + WITH_STEP)))
            else:
                if len(left) < len(right):
                    left, right = right, left
                left |= right
                stack.append((left, max(a, b) if token == "or" else min(a, b)))
        else:
            label = label_of(token)
            stack.append(({label}, FREEDOM.get(label, 0.5)))
    return stack[0]


def read_expression(text: str, start: int = 0) -> tuple[set[str], float] | None:
    """The longest well-formed expression that the line at `start` starts with; None if there is none.

    One pass: the shunting-yard runs on while the tokens can be continued, and what counts is what it had
    where the expression was last complete. A line's end is one of the expression, unless a parenthesis is
    open.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand, depth, last = True, 0, start
    complete: tuple[int, list[str]] | None = None  # how much of out, and the operators after it
    for found in _TOKEN.finditer(text, start):
        token = found[0]
        if not depth and "\n" in text[last : found.start()]:
            break
        last = found.end()
        if token == "(":
            if not operand:
                break
            waiting.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
            depth -= 1
        elif token in _PRECEDENCE:
            if operand:
                break
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                break
            out.append(token)
            operand = False
        if not operand and not depth:
            # Outside parentheses at most one operator of each precedence waits.
            complete = len(out), waiting[::-1]
    return evaluate(out[: complete[0]] + complete[1]) if complete else None


@functools.lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for base, table in ((True, BASE_PHRASES), (False, MORE_PHRASES)):
        for phrase, label in table.items():
            phrases.add_word(f" {phrase} ", (len(phrase), label, base))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan(text: str) -> dict:
    phrases, tags = _automata()
    data = text.encode()
    words = data.translate(_WORD_BYTES).split()
    joined = f" {b' '.join(words).decode()} "
    base, starts, labels = set(), [], {}
    for end, (back, label, is_base) in phrases.iter(joined):
        labels[label] = max(labels.get(label, 0.0), PHRASE_WEIGHT)
        if is_base:
            base.add(label)
            starts.append(end - back)
    freedom = [FREEDOM[label] for label in labels]
    lower = data.lower().decode()  # ASCII only, as in the words
    for end, _ in tags.iter(lower):
        if (found := read_expression(lower, end + 1)) is not None:
            labels |= dict.fromkeys(found[0], TAG_WEIGHT)
            freedom.append(found[1])
    at = (None, None)
    if starts:
        at = tuple(joined.count(" ", 0, p) for p in (min(starts), max(starts)))
        at = (at[0] - 1, at[1] - 1)  # one blank stands before the first word
    doubt = 1.0
    for weight in labels.values():
        doubt *= 1 - weight
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": at[0], "last_word": at[1],
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
        "score": 1 - doubt, "freedom": min(freedom) if freedom else None,
    }


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
     ("score", pa.float64()), ("freedom", pa.float64())]
)


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per input row, over whole texts.

    n_base counts all places of the base phrases, first_word and last_word are the smallest and largest
    word (from 0) at which one starts, else null. score is the evidence for any licence, freedom the
    strictest use that the text's notices and expressions allow (null without any). Null texts are
    empty: no words, no labels (empty strings), score 0.
    """

    def run(batches):
        for batch in batches:
            rows = [
                {"doc_id": doc_id, **scan(text.as_py())}
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return id_text(docs).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, freedom double",
    )
