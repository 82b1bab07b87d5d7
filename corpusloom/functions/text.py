"""Text transforms as column expressions (JVM side, no Python per row)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions.entities import decode_entities


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row.

    A column used several times, or inside a lambda, is otherwise evaluated at
    every use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_space(col: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(col, F.lit(fx.SPACE_CHARS))


def normalize_text(col: Column) -> Column:
    """Drop zero-width marks, blank out control characters, collapse runs, strip."""
    blanked = fx.NO_BREAK_SPACE + fx.CONTROL_CHARS
    # translate() maps position by position and deletes what has no partner, so
    # one pass replaces the blanked characters and removes the zero-width ones.
    out = F.translate(col, blanked + fx.ZERO_WIDTH, " " * len(blanked))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip_space(out)


def strip_html(col: Column) -> Column:
    """Script and style blocks, comments, tags out; entities decoded; one line."""
    out = F.regexp_replace(col, fx.SCRIPT_STYLE, " ")
    out = F.regexp_replace(out, fx.COMMENT, " ")
    out = F.regexp_replace(out, fx.TAG, " ")
    out = decode_entities(out)
    out = F.regexp_replace(out, rf"[{fx.SPACE_CLASS}]+", " ")
    return strip_space(out)


def text_lines(col: Column) -> Column:
    """Stripped, non-blank lines of a document."""
    lines = F.transform(F.split(col, fx.LINE_BREAK), strip_space)
    return F.filter(lines, lambda line: line != "")


def simhash_tokens(col: Column) -> Column:
    """Lower-cased ASCII alphanumeric tokens; no token gives an empty array."""
    words = F.btrim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))
    # Splitting an empty text gives one empty token.
    return F.array_remove(F.split(words, " "), "")


def token_chunks(tokens: Column, n: int = fx.SIMHASH_CHUNK) -> Column:
    """Disjoint groups of n tokens joined by a space; the last may be short."""

    def chunks(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(n))
        return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))
        )

    return let(tokens, chunks)
