"""Detectors: flag, ratio and label columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fx
from corpusloom.functions.text import let, text_lines

_WEAK_CODE = "|".join(fx.WEAK_CODE)

# Code lines, strong set, by what a test costs. Lines arrive stripped and without line breaks.
_plain_words = [w for w in fx.CODE_KEYWORDS if not w.startswith("#")]
_hash_words = [w for w in fx.CODE_KEYWORDS if w.startswith("#")]
_W = f"[{fx.WORD_CLASS}]"

# The letters after a first one: a place of a line tries each first letter once.
_KEYWORD = "|".join(
    f"{first}(?:{'|'.join(w[1:] for w in _plain_words if w[0] == first)})" for first in sorted({w[0] for w in _plain_words})
)
# Tested where a line starts, and inside it behind a character that is part of no word.
_AT_START = "^(?:" + "|".join(
    [p[1:] for p in fx.STRONG_CODE if p.startswith("^")] + [rf"(?:{_KEYWORD})(?!{_W})"]
) + ")"
# Java's look-behind takes no character beyond U+FFFF for a letter, nor does this.
_KEYWORD_INSIDE = rf"(?:[^{fx.WORD_CLASS}]|[\x{{10000}}-\x{{10FFFF}}])(?:{_KEYWORD})(?!{_W})"
_HASH_WORD = rf"(?<={_W})(?:{'|'.join(_hash_words)})(?!{_W})"


def _is_strong_code(line: Column) -> Column:
    """Whether any pattern of the strong set, a fence marker or a keyword is found in a line."""
    tests = [F.contains(line, F.lit(m)) for m in fx.FENCE_MARKERS]
    for pattern in fx.STRONG_CODE:
        if pattern == ";$":
            tests.append(F.endswith(line, F.lit(";")))
        elif pattern == "[{}]":
            tests += [F.contains(line, F.lit("{")), F.contains(line, F.lit("}"))]
        elif "=" in pattern:
            tests.append(F.contains(line, F.lit("=")) & F.rlike(line, F.lit(pattern)))
        elif not pattern.startswith("^"):
            tests.append(F.rlike(line, F.lit(pattern)))
    tests += [F.contains(line, F.lit("#")) & F.rlike(line, F.lit(_HASH_WORD))]
    tests += [F.rlike(line, F.lit(p)) for p in (_AT_START, _KEYWORD_INSIDE)]
    return functools.reduce(Column.__or__, tests)


def has_html(col: Column) -> Column:
    return (
        F.rlike(col, F.lit(fx.TAG))
        | F.rlike(col, F.lit(fx.ENTITY))
        | F.rlike(col, F.lit(fx.SCRIPT_OPEN))
    )


def _ratio(col: Column, is_code: Callable[[Column], Column]) -> Column:
    def share(lines: Column) -> Column:
        code = F.size(F.filter(lines, is_code))
        return F.coalesce(F.try_divide(code.cast("double"), F.size(lines)), F.lit(0.0))

    return let(text_lines(col), share)


def code_fraction(col: Column) -> Column:
    """Weak pattern set: share of non-blank lines that look like code."""
    return _ratio(col, lambda line: F.rlike(line, F.lit(_WEAK_CODE)))


def code_fraction_strong(col: Column) -> Column:
    """Strong multi-language pattern set: share of non-blank lines."""
    return _ratio(col, _is_strong_code)


def is_code_document(col: Column, threshold: float = fx.CODE_HEAVY_ABOVE) -> Column:
    return code_fraction_strong(col) > F.lit(threshold)


def has_non_ascii(col: Column) -> Column:
    """Code points above U+007F take more than one byte in UTF-8."""
    return F.length(col) != F.octet_length(col)


def pii_labels(col: Column) -> Column:
    tests = zip(fx.PII_LABELS, [fx.EMAIL, fx.PHONE, fx.CARD])
    return F.array_compact(
        F.array(*[F.when(F.rlike(col, F.lit(p)), F.lit(name)) for name, p in tests])
    )


def length_ok(col: Column, low: int = fx.MIN_CHARS, high: int = fx.MAX_CHARS) -> Column:
    return F.length(col).between(low, high)


def exclusive_category(
    html: Column, code: Column, lang: Column, n_chars: Column
) -> Column:
    """One category per document from flag columns; the first match wins."""
    return (
        F.when(html, "HTML")
        .when(code > fx.CODE_HEAVY_ABOVE, "CODE_HEAVY")
        .when(lang != fx.TARGET_LANG, "NON_ENGLISH_LANG")
        .when(n_chars >= fx.MIN_CHARS, "GOOD_ENGLISH")
        .otherwise("SHORT_ENGLISH")
    )


def overlapping_categories(
    html: Column, weak_code: Column, lang: Column, n_chars: Column
) -> Column:
    """Every category that applies, as an array."""
    english, code = lang == fx.TARGET_LANG, weak_code > fx.CODE_HEAVY_ABOVE
    good = english & ~html & ~code & (n_chars >= fx.MIN_CHARS)
    return F.array_compact(
        F.array(
            F.when(~english, F.lit("NON_ENGLISH")),
            F.when(html, F.lit("HTML")),
            F.when(code, F.lit("CODE_HEAVY")),
            F.when(good, F.lit("GOOD_ENGLISH")),
        )
    )
