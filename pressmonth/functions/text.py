"""Text normalisation as Column expressions.

Everything here stays inside the JVM.  The Unicode folds are exact for every code point: the folding
tables are derived from ``unicodedata`` on the driver and applied per *distinct* character of a text, so
an ASCII text pays one length comparison and a Spanish one a handful of byte replacements.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the article cleaner defines it (Unicode whitespace plus the four ASCII separators).
WHITESPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_HANGUL = range(0xAC00, 0xD7A4)
# Blocks whose characters fold to themselves, and surrogates: skipped while building the tables.
_IDENTITY_BLOCKS = (
    range(0x3400, 0xA000), _HANGUL, range(0xD800, 0xF900),
    range(0x20000, 0x2F800), range(0x2FA20, 0x110000),
)


def _fold_analysis(char: str) -> str:
    decomposed = unicodedata.normalize("NFKD", char.casefold())
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def _fold_query(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", char) if not "̀" <= c <= "ͯ")


_FOLDS = {"analysis": _fold_analysis, "query": _fold_query}


@lru_cache(maxsize=None)
def _fold_tables(kind: str) -> tuple[str, str, str]:
    """(from, to) strings for ``translate`` and a ``str_to_map`` literal for folds to several characters."""
    fold = _FOLDS[kind]
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    start = 0x80
    for block in (*_IDENTITY_BLOCKS, range(0x110000, 0x110000)):
        for char in map(chr, range(start, block.start)):
            folded = fold(char)
            if len(folded) > 1 and all(not (c.isalnum() or c in "_-") for c in folded):
                folded = " "  # only separators: one is as good as many, they collapse later
            if folded != char:
                (several if len(folded) > 1 else single)[char] = folded
        start = block.stop
    # translate() deletes the characters of `from` that have no counterpart in `to`
    ordered = sorted(single, key=lambda c: single[c] == "")
    pairs = "\x02".join(f"{c}\x03{f}" for c, f in several.items())
    return "".join(ordered), "".join(single[c] for c in ordered), pairs


def _utf16(code: Column) -> Column:
    return F.lpad(F.hex(code), 4, "0")


def _decompose_hangul(char: Column) -> Column:
    """Arithmetic decomposition of a precomposed Korean syllable into its two or three letters."""
    index = F.ascii(char) - _HANGUL.start
    tail = index % 28
    units = F.concat(
        _utf16(F.lit(0x1100) + F.floor(index / 588)),
        _utf16(F.lit(0x1161) + F.floor((index % 588) / 28)),
        F.when(tail > 0, _utf16(F.lit(0x11A7) + tail)).otherwise(""),
    )
    return F.decode(F.unhex(units), "UTF-16BE")


def _fold_char(char: Column, kind: str) -> Column:
    source, target, several = _fold_tables(kind)
    table = F.str_to_map(F.lit(several), F.lit("\x02"), F.lit("\x03"))
    hangul = (char >= F.lit(chr(_HANGUL.start))) & (char <= F.lit(chr(_HANGUL.stop - 1)))
    one_to_one = F.translate(char, source, target)
    return (
        F.when(one_to_one != char, one_to_one)
        .when(hangul, _decompose_hangul(char))
        .otherwise(F.coalesce(F.try_element_at(table, char), char))
    )


def _fold(text: Column, kind: str) -> Column:
    lowered = F.lower(text)
    folded = F.transform(
        F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x7f]"), F.lit(0))),
        lambda c: F.struct(c.alias("c"), _fold_char(c, kind).alias("f")),
    )
    # Sorted, because the final sigma must be replaced before the letters that fold onto it.
    changed = F.array_sort(F.filter(folded, lambda p: p["c"] != p["f"]))
    replaced = F.reduce(changed, lowered, lambda acc, p: F.replace(acc, p["c"], p["f"]))
    return F.when(F.length(text) == F.octet_length(text), lowered).otherwise(replaced)


def normalize_text(text: Column) -> Column:
    """Analysis form: case folded, accents and other marks dropped, punctuation to single spaces.

    Underscores and hyphens survive; null becomes the empty string.
    """
    words = F.regexp_replace(_fold(F.coalesce(text, F.lit("")), "analysis"), r"[^\p{L}\p{N}_-]+", " ")
    return F.trim(words)


def normalize_query(text: Column) -> Column:
    """Search-box form: like :func:`normalize_text`, but canonical decomposition only.

    Only the combining block U+0300-036F is dropped, underscores become spaces and a sharp s stays.
    """
    words = F.regexp_replace(_fold(F.coalesce(text, F.lit("")), "query"), r"[^\p{L}\p{N}-]+", " ")
    return F.trim(words)


def clean_text(text: Column) -> Column:
    """Display form: trimmed, inner whitespace collapsed, null to the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE + "+", " "))


def build_document(title: Column, body: Column, max_chars: int | None = None) -> Column:
    """``title. body`` with both parts cleaned; ``max_chars`` optionally caps the body."""
    cleaned = clean_text(body)
    if max_chars is not None:
        cleaned = F.substring(cleaned, 1, max_chars)
    return F.trim(F.concat(clean_text(title), F.lit(". "), cleaned))


def count_alias(normalized_document: Column, normalized_alias: Column) -> Column:
    """Non-overlapping occurrences of a literal alias between word boundaries (a hyphen is a boundary)."""
    pattern = F.concat(F.lit(r"(?U)(?<!\w)\Q"), normalized_alias, F.lit(r"\E(?!\w)"))
    return F.regexp_count(normalized_document, pattern)


# --- twins for single strings, and for whole texts over Arrow batches ----------------------------------


class _FoldedCharacters(dict):
    """A table for ``str.translate``: what a character is in the analysis form, found out when it is first met."""

    def __missing__(self, code: int) -> str:
        self[code] = folded = "".join(c if c.isalnum() or c in "_-" else " " for c in _fold_analysis(chr(code)))
        return folded


_FOLDED = _FoldedCharacters()
STRINGS = 256  # texts of a batch that are decoded together


def fold_label(value: str | None) -> str:
    """:func:`normalize_text` for one string."""
    return " ".join((value or "").translate(_FOLDED).split())


def tidy_label(value: str | None) -> str:
    """:func:`clean_text` for one string."""
    return " ".join((value or "").split())


def strings(values: pa.Array) -> Iterator[str]:
    """Texts of an Arrow column, null as the empty string; only some at a time are held besides the column."""
    values = values.cast(pa.binary())
    for at in range(0, len(values), STRINGS):
        for value in values.slice(at, STRINGS).to_numpy(zero_copy_only=False):
            yield value.decode("utf-8", "replace") if value else ""


def cleaned_document(title: Column, body: Column, max_chars: int | None = None) -> Column:
    """:func:`build_document` for whole texts, over Arrow batches."""

    def build(titles: pa.Array, bodies: pa.Array) -> pa.Array:
        pairs = zip(strings(titles), strings(bodies))
        return pa.array([f"{tidy_label(t)}. {tidy_label(b)[:max_chars]}".strip(" ") for t, b in pairs], pa.string())

    return F.arrow_udf(build, "string")(title, body)


def normalized_document(document: Column) -> Column:
    """:func:`normalize_text` for whole texts, over Arrow batches."""

    def normalize(texts: pa.Array) -> pa.Array:
        return pa.array(map(fold_label, strings(texts)), pa.string())

    return F.arrow_udf(normalize, "string")(document)
