"""Text expressions (Column -> Column), all native."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, and letters, digits, underscore. Java's
# short classes are ASCII only, so the classes are written out.
SPACE = r"\x09-\x0d\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"


def normalise(text: Column) -> Column:
    """Lower case without punctuation; Unicode letters, digits and spaces stay."""
    return F.regexp_replace(F.lower(text), f"[^{WORD}{SPACE}]", "")


def normalise_ascii(text: Column) -> Column:
    """Keep ASCII letters, digits and white space only, then lower-case."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z0-9\s]", ""))


def pieces(text: Column) -> Column:
    """Split on ASCII white space; padded or blank text yields empty words."""
    return F.split(text, r"\s+")


def spaced(text: Column) -> Column:
    """Split on Unicode white space. Edge pieces may be empty; drop them after
    exploding, which keeps the expression free of a lambda."""
    return F.split(text, f"[{SPACE}]+")


def word_runs(text: Column) -> Column:
    """Lower-cased runs of word characters; edge pieces may be empty."""
    return F.split(F.lower(text), f"[^{WORD}]+")


def word_count(text: Column) -> Column:
    """Number of white-space separated words (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0))


def letter_total(text: Column) -> Column:
    """Summed length of all words."""
    return F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))


def mean_word_length(text: Column) -> Column:
    """Average word length, 0 where there is no word."""
    return F.coalesce(F.try_divide(letter_total(text), word_count(text)), F.lit(0.0))


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    if not part:
        raise ValueError("part must not be empty")
    without = F.replace(text, F.lit(part), F.lit(""))
    return ((F.length(text) - F.length(without)) / len(part)).cast("int")


def mentions(text: Column, parts: Sequence[str]) -> Column:
    """Occurrences of each literal in the lower-cased text, added up. Literals
    may contain each other; a longer one then counts for both."""
    folded = F.lower(text)
    return reduce(lambda a, b: a + b, (occurrences(folded, p) for p in parts))


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def joined(parts: Column) -> Column:
    """Array of strings as one text."""
    return F.concat_ws(" ", parts)


def json_quoted(text: Column) -> Column:
    """One string as a JSON literal."""
    row = F.to_json(F.array(text))
    return F.substring(row, F.lit(2), F.length(row) - 2)
