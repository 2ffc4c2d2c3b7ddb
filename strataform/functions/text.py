"""Column builders for text, Unicode-aware and evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks of every kind, inside a character class.
BLANK = r"\s\x1c-\x1f\x85\p{Z}"
#: What ends a line.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
#: Digits of every script and raised, lowered digits.
DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉"


def words(text: Column) -> Column:
    """The words of a text: longest runs of non-blank characters."""
    return F.regexp_extract_all(text, F.lit(f"[^{BLANK}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANK}]+")).cast("long")


def lines(text: Column) -> Column:
    """The lines of a text; a line end at the very end begins no further line."""
    parts = F.split(text, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def count_of(text: Column, characters: str) -> Column:
    """Characters of a text that lie in a character class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def ratio(part: Column, whole: Column) -> Column:
    """A ratio rounded to four places, half up; 0 of nothing is 0."""
    return F.when(whole > 0, F.floor(part / whole * 10000 + 0.5) / 10000).otherwise(F.lit(0.0))


def two_places(number: Column) -> Column:
    """A number as text with two places, rounded half up."""
    return F.format_string("%.2f", F.floor(number * 100 + 0.5) / 100)


def flattened(text: Column) -> Column:
    """A text in lower case with blanks collapsed."""
    return F.lower(F.trim(F.regexp_replace(text, f"[{BLANK}]+", " ")))


def character_ngrams(text: Column, n: int) -> Column:
    """Distinct character n-grams of a text in lower case with blanks collapsed; none below n characters."""
    grams = F.regexp_extract_all(flattened(text), F.lit(f"(?s)(?=({'.' * n}))."), F.lit(1))
    return F.when(F.length(text) >= n, F.array_distinct(F.filter(grams, lambda g: g != ""))).otherwise(F.array().cast("array<string>"))
