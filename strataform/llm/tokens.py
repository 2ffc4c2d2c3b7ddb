"""Word and token boundaries by code point class, vectorised over whole batches.

A token is a longest run of letters, digits and underscores, or a longest run of
other non-blank characters; a word is a longest run of letters.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK, WORD, OTHER = 0, 1, 2

#: The same definition for the JVM side.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]+"


def token_count(text: Column) -> Column:
    """Tokens of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


@functools.lru_cache(1)
def token_classes() -> np.ndarray:
    """Class of every code point: blank, word character or other."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        char = chr(cp)
        if char.isspace():
            classes[cp] = BLANK
        elif char == "_" or unicodedata.category(char)[0] in "LN":
            classes[cp] = WORD
    return classes


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(cp).isalpha() for cp in range(0x110000)), bool, 0x110000)


def portions(texts: list[str], characters: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about so many characters, each with the place of its first.

    Keeps the arrays over a batch small; a longer text makes a run of its own.
    """
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > characters:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def token_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets at which the tokens of a text start and end."""
    kinds = token_classes()[code_points(text)]
    if not kinds.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    starts = np.concatenate(([0], change))
    ends = np.concatenate((change, [kinds.size]))
    real = kinds[starts] != BLANK
    return starts[real], ends[real]
