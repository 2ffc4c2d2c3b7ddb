"""Text normalization as one projection.

Composition (NFC) has no JVM function, so only rows beyond ASCII pass through an
Arrow function; everything else is column expressions.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Normalized text kept at most, in characters; the checksum is that of the whole.
MAX_CHARACTERS = 10_000_000


@F.pandas_udf(T.StringType())
def compose(text: pd.Series) -> pd.Series:
    """Canonical composition (NFC)."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def _steps() -> list[tuple[str, object]]:
    blank = r"[\s\x1c-\x1f\x85\p{Z}&&[^\n]]+(?=\n|\z)"
    return [
        ("line_ending_normalization", lambda t: F.regexp_replace(t, r"\r\n?", "\n")),
        ("trailing_whitespace_removal", lambda t: F.regexp_replace(t, blank, "")),
        ("control_character_removal", lambda t: F.regexp_replace(t, r"[\p{C}&&[^\n\t\r]]", "")),
        ("trailing_newline", lambda t: F.when((t != "") & ~t.endswith("\n"), F.concat(t, F.lit("\n"))).otherwise(t)),
    ]


def normalize(documents: DataFrame, text: str = "text", most: int | None = MAX_CHARACTERS) -> DataFrame:
    """Add normalized_text, normalized_checksum, normalization_operations and content_changed.

    The steps run in a fixed order: composition, line ends, trailing blanks,
    control characters, final newline; those that changed the text are named.
    Null texts stay null and empty ones empty, unchanged.  ``most`` characters of
    the text are kept, all of them if None; the checksum is that of the whole.
    """
    df = documents.withColumn("_t0", F.when(F.col(text).rlike(r"[^\x00-\x7f]"), compose(F.col(text))).otherwise(F.col(text)))
    for i, (_, step) in enumerate(_steps()):
        df = df.withColumn(f"_t{i + 1}", step(F.col(f"_t{i}")))
    names = ["unicode_normalization", *[n for n, _ in _steps()]]
    stages = [F.col(text), *[F.col(f"_t{i}") for i in range(len(names))]]
    done: list[Column] = [F.when(a != b, F.lit(n)) for n, a, b in zip(names, stages[:-1], stages[1:], strict=True)]
    last = stages[-1]
    return (
        df.withColumn("normalization_operations", F.array_compact(F.array(*done)))
        .withColumn("normalized_checksum", F.sha2(last, 256))
        .withColumn("normalized_text", last if most is None else F.substring(last, 1, most))
        .withColumn("content_changed", F.size("normalization_operations") > 0)
        .drop(*[f"_t{i}" for i in range(len(names))])
    )
