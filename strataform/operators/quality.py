"""Quality signals of documents, evaluated row by row in the JVM."""

from __future__ import annotations

import csv
import io
import json
import math
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataform.functions.text import BLANK, DIGIT, count_of, lines, ratio, word_count, words

#: Documents shorter than this many characters are short.
SHORT_CHARACTERS = 50
#: Limits beyond which repetition is suspicious.
REPEATED_LIMIT, DIVERSITY_LIMIT = 0.5, 0.3
#: Characters for the full score.
FULL_SCORE = 1000


def text_metrics(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add counts and lengths of characters, words and lines; all zero for null and empty texts."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = documents.withColumn("_lengths", F.transform(lines(t), F.length)).withColumn("_words", word_count(t))
    visible = F.length(F.regexp_replace(t, f"[{BLANK}]+", ""))
    n = F.size("_lengths")
    total = F.aggregate("_lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    return (
        df.withColumn("character_count", F.length(t).cast("long"))
        .withColumn("word_count", F.col("_words"))
        .withColumn("line_count", n.cast("long"))
        .withColumn("estimated_token_count", F.greatest(F.col("_words"), F.floor(F.length(t) / 4)))
        .withColumn("avg_word_length", F.when(F.col("_words") > 0, visible / F.col("_words")).otherwise(0.0))
        .withColumn("avg_line_length", F.when(n > 0, total / n).otherwise(0.0))
        .withColumn("min_line_length", F.coalesce(F.array_min("_lengths"), F.lit(0)).cast("long"))
        .withColumn("max_line_length", F.coalesce(F.array_max("_lengths"), F.lit(0)).cast("long"))
        .drop("_lengths", "_words")
    )


def content_composition(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the shares of letters, digits, blanks, punctuation, symbols and distinct characters, to four places."""
    t = F.coalesce(F.col(text), F.lit(""))
    whole = F.length(t)
    out = documents
    for name, characters in (("alphabetic", r"\p{L}"), ("numeric", DIGIT), ("whitespace", BLANK), ("punctuation", r"\p{P}"), ("symbol", r"\p{S}")):
        out = out.withColumn(f"{name}_ratio", ratio(count_of(t, characters), whole))
    distinct = F.size(F.array_distinct(F.filter(F.split(t, ""), lambda c: c != "")))
    return out.withColumn("unique_char_ratio", ratio(distinct, whole))


def _repeats(sorted_items: str) -> tuple[Column, Column, Column]:
    """Distinct items, items that occur more than once and the longest run, of a sorted array column."""
    a = F.col(sorted_items)
    item = lambda i: F.try_element_at(a, i)
    begins = F.filter(a, lambda x, i: (i == 0) | (item(i) != x))
    again = F.filter(a, lambda x, i: (i > 0) & (item(i) == x) & ((i == 1) | (item(i - 1) != x)))
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"] == x, s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.size(begins), F.size(again), F.aggregate(a, start, step)["best"]


def repetition_signals(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the shares of repeated lines and word pairs, vocabulary diversity and whether repetition is suspicious.

    Lines compare without outer blanks, blank ones do not count; words compare
    exactly.  Texts without any have shares of 0 and are not suspicious.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    stripped = F.transform(lines(t), lambda x: F.regexp_replace(x, f"^[{BLANK}]+|[{BLANK}]+$", ""))
    df = documents.withColumn("_w", words(t)).withColumn("_lines", F.array_sort(F.filter(stripped, lambda x: x != "")))
    pairs = F.transform(F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.try_element_at("_w", i + 2)))
    df = df.withColumn("_pairs", F.array_sort(pairs))
    kinds, twice, longest = _repeats("_lines")
    pair_kinds, pair_twice, _ = _repeats("_pairs")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    n = F.size("_w")
    df = (
        df.withColumn("distinct_lines", kinds.cast("long")).withColumn("repeated_lines", twice.cast("long")).withColumn("max_line_repetition", longest.cast("long"))
        .withColumn("distinct_phrases", pair_kinds.cast("long")).withColumn("repeated_phrases", pair_twice.cast("long"))
        .withColumn("distinct_words", F.size(F.array_distinct("_w")).cast("long")).withColumn("total_words", n.cast("long"))
    )
    line_share, phrase_share = share(F.col("repeated_lines"), F.col("distinct_lines")), share(F.col("repeated_phrases"), F.col("distinct_phrases"))
    diversity = share(F.col("distinct_words"), F.col("total_words"))
    suspicious = (line_share > REPEATED_LIMIT) | (phrase_share > REPEATED_LIMIT) | ((F.col("total_words") > 0) & (diversity < DIVERSITY_LIMIT))
    return df.withColumn("repeated_line_ratio", line_share).withColumn("repeated_phrase_ratio", phrase_share).withColumn("vocabulary_diversity", diversity).withColumn("suspicious_repetition", suspicious).drop("_w", "_lines", "_pairs")


def completeness_signals(documents: DataFrame, text: str = "text", warnings: str | None = None) -> DataFrame:
    """Add whether a text is empty or short and whether inherited warnings tell of truncation or bad form."""
    t = F.coalesce(F.col(text), F.lit(""))
    said = F.coalesce(F.col(warnings), F.array().cast("array<string>")) if warnings else F.array().cast("array<string>")
    tells = lambda *parts: F.exists(said, lambda w: F.lower(w).rlike("|".join(parts)))
    bare = F.regexp_replace(t, f"[{BLANK}]+", "")
    return (
        documents.withColumn("is_empty", bare == "").withColumn("is_short", (bare != "") & (F.length(t) < SHORT_CHARACTERS))
        .withColumn("truncation_suspected", F.coalesce(tells("truncat"), F.lit(False))).withColumn("malformed_suspected", F.coalesce(tells("malformed", "invalid", "corrupt"), F.lit(False)))
    )


def quality_score(character_count: Column) -> Column:
    """Characters by a thousand, at most 1; 0 where the count is missing."""
    return F.least(F.coalesce(character_count, F.lit(0)) / FULL_SCORE, F.lit(1.0))


SIGNALS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("items", "nulls", "empty")] + [T.StructField(n, T.LongType()) for n in ("columns", "rows")] + [T.StructField("null_ratio", T.DoubleType()), T.StructField("empty_ratio", T.DoubleType()), T.StructField("root", T.StringType()), T.StructField("has_attributes", T.BooleanType())]
)


def _ratio(part: int, whole: int) -> float:
    return math.floor(part / whole * 10000 + 0.5) / 10000 if whole else 0.0


def _json_signals(text: str) -> dict:
    data = json.loads(text)
    if isinstance(data, list):
        return {"items": len(data)}
    values = list(data.values()) if isinstance(data, dict) else []
    nulls, empty = sum(v is None for v in values), sum(isinstance(v, str) and not v for v in values)
    return {"items": len(values), "nulls": nulls, "empty": empty, "null_ratio": _ratio(nulls, len(values)), "empty_ratio": _ratio(empty, len(values))}


def _csv_signals(text: str) -> dict:
    header, *body = list(csv.reader(io.StringIO(text))) or [[]]
    cells, empty = len(body) * len(header), sum(not c.strip() for row in body for c in row)
    return {"items": cells, "empty": empty, "columns": len(header), "rows": len(body), "empty_ratio": _ratio(empty, cells)}


def _xml_signals(text: str) -> dict:
    root = ET.fromstring(text)
    bare = sum(not (child.text or "").strip() for child in root)
    return {"items": len(root), "empty": bare, "empty_ratio": _ratio(bare, len(root)), "root": root.tag, "has_attributes": bool(root.attrib)}


_READ = {"json": _json_signals, "csv": _csv_signals, "xml": _xml_signals}


@F.pandas_udf(SIGNALS)
def format_signals(fmt: pd.Series, text: pd.Series) -> pd.DataFrame:
    """Signals of structured text by its format.

    JSON: fields of an object with the null and the empty ones, items of a list.
    CSV: columns, rows and cells of the body with the empty ones.  XML: the root,
    whether it has attributes, and its children with those without text.  Other
    formats and text that cannot be read have nulls throughout.
    """

    def one(kind: str | None, t: str | None) -> dict:
        try:
            return _READ[kind](t or "") if kind in _READ else {}
        except (ValueError, ET.ParseError, csv.Error, RecursionError):
            return {}

    rows = [one(k, t) for k, t in zip(fmt, text, strict=True)]
    return pd.DataFrame({f.name: pd.array([r.get(f.name) for r in rows], {"bigint": "Int64", "double": "Float64", "boolean": "boolean"}.get(f.dataType.simpleString(), "object")) for f in SIGNALS.fields})


def html_signals(extracted: DataFrame, raw_characters: str = "raw_characters") -> DataFrame:
    """Add the share of a page's characters that are text, and its links for each hundred words."""
    n, links = F.length("canonical_text"), F.get_json_object("structure", "$.link_count").cast("long")
    words_ = word_count(F.col("canonical_text"))
    return extracted.withColumn("extracted_ratio", ratio(n, F.col(raw_characters))).withColumn("link_density", ratio(links, words_))
