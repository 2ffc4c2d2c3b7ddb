"""Language by letter-pair profiles.

A text's pairs of neighbouring letters (other characters are skipped, so pairs
cross word ends) are compared with each language's profile by cosine.  The
profiles are a parameter: a few dozen pairs with weights for each language.  The
default ones follow a rule, the most frequent pairs of the texts labelled with
that language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.runtime import store, trimmed

#: Languages in the order in which ties go.
NAMES = {"en": "English", "es": "Spanish", "fr": "French", "de": "German", "pt": "Portuguese", "it": "Italian", "nl": "Dutch"}
#: Pairs of a profile.
PROFILE_PAIRS = 40
HIGH, MEDIUM = 0.5, 0.15

Profiles = dict[str, dict[str, float]]


def label_code(label: Column) -> Column:
    """The code of a label given as a code, a region form of it or an English name, whatever its case; null for others."""
    flat = F.lower(trimmed(label))
    names = F.create_map(*[F.lit(x) for code, name in NAMES.items() for x in (name.lower(), code)])
    coded = F.nullif(F.regexp_extract(flat, f"^({'|'.join(NAMES)})(?:[-_].*)?$", 1), F.lit(""))
    return F.coalesce(F.try_element_at(names, flat), coded)


def pair_counts(documents: DataFrame, by: str, text: str = "text") -> DataFrame:
    """``(by, pair, n)``: letter pairs counted for each value of a column."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}]+", "")
    pairs = F.explode(F.regexp_extract_all(letters, F.lit(r"(?s)(?=(..))."), F.lit(1)))
    return documents.select(F.col(by).alias("by"), pairs.alias("pair")).where("pair <> ''").groupBy("by", "pair").agg(F.count("*").alias("n"))


def learn_profiles(documents: DataFrame, label: str = "lang", text: str = "text") -> Profiles:
    """The profile of each language from all texts labelled with it in any form of ``label_code``.

    Weights are percentages of a language's pairs, to four places.  What is
    collected is at most ``PROFILE_PAIRS`` rows for each language.
    """
    known = documents.select(label_code(F.col(label)).alias("code"), text).where("code is not null")
    counts = store(pair_counts(known, "code", text), "pairs")
    total = {r.by: r.total for r in counts.df.groupBy("by").agg(F.sum("n").alias("total")).collect()}
    # A top-k for each language keeps so many rows a task, however many pairs there are.
    top = [counts.df.where(F.col("by") == code).orderBy(F.desc("n"), "pair").limit(PROFILE_PAIRS) for code in NAMES]
    out: Profiles = {code: {} for code in NAMES}
    for r in reduce(DataFrame.unionByName, top).collect():
        out[r.by][r.pair] = int(r.n * 1_000_000 // total[r.by]) / 10_000
    counts.drop()
    return {code: p for code, p in out.items() if p}


def detect(documents: DataFrame, profiles: Profiles, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, language, code, confidence)`` for each document.

    Texts with fewer than two letters are ``unknown`` in all three; the first
    language in the order of ``NAMES`` wins a tie.
    """
    codes = [c for c in NAMES if c in profiles]
    weight = {c: profiles[c] for c in codes}
    norm = np.array([np.sqrt(sum(w * w for w in weight[c].values())) for c in codes])
    table: dict[str, np.ndarray] = {}
    for i, c in enumerate(codes):
        for pair, w in weight[c].items():
            table.setdefault(pair, np.zeros(len(codes)))[i] = w
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {p: k for k, p in enumerate(table)}
        weights = np.stack(list(table.values())) if table else np.zeros((0, 0))
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                letters = "".join(filter(str.isalpha, (t or "").lower()))
                if len(letters) < 2 or not codes:
                    out.append(("unknown", "unknown", "unknown"))
                    continue
                point = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                pairs, n = np.unique(point[:-1] << np.uint64(32) | point[1:], return_counts=True)
                at = [known.get(chr(int(p) >> 32) + chr(int(p) & 0xFFFFFFFF), -1) for p in pairs]
                hit = np.array([k >= 0 for k in at])
                dot = n[hit] @ weights[[k for k in at if k >= 0]] if hit.any() else np.zeros(len(codes))
                score = dot / (np.sqrt((n.astype(np.float64) ** 2).sum()) * norm)
                best = int(score.argmax())
                out.append((NAMES[codes[best]], codes[best], "high" if score[best] >= HIGH else "medium" if score[best] >= MEDIUM else "low"))
            columns = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), pa.string()) for c in columns)], names=[key, "language", "code", "confidence"])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, language string, code string, confidence string")
