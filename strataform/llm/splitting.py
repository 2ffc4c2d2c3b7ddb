"""Splitting oversized texts at natural boundaries.

A recursive hierarchy of separators (section, paragraph, sentence, word,
character) cuts a text into atoms within the limit, never going deeper than an
atom's size demands; the atoms are packed greedily into pieces, each of which
starts with the last tokens of the one before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.llm.tokens import token_count, token_spans

CHARACTER, WORD, SENTENCE, PARAGRAPH, SECTION = range(5)
LEVELS = ("character", "word", "sentence", "paragraph", "section")

PIECES = "spec_name string, doc_id long, piece_no int, token_start long, token_end long, n_tokens long, overlap_tokens long, char_start long, char_end long, boundary string, doc_tokens long, text string"

#: A heading of its own, a rule or a wide gap begins a section.
_SECTION = re.compile(r"\n[^\S\n]*(?=#{1,6}[^\S\n]|={3,}|-{3,}|\*{3,})|\n(?:[^\S\n]*\n){2,}\s*|\f\s*")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
#: The end of a sentence, or a line that begins or ends a row of a list or table.
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*\s+|\n[^\S\n]*(?=[-*•·|\[(\d])|(?<=[|;])[^\S\n]*\n\s*")


def boundary_levels(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each token the level of the boundary in front of it."""
    levels = np.zeros(starts.size, np.int8)
    levels[1:] = starts[1:] > ends[:-1]
    for pattern, level in ((_SENTENCE, SENTENCE), (_PARAGRAPH, PARAGRAPH), (_SECTION, SECTION)):
        at = np.searchsorted(starts, [m.end() for m in pattern.finditer(text)])
        at = at[(at > 0) & (at < starts.size)]
        at = at[levels[at] > CHARACTER]
        levels[at] = np.maximum(levels[at], level)
    return levels


def atom_ends(levels: np.ndarray, lo: int, hi: int, budget: int, level: int = SECTION) -> list[int]:
    """Where the atoms of tokens ``lo`` to ``hi`` end, each at most ``budget`` long."""
    if hi - lo <= budget:
        return [hi]
    if level < CHARACTER:
        return [*range(lo + 1, hi), hi]
    cuts = lo + 1 + np.flatnonzero(levels[lo + 1 : hi] >= level) if level > CHARACTER else np.arange(lo + 1, hi)
    out: list[int] = []
    for a, b in zip([lo, *cuts.tolist()], [*cuts.tolist(), hi], strict=True):
        out += atom_ends(levels, a, b, budget, level - 1)
    return out


def cut(levels: np.ndarray, most: int, overlap: int) -> list[tuple[int, int, int]]:
    """Pieces ``(start, fresh, end)``: tokens ``start`` to ``fresh`` are shared with the piece before.

    Every piece has at most ``most`` tokens and every piece but the first shares
    exactly ``overlap`` tokens (at most ``most - 1``) with the one before.
    """
    n = levels.size
    overlap = max(0, min(overlap, most - 1))
    fresh_most = most - overlap
    ends = np.asarray(atom_ends(levels, 0, n, fresh_most))
    pieces: list[tuple[int, int, int]] = []
    at = 0
    while at < n:
        start = at - overlap if pieces else 0
        limit = start + most
        end = int(ends[np.searchsorted(ends, limit, "right") - 1])
        if end <= at or (not pieces and end < overlap and end < n):
            words = np.flatnonzero(levels[at + 1 : limit + 1] >= WORD) + at + 1
            words = words[words >= max(overlap, at + 1)]
            end = min(n, int(words[-1]) if words.size else limit)
        pieces.append((start, at, end))
        at = end
    return pieces


def split_documents(documents: DataFrame, specs: list[tuple[str, int, int]], with_text: bool = True) -> DataFrame:
    """Pieces, in order, of every text with more than ``max_tokens`` tokens of a spec.

    ``specs`` are ``(name, max_tokens, overlap_tokens)``.  Texts within a limit
    are not cut and give no row; null and blank texts never do.  Concatenating
    the fresh parts of a text's pieces gives all its tokens.  The boundary names
    the level at which a piece begins.
    """
    smallest = min((most for _, most, _ in specs), default=1 << 60)
    # A text has at least as many characters as tokens.
    long = documents.select("doc_id", "text").where(F.length("text") > smallest)

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if n in ("spec_name", "boundary", "text") else pa.int32() if n == "piece_no" else pa.int64()) for n in (x.split()[0] for x in PIECES.split(", "))])
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                starts, ends = token_spans(text)
                n = starts.size
                if n <= smallest:
                    continue
                levels = boundary_levels(text, starts, ends)
                for name, most, overlap in specs:
                    if n > most:
                        for k, (a, fresh, b) in enumerate(cut(levels, most, overlap)):
                            x, y = int(starts[a]), int(ends[b - 1])
                            rows.append((name, doc_id, k, a, b, b - a, fresh - a, x, y, LEVELS[levels[fresh]] if fresh else "start", n, text[x:y] if with_text else None))
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return long.mapInArrow(cut_batches, PIECES)


def oversized(pieces: DataFrame) -> DataFrame:
    """``(spec_name, doc_id)`` of the texts that were cut."""
    return pieces.where("piece_no = 0").select("spec_name", "doc_id").distinct()


def invariants(pieces: DataFrame, specs: list[tuple[str, int, int]]) -> DataFrame:
    """``(spec_name, documents, tokens, too_long, wrong_overlaps, wrong_texts)`` of each spec; the last three are 0.

    ``tokens`` counts what each piece adds to the one before, which is every
    token of the texts cut, once.
    """
    most, overlap = (F.create_map(*[F.lit(x) for s in specs for x in (s[0], s[at])])[F.col("spec_name")] for at in (1, 2))
    wanted = F.when(F.col("piece_no") == 0, 0).otherwise(F.least(overlap, most - 1))
    return pieces.groupBy("spec_name").agg(
        F.count_if(F.col("piece_no") == 0).alias("documents"), F.sum(F.col("n_tokens") - F.col("overlap_tokens")).alias("tokens"), F.count_if(F.col("n_tokens") > most).alias("too_long"),
        F.count_if(F.col("overlap_tokens") != wanted).alias("wrong_overlaps"), F.count_if(token_count(F.col("text")) != F.col("n_tokens")).alias("wrong_texts"),
    )
