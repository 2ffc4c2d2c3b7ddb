"""Repetition inside a single document, by suffix array.

The words of a whole batch of documents are numbered, a suffix array is built by
prefix doubling with every document's suffixes kept apart, and the longest
common prefixes of neighbouring suffixes give the intervals of repeated
passages.  All steps are array operations over the batch; only suffixes not yet
told apart take part in a further round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataform.llm.tokens import code_points, letters, portions

#: Consecutive words that make a passage.
PASSAGE_WORDS = 8

#: A document with this share of its words repeated is repetitive.
COVERED_LIMIT = 0.3

#: So is one with a repeated passage of this many words.
LONGEST_LIMIT = 200

SIGNALS = "doc_id long, n_words long, repeated_words long, repeated_share double, longest_repeat long, passages long, repetitive boolean"


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, and the text each stands in.

    Words are runs of letters without regard to case.  Equal words get equal
    numbers through a 64-bit hash of their letters.
    """
    whole = texts[0] if len(texts) == 1 else "\x00".join(t.replace("\x00", " ") for t in texts)
    # The capital I with dot alone has a lower case of two code points, one of them no letter.
    joined = code_points(whole.replace("\u0130", "i").lower())
    is_letter = letters()[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_letter, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not starts.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Sum over a word of mixed letters, each mixed with its place in the word.
    place = np.arange(joined.size, dtype=np.uint64)
    length = ends - starts
    inside = np.repeat(starts, length)
    at = np.flatnonzero(is_letter)
    mixed = (joined[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (place[at] - inside.astype(np.uint64) + np.uint64(1)))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    hashed = np.add.reduceat(mixed, np.concatenate(([0], np.cumsum(length)[:-1])))
    breaks = np.flatnonzero(joined == 0) if len(texts) > 1 else np.zeros(0, np.int64)
    return hashed.view(np.int64), np.searchsorted(breaks, starts)


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and for each key the place of the first equal one."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(key.size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(key.size), 0))
    return order, rank


def suffix_ranks(words: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks of all suffixes by their first 1, 2, 4 ... words.

    A suffix ends with its document.  Suffixes that share a rank share that many
    words; rounds go on until no two suffixes of a document do.
    """
    n = words.size
    if n >= 2**31:
        raise ValueError(f"a text of {n} words has more than a suffix array of 31 bits can hold")
    _, word = _ranked(words)
    order, rank = _ranked(word + document.astype(np.int64) * n)
    levels = [rank]
    step = 1
    while True:
        counts = np.bincount(rank, minlength=n)
        active = np.flatnonzero(counts[rank] > 1)
        if not active.size:
            break
        follow = active + step
        inside = follow < n
        inside[inside] = document[follow[inside]] == document[active[inside]]
        second = np.full(active.size, -1, np.int64)
        second[inside] = rank[follow[inside]]
        by = np.lexsort((second, rank[active]))
        moved, group, next_rank = active[by], rank[active][by], second[by]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (next_rank[1:] != next_rank[:-1])))
        head = np.concatenate(([True], group[1:] != group[:-1]))
        index = np.arange(moved.size)
        group_start = np.maximum.accumulate(np.where(head, index, 0))
        sub_start = np.maximum.accumulate(np.where(fresh, index, 0))
        rank = rank.copy()
        rank[moved] = group + (sub_start - group_start)
        levels.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix of the array shares with the one before it."""
    n = order.size
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        live = np.flatnonzero((a < n) & (b < n))
        same = live[levels[k][a[live]] == levels[k][b[live]]]
        shared[1 + same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return shared


def repetition(texts: list[str], passage: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text its words, repeated words, longest repeat and repeated passages.

    A word is repeated if it lies in ``passage`` or more consecutive words that
    already stood earlier in its text.
    """
    words, document = word_numbers(texts)
    m, n = len(texts), words.size
    total = np.bincount(document, minlength=m)
    longest, covered, passages = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    if n:
        order, levels = suffix_ranks(words, document)
        shared = common_prefixes(order, levels)
        np.maximum.at(longest, document[order], shared)
        # Intervals of the array whose members share a passage: all members but
        # the first in the text repeat it.
        starts = np.flatnonzero(shared < passage)
        if starts.size < n:
            interval = np.cumsum(shared < passage) - 1
            earliest = np.minimum.reduceat(order, starts)
            later = order[order != earliest[interval]]
            step = np.zeros(n + 1, np.int64)
            np.add.at(step, later, 1)
            np.add.at(step, np.minimum(later + passage, n), -1)
            inside = np.cumsum(step[:-1]) > 0
            covered = np.bincount(document[inside], minlength=m)
            begins = inside & np.concatenate(([True], ~inside[:-1] | (document[1:] != document[:-1])))
            passages = np.bincount(document[begins], minlength=m)
    return total, covered, longest, passages


def repetition_signals(documents: DataFrame, covered_limit: float = COVERED_LIMIT, longest_limit: int = LONGEST_LIMIT) -> DataFrame:
    """One row of repetition signals for each document with an id.

    Null, blank and wordless texts have a share of 0.  Rows with the same id are
    measured each.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in portions([t or "" for t in batch.column(1).to_pylist()]):
                total, covered, longest, passages = repetition(texts)
                share = covered / np.maximum(total, 1)
                flagged = (share >= covered_limit) & (total > 0) | (longest >= longest_limit)
                columns = (total.astype(np.int64), covered.astype(np.int64), share, longest, passages.astype(np.int64), flagged)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *(pa.array(x) for x in columns)], names=[x.split()[0] for x in SIGNALS.split(", ")])

    return documents.where("doc_id is not null").select("doc_id", "text").mapInArrow(measure, SIGNALS)
