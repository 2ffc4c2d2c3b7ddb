"""Per-document text statistics, and prose told apart from lists, tables and junk.

A text is cut into segments: runs of lines alike in shape between blank lines.
Each segment gets statistics (share of common words, letters, digits, symbols,
word length, sentence ends ...).  A Gaussian mixture is fitted by expectation
maximisation to the standardized statistics of all segments of all documents;
its components are mapped to prose, list, table or junk by the inspected
examples that fall to them.  A document's composition is the share of its
characters in segments of each kind.

All statistics are array operations over a batch of documents; each iteration of
the fit is one pass over the narrow table of statistics that returns one small
row of sums for each partition.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.llm.examples import EXAMPLES, LINKING
from strataform.llm.repetition import word_numbers
from strataform.llm.tokens import code_points, letters, portions
from strataform.runtime import store

KINDS = ("prose", "list", "table", "junk")

#: A document with less than this share of prose is not natural prose.
PROSE_SHARE = 0.5

#: The fit ends when a step adds less than this to the mean log-likelihood of a segment.
#: Variances have a least value, so the likelihood has a greatest and the fit an end.
GAIN = 0.005

#: Variances in standardized units stay above this.
LEAST_VARIANCE = 0.02

FEATURES = (
    "linking_share", "letter_share", "digit_share", "symbol_share", "separator_rate", "word_length",
    "sentence_rate", "line_length", "marked_share", "capital_share", "short_words", "vowel_share", "newline_rate", "space_rate",
)

_SEPARATORS = "|;\t»>#/\\={}<,•·[]()_"
_MARKERS = "\x01|;»>#/\\={}<•·[]*-+–—%&@~^$"
#: A bullet, number or quote mark in front of a line says how it is set, not what it is.
_ENUMERATOR = re.compile(r"^[ \t]*(?:>+|\(?\d{1,4}[.)]|\[[ xX]?\]|[-*•·–—])[ \t]+", re.M)
_VOWELS = "aeiouyáàâãäåæéèêëíìîïóòôõöøœúùûüAEIOUYÁÀÂÃÄÅÆÉÈÊËÍÌÎÏÓÒÔÕÖØŒÚÙÛÜ"
_ENDS = ".!?…。！？"
_CLOSERS = "\"'”“»«’)]"


@functools.lru_cache(1)
def _tables() -> dict[str, np.ndarray]:
    """For each class of characters whether a code point belongs to it."""

    def of(chars: str) -> np.ndarray:
        out = np.zeros(0x110000, bool)
        out[[ord(c) for c in chars]] = True
        return out

    def where(test) -> np.ndarray:  # the classes below lie in the lower planes, apart from letters
        out = np.zeros(0x110000, bool)
        out[:0x3000] = [test(chr(c)) for c in range(0x3000)]
        return out

    space, digit = where(str.isspace), where(str.isdigit)
    plain = of(".,'’‘\"“”„«»!?¿¡:()…-–—")
    return {
        "letter": letters(), "space": space, "digit": digit, "upper": where(str.isupper), "vowel": of(_VOWELS), "separator": of(_SEPARATORS),
        "marker": of(_MARKERS), "end": of(_ENDS), "closer": of(_CLOSERS), "symbol": ~(letters() | space | digit | plain | of("\x01")),
    }


@functools.lru_cache(1)
def _linking_hashes() -> np.ndarray:
    return np.unique(word_numbers([" ".join(LINKING)])[0])


def segments(texts: list[str]) -> dict[str, np.ndarray]:
    """Segments of a batch of texts: the text each lies in, its characters and its features.

    A segment is a run of non-blank lines without a blank one between, all of
    them marked (they open with a bullet or other mark, or have separators in
    them) or all of them not.
    """
    t = _tables()
    texts = [_ENUMERATOR.sub("\x01 ", x.replace("\r\n", "\n").replace("\r", "\n")) for x in texts]
    joined = code_points("\n\n".join(texts) + "\n")
    lengths = np.array([len(x) for x in texts], np.int64)
    text_starts = np.concatenate(([0], np.cumsum(lengths + 2)[:-1]))
    newline = np.flatnonzero(joined == 10)
    starts = np.concatenate(([0], newline[:-1] + 1))
    visible = ~t["space"][joined]
    cumulative = {k: np.concatenate(([0], np.cumsum(t[k][joined], dtype=np.int64))) for k in ("letter", "digit", "upper", "vowel", "separator", "symbol", "space")}
    count = lambda k, a, b: cumulative[k][b] - cumulative[k][a]
    seen = np.concatenate(([0], np.cumsum(visible, dtype=np.int64)))
    filled = seen[newline] > seen[starts]
    starts, ends = starts[filled], newline[filled]
    if not starts.size:
        return {"text": np.zeros(0, np.int64), "chars": np.zeros(0, np.int64), "features": np.zeros((0, len(FEATURES)), np.float32)}
    at = np.flatnonzero(visible)
    first, last = at[seen[starts]], at[seen[ends] - 1]
    # A line that ends with closing quotes ends as the character before them does.
    before = np.where(t["closer"][joined[last]] & (last > first), last - 1, last)
    ended = t["end"][joined[last]] | t["end"][joined[before]]
    size = last - first + 1
    separators = count("separator", first, last + 1)
    gaps = _wide_gaps(joined, starts, ends)
    marked = t["marker"][joined[first]] | (separators * 16 >= size) | (gaps > 0) | (count("digit", first, last + 1) * 6 >= size)
    # Lines of one text without a blank line between.
    text_of = np.searchsorted(text_starts, starts, "right") - 1
    index = np.flatnonzero(filled)
    new = np.concatenate(([True], (index[1:] != index[:-1] + 1) | (text_of[1:] != text_of[:-1]) | (marked[1:] != marked[:-1])))
    heads = np.flatnonzero(new)
    tails = np.concatenate((heads[1:], [starts.size])) - 1
    lines = tails - heads + 1
    a, b = first[heads], last[tails] + 1
    chars = seen[b] - seen[a]
    words, _ = word_numbers([joined.tobytes().decode("utf-32-le", "surrogatepass")])
    edge = np.flatnonzero(np.diff(np.concatenate(([False], t["letter"][joined], [False])).astype(np.int8)))
    word_at, word_end = edge[::2], edge[1::2]
    linking = np.concatenate(([0], np.cumsum(np.isin(words, _linking_hashes()), dtype=np.int64)))
    short = np.concatenate(([0], np.cumsum(word_end - word_at == 1, dtype=np.int64)))
    capital = np.concatenate(([0], np.cumsum(t["upper"][joined[word_at]], dtype=np.int64)))
    lo, hi = np.searchsorted(word_at, a), np.searchsorted(word_at, b)
    n_words = hi - lo
    stop = t["end"][joined] & np.concatenate((t["space"][joined[1:]] | t["closer"][joined[1:]], [True]))
    stops = np.concatenate(([0], np.cumsum(stop, dtype=np.int64)))
    marks = np.add.reduceat(marked.astype(np.int64), heads)
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    letter = count("letter", a, b)
    breaks = lines - 1
    features = np.stack([
        np.sqrt((linking[hi] - linking[lo]) / w),
        letter / c,
        np.sqrt(count("digit", a, b) / c),
        np.sqrt(count("symbol", a, b) / c),
        np.sqrt(np.minimum(2.0, count("separator", a, b) / w)),
        np.log(np.minimum(30.0, np.maximum(1, letter) / w)),
        np.sqrt(np.minimum(1.0, (stops[b] - stops[a]) / w)),
        np.log(np.minimum(400.0, c / lines)),
        marks / lines,
        (capital[hi] - capital[lo]) / w,
        np.sqrt((short[hi] - short[lo]) / w),
        count("vowel", a, b) / np.maximum(letter, 1),
        np.sqrt(breaks / w),
        np.minimum(1.0, (count("space", a, b) - breaks) / c),
    ], axis=1).astype(np.float32)
    plain = {"words": n_words, "letters": letter, "symbols": count("symbol", a, b), "lines": lines, "ended": np.add.reduceat(ended.astype(np.int64), heads), "linking": linking[hi] - linking[lo]}
    return {"text": text_of[heads], "chars": chars, "features": features} | plain


def _wide_gaps(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Gaps of three blanks or a tab within each line."""
    blank = joined == 32
    gap = blank.copy()
    gap[1:] &= blank[:-1]
    gap[2:] &= blank[:-2]
    gap[:2] = False
    follows = np.concatenate((gap[:-1] & (joined[1:] > 32), [False]))
    total = np.concatenate(([0], np.cumsum(follows | (joined == 9), dtype=np.int64)))
    return total[ends] - total[starts]


COUNTS = ("words", "letters", "symbols", "lines", "ended", "linking")
SEGMENTS = "doc_id long, chars long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<float>"


def segment_table(documents: DataFrame) -> DataFrame:
    """One row for each segment of the texts of ``documents(doc_id, text)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, texts in portions(batch.column(1).to_pylist()):
                found = segments(texts)
                if not found["text"].size:
                    continue
                flat = pa.array(found["features"].ravel())
                offsets = pa.array(np.arange(0, len(flat) + 1, len(FEATURES)).astype(np.int32))
                columns = [pa.array(ids[start + found["text"]]), pa.array(found["chars"]), *(pa.array(found[c].astype(np.int64)) for c in COUNTS), pa.ListArray.from_arrays(offsets, flat)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "chars", *COUNTS, "features"])

    return documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(cut, SEGMENTS)


class Mixture:
    """A Gaussian mixture with diagonal covariances over standardized features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, means: np.ndarray, variances: np.ndarray):
        self.centre, self.scale, self.weights, self.means, self.variances = centre, scale, weights, means, variances
        self.gains: list[float] = []  # of each step of the fit

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """Log density times weight of each standardized row for each component."""
        inverse = 1 / self.variances
        square = (x * x) @ inverse.T - 2 * x @ (self.means * inverse).T + (self.means**2 * inverse).sum(1)
        return np.log(self.weights + 1e-12) - 0.5 * (square + np.log(2 * np.pi * self.variances).sum(1))

    def standardized(self, features: np.ndarray) -> np.ndarray:
        return (features - self.centre) / self.scale

    def responsibilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joint = self.log_joint(x)
        top = joint.max(1, keepdims=True)
        r = np.exp(joint - top)
        total = r.sum(1, keepdims=True)
        return r / total, (top + np.log(total))[:, 0]


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(np.float64)


def _sums(table: DataFrame, of) -> np.ndarray:
    """The sum of ``of(features)`` over all rows, one small row for each partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch, 0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = table.select("features").mapInArrow(add, "s array<double>")
    # Partitions are many on a large table, so their rows are added on the executors.
    width = F.posexplode("s").alias("at", "x")
    return np.array([r.x for r in rows.select(width).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()])


@functools.lru_cache(1)
def example_segments() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, kind and group of the segments of the inspected examples."""
    found = segments([text for _, _, text in EXAMPLES])
    groups = sorted({g for _, g, _ in EXAMPLES})
    kind = np.array([KINDS.index(k) for k, _, _ in EXAMPLES])[found["text"]]
    group = np.array([groups.index(g) for _, g, _ in EXAMPLES])[found["text"]]
    return found["features"].astype(np.float64), kind, group


def fit(table: DataFrame, gain: float = GAIN) -> Mixture | None:
    """Fit the mixture to all segments until a step gains less than ``gain``; None for an empty table.

    Components start at the groups of the inspected examples, so the fit is the
    same for the same rows in any order, up to rounding.
    """
    d = len(FEATURES)
    sums = _sums(table, lambda x: np.concatenate(([len(x)], x.sum(0), (x * x).sum(0))))
    if not sums.size:
        return None
    n, centre = sums[0], sums[1 : d + 1] / sums[0]
    scale = np.sqrt(np.maximum(sums[d + 1 :] / n - centre**2, 1e-4))
    features, _, group = example_segments()
    x = (features - centre) / scale
    k = group.max() + 1
    means = np.stack([x[group == g].mean(0) for g in range(k)])
    mixture = Mixture(centre, scale, np.full(k, 1 / k), means, np.full((k, d), 0.3))
    before, gains = -np.inf, []
    while not gains or gains[-1] >= gain:

        def step(raw: np.ndarray, m: Mixture = mixture) -> np.ndarray:
            z = m.standardized(raw)
            r, log_density = m.responsibilities(z)
            return np.concatenate(([log_density.sum()], r.sum(0), (r.T @ z).ravel(), (r.T @ (z * z)).ravel()))

        total = _sums(table, step)
        likelihood, mass = total[0] / n, total[1 : k + 1]
        # A prior of a few rows at the examples keeps an empty component in place.
        prior = 3.0
        mean = (total[k + 1 : k + 1 + k * d].reshape(k, d) + prior * means) / (mass + prior)[:, None]
        square = (total[k + 1 + k * d :].reshape(k, d) + prior * (means**2 + 0.3)) / (mass + prior)[:, None]
        mixture = Mixture(centre, scale, (mass + prior) / (mass + prior).sum(), mean, np.maximum(square - mean**2, LEAST_VARIANCE))
        gains.append(float(likelihood - before))
        before = likelihood
    mixture.gains = gains
    return mixture


def component_kinds(mixture: Mixture) -> np.ndarray:
    """The kind of each component: that of the examples that fall to it."""
    features, kind, group = example_segments()
    r, _ = mixture.responsibilities(mixture.standardized(features))
    votes = np.stack([r[kind == k].sum(0) / max(1, (kind == k).sum()) for k in range(len(KINDS))], axis=1)
    # A component without votes keeps the kind of the group it started from.
    own = np.array([np.bincount(kind[group == g], minlength=len(KINDS)).argmax() for g in range(group.max() + 1)])
    return np.where(votes.max(1) > 1e-3, votes.argmax(1), own)


def composition(documents: DataFrame) -> DataFrame:
    """Statistics and composition of every document with an id.

    ``text_metrics`` columns: chars (non-blank), words, lines, mean word length,
    symbol ratio, share of lines that end a sentence, share of common words.
    ``content_composition`` columns: shares of characters in prose, list, table
    and junk.  Null and blank texts have zeros and the kind ``blank``.  Rows with
    the same id count as one document.
    """
    table = store(segment_table(documents), "segments").df
    mixture = fit(table)
    kinds = component_kinds(mixture) if mixture else None
    shares = ", ".join(f"{k}_chars double" for k in KINDS)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r, _ = mixture.responsibilities(mixture.standardized(_matrix(batch, batch.num_columns - 1)))
            chars = batch.column(1).to_numpy(zero_copy_only=False)
            by_kind = [pa.array(r[:, kinds == k].sum(1) * chars) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *by_kind], names=["doc_id", "chars", *COUNTS, *(f"{k}_chars" for k in KINDS)])

    names = ["chars", *COUNTS, *(f"{k}_chars" for k in KINDS)]
    if mixture is None:
        sums = table.select("doc_id", "chars", *COUNTS, *[F.lit(0.0).alias(f"{k}_chars") for k in KINDS])
    else:
        sums = table.mapInArrow(assign, "doc_id long, chars long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + shares)
    sums = sums.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in names])
    everyone = documents.where("doc_id is not null").select("doc_id").distinct()
    joined = everyone.join(sums, "doc_id", "left").fillna(0, names)
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    best = F.greatest(*[f"{k}_chars" for k in KINDS])
    kind = F.when(F.col("chars") == 0, "blank")
    for k in KINDS:
        kind = kind.when(F.col(f"{k}_chars") == best, k)
    return joined.select(
        "doc_id", "chars", "words", "lines", ratio("letters", "words").alias("mean_word_length"), ratio("symbols", "chars").alias("symbol_ratio"),
        ratio("ended", "lines").alias("ended_line_share"), ratio("linking", "words").alias("common_word_share"),
        *[ratio(f"{k}_chars", "chars").alias(f"{k}_share") for k in KINDS], kind.alias("kind"),
    )
