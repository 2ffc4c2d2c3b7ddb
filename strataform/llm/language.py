"""Language of documents and of the segments of mixed ones.

A bidirectional gated recurrent network over bytes labels every position of a
text; the positions of a sentence are pooled into the sentence's probabilities
and those of the sentences into the document's.  The network is trained by
``train_language`` in numpy; its weights are a small file beside this module.

The update gate is piecewise linear, so a padding byte whose gate is forced shut
leaves the state untouched and both directions run over one padded layout.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.llm.tokens import portions

#: The network's classes; the last one is text that holds no language.
LANGUAGES = ("en", "es", "fr", "de", "pt", "it", "nl")
NONE = len(LANGUAGES)

#: Bytes of a window at most; longer sentences are labelled window by window.
WINDOW = 224
#: Windows that run side by side.
LANES = 1024

#: Characters of texts that are labelled together; equal windows among them are labelled once.
PORTION = 4_000_000

#: A whole sentence ends with a mark, has this many words and this confidence.
SENTENCE_WORDS, SENTENCE_CONFIDENCE = 4, 0.7
#: Whole sentences that make a language one of a mixed document, however long it is.
MIXED_SENTENCES = 2
#: A sentence with this share of its words in the sentences of the text's leading
#: language is of that language; the network has mistaken it.
FAMILIAR = 0.6
#: Confidence at which a document's label is contradicted.
CONTRADICTION = 0.5
#: Share of a text's letters that one language must have for the text to hold it,
#: and what each digit or mark among its characters beyond a share adds: names in
#: records look like words of some language, but not of one throughout.
LANGUAGE_SHARE, FREE_MARKS, MARK_WEIGHT, MOST_MARKS = 0.22, 0.12, 0.8, 0.42
#: Letters without which a text holds no language.
LEAST_LETTERS = 4

WEIGHTS = Path(__file__).with_name("language_weights.npz")

# Usual forms of a language label; codes of two and three letters and names in English.
FORMS = {
    "en": "en eng english", "es": "es spa spanish castilian", "fr": "fr fra fre french", "de": "de deu ger german",
    "pt": "pt por portuguese", "it": "it ita italian", "nl": "nl nld dut dutch",
}
_CODES = {form: code for code, forms in FORMS.items() for form in forms.split()}


def label_code(label: str | None) -> str | None:
    """The two-letter code of a label in any usual form, or None if it is unusable."""
    if not label:
        return None
    return _CODES.get(re.split(r"[-_]", label.strip().lower())[0])


_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
#: Blanks after an end mark, or after a closing mark that follows one, with no small letter behind; or after two exclamation marks.
_STOP = re.compile(r"[ \n](?:(?<=\n)|(?:(?<=[.!?…] )|(?<=[.!?…][\"”»’)\]] ))(?![a-zà-ÿ])|(?<=!! ))")
#: The same after several closing marks, whose blank becomes a line's end.
_CLOSED = re.compile(r"([\"”»’)\]](?<=[.!?…].)[\"”»’)\]]+) (?![a-zà-ÿ])")
_ENDS = frozenset(".!?…")
_CLOSERS = "\"”»“’)] "


def sentences(text: str) -> list[tuple[str, bool]]:
    """The sentences of a text in order, each with whether it is whole.

    Lines broken within a paragraph are joined.  What lacks an end mark or has
    too few words is not whole; it is kept all the same.
    """
    out = []
    for paragraph in _PARAGRAPH.split(text.replace("\r", "")):
        flat = " ".join(paragraph.split())
        if flat:
            out += [(p, p.count(" ") >= SENTENCE_WORDS - 1 and p.rstrip(_CLOSERS)[-1:] in _ENDS) for p in _STOP.split(_CLOSED.sub(r"\1\n", flat)) if p]
    return out


_OTHER = re.compile(r"(?:[^\w'’ ]|[\d_])+")


def words_of(piece: str) -> str:
    """The words of a piece: letters in lower case and apostrophes, with single blanks.

    Digits, marks and symbols say how a text is set, not its language.
    """
    return " ".join(_OTHER.sub(" ", piece.lower()).split())


def spell(piece: str) -> bytes:
    """The words of a piece as bytes, as the network reads them."""
    return words_of(piece).encode("utf-8", "replace")


def windows(data: bytes) -> list[bytes]:
    """A sentence's bytes in windows, cut at blanks where there are any."""
    if len(data) <= WINDOW:
        return [data] if data else []
    out = []
    while len(data) > WINDOW:
        cut = data.rfind(b" ", WINDOW // 2, WINDOW)
        if cut < 0:
            cut = WINDOW
            while cut > WINDOW - 4 and data[cut] & 0xC0 == 0x80:
                cut -= 1
        out.append(data[:cut])
        data = data[cut:].lstrip(b" ")
    if data:
        out.append(data)
    return out


PAD = 256
#: Bytes of letters: a to z, and all beyond ASCII.
_LETTER = np.zeros(PAD + 1, np.float32)
_LETTER[ord("a") : ord("z") + 1] = 1
_LETTER[128:PAD] = 1


class Network:
    """The bidirectional gated recurrent network, for labelling."""

    def __init__(self, weights: dict[str, np.ndarray]):
        f = np.float32
        n, width = weights["forward_u"].shape[1], weights["embedding"].shape[1]
        self.size = n
        # A symbol's column: its embedding, a one for the biases and a one if it is padding.
        self.symbols = np.zeros((width + 2, PAD + 1), f)
        self.symbols[:width, :PAD] = weights["embedding"].T
        self.symbols[width] = 1
        self.symbols[width + 1, PAD] = 1
        self.gates, self.fresh, self.recurrent = [], [], []
        for side in ("forward", "backward"):
            read = np.hstack([weights[f"{side}_w"], weights[f"{side}_b"][:, None], np.zeros((3 * n, 1))])
            read[n : 2 * n, -1] = -1e6  # padding shuts the update gate
            self.gates.append(np.ascontiguousarray(np.hstack([weights[f"{side}_u"][: 2 * n], read[: 2 * n]]).astype(f)))
            self.fresh.append(np.ascontiguousarray(read[2 * n :].astype(f)))
            self.recurrent.append(np.ascontiguousarray(weights[f"{side}_u"][2 * n :].astype(f)))
        self.out = np.ascontiguousarray(weights["out_w"].astype(f))
        self.bias = weights["out_b"].astype(f)[:, None]

    @staticmethod
    @functools.lru_cache(1)
    def load() -> Network:
        with np.load(WEIGHTS) as stored:
            return Network(dict(stored))

    def _states(self, side: int, symbols: np.ndarray, order: range) -> Iterator[tuple[int, np.ndarray]]:
        """The state of one direction after each position, in one array that is used again."""
        n, lanes, f = self.size, symbols.shape[1], np.float32
        both = np.zeros((n + self.symbols.shape[0], lanes), f)  # the state above the symbol's column
        h, e = both[:n], both[n:]
        gates, new, kept = np.empty((2 * n, lanes), f), np.empty((n, lanes), f), np.empty((n, lanes), f)
        zero, one = f(0), f(1)
        for t in order:
            np.take(self.symbols, symbols[t], axis=1, out=e, mode="clip")
            np.matmul(self.gates[side], both, out=gates)
            np.clip(gates, zero, one, out=gates)
            np.matmul(self.recurrent[side], h, out=kept)
            kept *= gates[:n]
            np.matmul(self.fresh[side], e, out=new)
            new += kept
            np.tanh(new, out=new)
            new -= h
            new *= gates[n:]
            h += new
            yield t, h

    def positions(self, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Class probabilities (classes, lanes) of each position, the last first.

        ``symbols`` is (positions, lanes), padded at the end with ``PAD``.
        """
        steps, lanes = symbols.shape
        n = self.size
        left, right = np.ascontiguousarray(self.out[:, :n]), np.ascontiguousarray(self.out[:, n:])
        ahead = np.empty((steps, NONE + 1, lanes), np.float32)
        for t, h in self._states(0, symbols, range(steps)):
            np.matmul(left, h, out=ahead[t])
        for t, h in self._states(1, symbols, range(steps - 1, -1, -1)):
            p = ahead[t]
            p += right @ h
            p += self.bias
            np.exp(p, out=p)  # the scores are bounded by the weights, far from overflow
            p *= 1 / p.sum(0)
            yield t, p

    def pool(self, data: list[bytes]) -> np.ndarray:
        """Mean class probabilities over the letters of each of many windows: (windows, classes)."""
        out = np.zeros((len(data), NONE + 1), np.float32)
        lengths = np.array([len(d) for d in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")
        for at in range(0, order.size, LANES):
            lanes = order[at : at + LANES]
            size = lengths[lanes]
            steps = int(size[-1])
            t = np.arange(steps)[:, None]
            inside = t < size
            symbols = np.where(inside, flat[np.minimum(starts[lanes] + t, flat.size - 1)], PAD)
            # Only letters speak for a language; a window without any is none.
            spoken = _LETTER[symbols]
            total = np.zeros((NONE + 1, lanes.size), np.float32)
            for k, p in self.positions(symbols):
                p *= spoken[k]
                total += p
            count = spoken.sum(0)
            total[NONE, count == 0] = 1
            out[lanes] = (total / np.maximum(count, 1)).T
        return out


DETECTED = "doc_id long, label string, language string, confidence double, mixed array<struct<lang:string,sentences:int,confidence:double>>"


def _mistaken(text: str, best: np.ndarray, counted: np.ndarray, lead: int) -> list[int]:
    """The counted sentences of other languages whose words are those of the leading one's sentences.

    Places count the sentences that have words.
    """
    pieces = [set(w.split()) for w in (words_of(p) for p, _ in sentences(text)) if w]
    known = set().union(*(pieces[j] for j in np.flatnonzero(counted & (best == lead))))
    return [int(j) for j in np.flatnonzero(counted & (best != lead)) if len(pieces[j] & known) >= FAMILIAR * len(pieces[j])]


def _detect(texts: list[str]) -> list[tuple[str | None, float, list[dict]]]:
    """Language, confidence and the languages of a mixed text, for each text."""
    index: dict[bytes, int] = {}  # equal windows are labelled once
    shown, doc, first, whole, letters, used = np.zeros(len(texts)), [], [], [], [], []
    for i, text in enumerate(texts):
        n_shown = 0
        for piece, complete in sentences(text):
            n_shown += len(piece) - piece.count(" ")
            words = words_of(piece)
            if words:
                doc.append(i)
                first.append(len(used))
                whole.append(complete)
                letters.append(len(words) - words.count(" "))
                used += [index.setdefault(w, len(index)) for w in windows(words.encode("utf-8", "replace"))]
        shown[i] = n_shown
    nothing: tuple[str | None, float, list[dict]] = (None, 0.0, [])
    if not used:
        return [nothing] * len(texts)
    data = list(index)
    at = np.array(used)
    size = np.array([len(d) for d in data], np.float32)[at]
    # A sentence's probabilities are those of its windows by length, a text's those of its sentences by letters.
    of_sentence = np.add.reduceat(Network.load().pool(data)[at] * size[:, None], first) / np.add.reduceat(size, first)[:, None]
    document, n = np.array(doc), np.array(letters, np.float64)
    total = np.stack([np.bincount(document, n * of_sentence[:, k], len(texts)) for k in range(NONE + 1)], axis=1)
    spelled = np.bincount(document, n, len(texts))
    best, sure = of_sentence.argmax(1), of_sentence.max(1)
    counted = np.array(whole) & (best != NONE) & (sure >= SENTENCE_CONFIDENCE)
    count, certain = np.zeros((len(texts), NONE), np.int64), np.zeros((len(texts), NONE))
    np.add.at(count, (document[counted], best[counted]), 1)
    np.add.at(certain, (document[counted], best[counted]), sure[counted])
    marks = 1 - spelled / np.maximum(1, shown)
    least = LANGUAGE_SHARE + MARK_WEIGHT * (np.clip(marks, FREE_MARKS, MOST_MARKS) - FREE_MARKS)
    holds = (spelled >= LEAST_LETTERS) & (total[:, :NONE].max(1) >= least * spelled)
    leading = total[:, :NONE].argmax(1)
    for i in np.flatnonzero(((count >= MIXED_SENTENCES).sum(1) > 1) & holds):
        mine = slice(*np.searchsorted(document, [i, i + 1]))
        for at_piece in _mistaken(texts[i], best[mine], counted[mine], count[i].argmax()):
            k = best[mine][at_piece]
            count[i, k] -= 1
            certain[i, k] -= sure[mine][at_piece]
    several = (count >= MIXED_SENTENCES) & holds[:, None]
    mixed_text = several.sum(1) > 1
    out = []
    for i in range(len(texts)):
        if not spelled[i]:
            out.append(nothing)
        elif not holds[i]:
            out.append((None, float(total[i, NONE] / spelled[i]), []))
        else:
            mixed = [{"lang": LANGUAGES[k], "sentences": int(count[i, k]), "confidence": float(certain[i, k] / count[i, k])} for k in np.flatnonzero(several[i])] if mixed_text[i] else []
            out.append((LANGUAGES[leading[i]], float(total[i, leading[i]] / spelled[i]), mixed))
    return out


def detect_language(documents: DataFrame) -> DataFrame:
    """``(doc_id, label, language, confidence, mixed)`` of every document with an id.

    ``label`` is the code of the document's own label, null if missing or
    unusable.  ``language`` is null for null and blank texts and for texts that
    hold no language; ``mixed`` lists the languages of a mixed text.  Rows with
    the same id are labelled each.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("sentences", pa.int32()), ("confidence", pa.float64())]))
        for batch in batches:
            found = [x for _, texts in portions([t or "" for t in batch.column(1).to_pylist()], PORTION) for x in _detect(texts)]
            columns = [
                batch.column(0),
                pa.array([label_code(x) for x in batch.column(2).to_pylist()], pa.string()),
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "language", "confidence", "mixed"])

    return documents.where("doc_id is not null").select("doc_id", "text", "lang").mapInArrow(label, DETECTED)


SEGMENTS = "doc_id long, segment_no int, language string, confidence double, text string"


def _segments(ids: list, texts: list[str]) -> list[tuple]:
    """The rows of ``language_segments`` for some documents."""
    out: list[tuple] = []
    pieces = [[p for p, _ in sentences(t)] for t in texts]
    data = [(i, k, w) for i, mine in enumerate(pieces) for k, p in enumerate(mine) for w in windows(spell(p))]
    pooled = Network.load().pool([w for _, _, w in data]) if data else []
    sums: dict[tuple[int, int], np.ndarray] = {}
    for (i, k, w), p in zip(data, pooled, strict=True):
        sums[i, k] = sums.get((i, k), 0) + p * len(w)
    for i, (doc_id, mine) in enumerate(zip(ids, pieces, strict=True)):
        runs: list[list] = []
        for k, piece in enumerate(mine):
            p = sums[i, k] / sums[i, k].sum() if (i, k) in sums else np.eye(NONE + 1)[NONE]
            best = int(p.argmax())
            if runs and runs[-1][0] == best:
                runs[-1][1].append(piece)
                runs[-1][2].append(p[best])
            else:
                runs.append([best, [piece], [p[best]]])
        out += [(doc_id, k, None if b == NONE else LANGUAGES[b], float(np.mean(c)), " ".join(t)) for k, (b, t, c) in enumerate(runs)]
    return out


def language_segments(documents: DataFrame) -> DataFrame:
    """``(doc_id, segment_no, language, confidence, text)``: runs of sentences of one language.

    Neighbouring sentences of the same language form a segment; sentences
    without one (null) form segments of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.string()]
        for batch in batches:
            for start, texts in portions([t or "" for t in batch.column(1).to_pylist()], PORTION):
                rows = _segments(batch.column(0).slice(start, len(texts)).to_pylist(), texts)
                columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return documents.where("doc_id is not null").select("doc_id", "text").mapInArrow(cut, SEGMENTS)


def label_cases(detected: DataFrame) -> DataFrame:
    """``(doc_id, lang)``: languages of mixed documents, and of others whose label is missing, unusable or wrong.

    A label is wrong only if the network is sure of another language.
    """
    wrong = F.col("label").isNull() | (F.col("label") != F.col("language")) & (F.col("confidence") >= CONTRADICTION)
    found = F.when(F.size("mixed") > 1, F.col("mixed.lang")).when(F.col("language").isNotNull() & wrong, F.array("language"))
    # One pass: a union would label every text twice.
    return detected.select("doc_id", F.explode(found).alias("lang")).distinct()
