"""Normalization, quality, language and duplicate detection against plain Python."""

import random
import unicodedata
from itertools import combinations

import pytest

from strataform.operators import dedup, language, normalize, quality

TEXTS = [
    None, "", " ", "a", "ab", "abc", "one line\n", "two\nlines\r\nand more\rhere", "trailing  \t\nblank \nend", "café", "zero​width \x07bell", "x" * 3000,
    "same same same same", "line\nline\nline\nother", " split here", "\U0001f600\U0001f600 emoji \U0001f600", "ΑΒΓ 123 ²³ €$ !?", "wide\x0btab\x1csep",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def plain_normal(t):
    t = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
    t = "\n".join(line.rstrip() for line in t.split("\n"))
    t = "".join(c for c in t if c in "\n\t\r" or unicodedata.category(c)[0] != "C")
    return t + "\n" if t and not t.endswith("\n") else t


def test_normalize(documents):
    rows = {r.doc_id: r for r in normalize.normalize(documents).collect()}
    for i, t in enumerate(TEXTS):
        assert rows[i].normalized_text == (None if t is None else plain_normal(t)), repr(t)
        assert rows[i].content_changed == (t is not None and plain_normal(t) != t)
    again = normalize.normalize(documents.sparkSession.createDataFrame([(1, plain_normal(t)) for t in TEXTS if t], "doc_id long, text string"))
    assert not again.where("content_changed").count()


def test_text_metrics(documents):
    rows = {r.doc_id: r for r in quality.text_metrics(documents).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        r = rows[i]
        assert (r.character_count, r.word_count, r.line_count) == (len(t), len(t.split()), len(t.splitlines())), repr(t)
        assert r.max_line_length == max(map(len, t.splitlines()), default=0)
        assert r.avg_word_length == pytest.approx(sum(map(len, t.split())) / max(1, len(t.split())))


def test_composition_and_repetition(documents):
    rows = {r.doc_id: r for r in quality.repetition_signals(quality.content_composition(documents)).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        assert rows[i].alphabetic_ratio == pytest.approx(sum(map(str.isalpha, t)) / max(1, len(t)), abs=1e-4)
        assert rows[i].punctuation_ratio == pytest.approx(sum(unicodedata.category(c)[0] == "P" for c in t) / max(1, len(t)), abs=1e-4)
        words = t.split()
        assert rows[i].total_words == len(words) and rows[i].distinct_words == len(set(words))
        lines = [x.strip() for x in t.splitlines() if x.strip()]
        assert rows[i].max_line_repetition == max(map(lines.count, lines), default=0)
        assert rows[i].repeated_lines == sum(lines.count(x) > 1 for x in set(lines))


def test_language(spark):
    documents = spark.createDataFrame([(1, "the house of the mother", "en"), (2, "la casa de la madre", "es"), (3, "12", "en"), (4, None, None)], "doc_id long, text string, lang string")
    profiles = language.learn_profiles(documents)
    assert list(profiles) == ["en", "es"]
    found = {r.doc_id: (r.language, r.code) for r in language.detect(documents, profiles).collect()}
    assert found == {1: ("English", "en"), 2: ("Spanish", "es"), 3: ("unknown", "unknown"), 4: ("unknown", "unknown")}


@pytest.mark.parametrize("threshold", [0.6, 0.85])
def test_similar_pairs_are_all(spark, threshold):
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge by the river"
    words = base.split()
    texts = [base, base, base + " today", base.replace("quick", "quack"), " ".join(words[5:]), "something else entirely different from it", "ab", "abc", "abd", None, ""]
    texts += [" ".join(w if i != k else "xx" for i, w in enumerate(words)) for k in range(6)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {r.doc_id: frozenset(r.grams) for r in dedup.shingled(documents).collect()}
    first = {}
    for k, v in sorted(sets.items()):
        first.setdefault(v, k)
    want = {(a, b) for a, b in combinations(sorted(first.values()), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}
    assert {(r.a, r.b) for r in dedup.similar_pairs(documents, threshold=threshold).collect()} == want
    assert {(r.a, r.b) for r in dedup.similar_pairs(documents, threshold=threshold, exact=True).collect()} == want
    groups = {r.doc_id: r.group_id for r in dedup.similar_classes(documents, threshold=threshold).collect()}
    assert groups[0] == groups[1] == 0
    assert all(groups[a] == groups[b] for a, b in want)


def test_membership_tiers(spark):
    rows = [(1, "a b c", "r1", "n1"), (2, "a b c", "r1", "n1"), (3, "a  b c", "r3", "n1"), (4, "other", "r4", "n4"), (5, None, "r1", None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, raw_checksum string, normalized_checksum string")
    got = {(r.tier, r.group_id, r.doc_id) for r in dedup.memberships(documents, "normalized").collect()}
    assert got == {("raw_exact", 1, 1), ("raw_exact", 1, 2), ("raw_exact", 1, 5), ("normalized_exact", 1, 1), ("normalized_exact", 1, 2), ("normalized_exact", 1, 3)}
    assert dedup.memberships(documents, "none").count() == 0
    assert dedup.memberships(documents.limit(0), "near").count() == 0


def test_band_plan():
    for threshold in (0.5, 0.6, 0.85, 0.95, 1.0):
        for sets in (0, 10, 10**4, 10**7, 10**10):
            rows, bands = dedup.band_plan(threshold, sets)
            assert rows >= 1 and 1 <= bands <= dedup.MOST_BANDS
            assert (1 - min(threshold, 0.999) ** rows) ** bands <= dedup.MISS * 1.001
    assert dedup.band_plan(0.85, 10**4)[0] < dedup.band_plan(0.85, 10**6)[0]


def _edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = "".join(rng.choice("abcdefghij") for _ in range(6))
    return " ".join(out)


@pytest.mark.parametrize("threshold", [0.7, 0.85])
def test_similar_pairs_against_brute_force(spark, threshold):
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        words = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
        texts += [_edited(rng, words, k) for k in (0, 0, 1, 2, 3, 5)]
    documents = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0])], "doc_id long, text string")
    sets = {r.doc_id: frozenset(r.grams) for r in dedup.shingled(documents.where("doc_id is not null")).collect()}
    first = {}
    for k, v in sorted(sets.items()):
        first.setdefault(v, k)
    ids = sorted(first.values())
    want = {(a, b) for a, b in combinations(ids, 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}
    got = {(r.a, r.b): r.similarity for r in dedup.similar_pairs(documents, threshold=threshold).collect()}
    assert len(want) > 100 and set(got) == want
    assert all(abs(v - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 1e-12 for (a, b), v in got.items())


def test_similar_classes_of_a_hot_bucket(spark):
    # Half of all texts are one text with a word changed: all are one group, by few pairs.
    rng = random.Random(3)
    words = [f"w{i}x{i * 7 % 13}" for i in range(60)]
    rows = [(i, _edited(rng, words, 1)) for i in range(150)] + [(1000 + i, _edited(rng, [f"z{i}{j * j % 17}k" for j in range(40)], 0)) for i in range(150)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {r.doc_id: r.group_id for r in dedup.similar_classes(documents).collect()}
    assert {i: 0 for i in range(150)} == {k: g for k, g in groups.items() if k < 1000}
    sets = dedup.TrigramSets(documents, "text", "doc_id", 0.85)
    links, _ = dedup.similar_links(sets)
    assert links.where("u < 1000").count() < 150 * 40


def test_group_statistics_and_shared_bands(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.86), (7, 8, 1 / 3 + 0.6)], "a long, b long, similarity double")
    groups = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (7, 7), (7, 8)], "group_id long, id long")
    got = {r.group_id: tuple(r)[1:] for r in dedup.group_statistics(pairs, groups).collect()}
    assert got == {1: (3, 2, 0.86, 0.9, 0.88), 7: (2, 1, 0.9333, 0.9333, 0.9333)}
    texts = spark.createDataFrame([(1, "the same words here"), (2, "the same words here"), (3, "nothing of that kind at all")], "doc_id long, text string")
    buckets = dedup.band_buckets(dedup.sketches(texts))
    shared = {(r.a, r.b): r.shared_bands for r in dedup.shared_bands(pairs.where("b < 7"), buckets).collect()}
    assert shared == {(1, 2): dedup.BANDS, (2, 3): 0}
