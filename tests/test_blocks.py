import random
from itertools import combinations

import numpy as np
import pytest

from strataform import runtime
from strataform.operators import blocks, dedup


def _texts(count, words=260, seed=5):
    # Texts of one vocabulary: any two have much in common, and some nearly all.
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    out = []
    while len(out) < count:
        text = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        for changes in (0, 3, 12, 30)[: rng.randint(1, 4)]:
            out.append(" ".join(rng.choice(vocabulary) if rng.random() < changes / 100 else w for w in text))
    return [*out[:count], out[0], "abc", "ABC", "ab", None, "  ", "Ünï 𝒳𝒴𝒵𝒳 漢字漢字"]


def _brute(spark, documents, threshold):
    sets = {r.doc_id: frozenset(r.grams) for r in dedup.shingled(documents.where("doc_id is not null")).collect()}
    first = {}
    for k, v in sorted(sets.items()):
        first.setdefault(v, k)
    similar = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    return {(a, b): s for a, b in combinations(sorted(first.values()), 2) if (s := similar(a, b)) >= threshold}, sets


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 3, 2**31 + 5, 0])
    assert blocks.unpack(blocks.pack(values)).tolist() == values.tolist()
    assert blocks.unpack(blocks.pack(values[:0])).size == 0


def test_ranges_of_sizes_hold_every_set():
    found = blocks.size_ranges([(3, 10**6), (4, 5), (600, 20_000), (601, 20_000), (90_000, 4)])
    assert [r[0] for r in found] == sorted(r[0] for r in found) and sum(r[2] for r in found) == 10**6 + 40_009
    assert found[0][3] >= 40 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert blocks.size_ranges([]) == []


@pytest.mark.parametrize("case", ["one block", "many blocks", "one size in parts", "few codes"])
def test_pairs_of_blocks_against_brute_force(spark, monkeypatch, case):
    if case == "many blocks":
        monkeypatch.setattr(blocks, "BLOCK_SETS", 40)
    elif case == "one size in parts":
        monkeypatch.setattr(blocks, "BLOCK_SETS", 3)
        monkeypatch.setattr(dedup, "MOST_TASKS", 40)
    elif case == "few codes":
        monkeypatch.setattr(dedup, "MOST_CODES", 50)
    rows = list(enumerate(_texts(70 if case == "one size in parts" else 240)))
    documents = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    want, sets = _brute(spark, documents, 0.6)
    found = dedup.CodedSets(documents, "text", "doc_id", 0.6).compared().collect()
    assert len(found) == len(want) > 20 and {(r.a, r.b): r.similarity for r in found} == want
    groups = {r.doc_id: r.group_id for r in dedup.similar_classes(documents, threshold=0.6).collect()}
    links = {**{k: k for k in sets}}
    for a, b in [*want, *((a, b) for a, b in combinations(sorted(sets), 2) if sets[a] == sets[b])]:
        low, high = sorted((links[a], links[b]))
        links = {k: low if v == high else v for k, v in links.items()}
    sizes = {g: sum(v == g for v in links.values()) for g in links.values()}
    assert groups == {k: g for k, g in links.items() if sizes[g] > 1}


def test_keys_that_are_strings(spark):
    rows = [(f"d{i}", t) for i, t in enumerate(_texts(60))]
    documents = spark.createDataFrame(rows, "doc_id string, text string")
    want, _ = _brute(spark, documents, 0.6)
    assert {(r.a, r.b): r.similarity for r in dedup.similar_pairs(documents, threshold=0.6).collect()} == want


def test_low_thresholds_write_no_more_than_the_texts(spark, monkeypatch):
    written = {}
    before = runtime.Stored.__init__

    def recorded(self, df, name, *rest, **named):
        before(self, df, name, *rest, **named)
        written[name] = written.get(name, 0) + self.size_bytes()

    monkeypatch.setattr(runtime.Stored, "__init__", recorded)
    rows = list(enumerate(_texts(600, words=4000)))
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    texts = sum(len(t or "") for _, t in rows)
    for find in (dedup.similar_pairs, dedup.similar_classes):
        written.clear()
        assert find(documents, threshold=0.6).count()
        assert sum(written.values()) < 2 * texts, written


def test_sketches_are_made_for_documents_of_a_pair_alone(spark, tmp_path, monkeypatch):
    from strataform import queries

    rows = list(enumerate(_texts(60, words=4000)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents.selectExpr("*", "'en' as lang", "'s' as source").write.parquet(f"{tmp_path}/documents.parquet")
    sketched, before = [], dedup.sketches

    def counted(texts, *rest, **named):
        sketched.extend(r.doc_id for r in texts.select("doc_id").collect())
        return before(texts, *rest, **named)

    monkeypatch.setattr(dedup, "sketches", counted)
    found = {(r.a, r.b): r.shared_bands for r in queries.near_pair_bands(spark, str(tmp_path)).collect()}
    want, sets = _brute(spark, documents, 0.6)
    assert found.keys() == want.keys() and sorted(sketched) == sorted({i for pair in want for i in pair}) and len(sketched) < len(sets)
    # Against sketches made of one trigram at a time.
    buckets = {i: set() for i in sketched}
    for i in sketched:
        mixed = np.array([dedup.xxhash.xxh64_intdigest(g.encode()) for g in sets[i]], np.uint64)[:, None] * dedup.SEEDS
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        low = (mixed >> np.uint64(1)).min(0)
        buckets[i] = {(k, tuple(low[k * 8 : k * 8 + 8].tolist())) for k in range(dedup.BANDS)}
    assert found == {(a, b): len(buckets[a] & buckets[b]) for a, b in want} and any(found.values())
