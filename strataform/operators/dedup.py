"""Duplicate detection: exact by checksum, near by overlap of character trigrams.

Near duplicates are found by min-hash signatures cut into bands.  Bands have the
more rows the more sets there are (so that a chance pair shares one with a
probability that falls as the collection grows, and buckets stay small), and are
so many that a pair at the threshold itself is missed by all of them with a
probability of ``MISS``; the more similar a pair, the less.  Pairs that share a
bucket are weighed by a short sketch, and what may reach the threshold is
verified on whole sets.  ``exact=True`` takes the pigeonhole principle instead
(below), which misses nothing and whose cost grows faster than the collection.

Where the threshold lies so low that the bands allowed have few rows, buckets hold
pairs that have no more in common than any two texts.  Their pairs are too many to
be written, so sets are then compared block by block (``blocks``).

Groups need no pair inside a bucket whose members are linked already: each
member is verified against its bucket's least one first, and pairs are looked at
only across the groups so found.  Equal sets are one class and compared once.

The pigeonhole join: two sets whose similarity is t or more differ in at most k
elements, k following from their sizes.  All trigrams are spread over k + m + 1
parts by a hash, so at least m + 1 parts hold the same trigrams in both;
documents are joined on the hashes of their parts.  Sizes fall into classes so
wide that similar sets lie in the same class or in neighbouring ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.functions.text import character_ngrams, flattened, two_places
from strataform.operators import blocks
from strataform.operators.components import connected_components
from strataform.runtime import BROADCAST_LIMIT_BYTES, Stored, hot_rows, lookup_join, scratch, store, tasks_apart

THRESHOLD = 0.85
SHINGLE = 3
SKETCH, BANDS = 128, 16
#: The chance that a pair at the threshold shares no band.
MISS = 1e-4
#: Similarity of texts that have little but a language and a kind in common.
BACKGROUND = 0.5
#: Bands at most; they then have fewer rows, and buckets more pairs to weigh.
MOST_BANDS = 160
#: Bands that two texts with nothing but the background in common may share on average; beyond, sets are compared by blocks.
MOST_SHARED = 0.05
#: Trigrams that get a code, at most; they and their counts are sent to the driver.
MOST_CODES = 1 << 20
#: Pairs of blocks that one job compares.
MOST_TASKS = 256
TIERS = ("raw_exact", "normalized_exact", "near_duplicate")


def exact_groups(documents: DataFrame, checksum: str, key: str = "doc_id") -> DataFrame:
    """``(group_id, size)`` of checksums that two or more documents share; the id is the smallest key."""
    known = documents.where(F.col(checksum).isNotNull())
    return known.groupBy(checksum).agg(F.min(key).alias("group_id"), F.count("*").alias("size")).where("size > 1").select("group_id", "size", F.col(checksum).alias("checksum"))


def exact_memberships(documents: DataFrame, checksum: str, tier: str, key: str = "doc_id") -> DataFrame:
    """``(tier, group_id, key)`` of every document whose checksum another one shares.

    A checksum that many documents share is joined apart from the rest.
    """
    groups = store(exact_groups(documents, checksum, key).select("group_id", "size", F.col("checksum").alias(checksum)), "exact-groups").df
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    pairs = groups.select(checksum, "group_id")
    joined = lookup_join(documents.select(checksum, key), checksum, pairs, checksum, hot_rows(groups, "size", total).select(checksum, "group_id"))
    return joined.select(F.lit(tier).alias("tier"), "group_id", key)


def shingled(documents: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """``(key, grams, n, class)`` of documents with at least one n-gram; equal sets have equal classes."""
    grams = documents.select(key, F.array_sort(character_ngrams(F.col(text), size)).alias("grams"))
    known = grams.where(F.size("grams") > 0)
    return known.withColumn("n", F.size("grams")).withColumn("class", F.sha2(F.array_join("grams", "\x00"), 256))


def size_classes(threshold: float, largest: int) -> list[int]:
    """The largest size of each class; similar sets lie at most one class apart."""
    tops, low = [], 1
    while not tops or tops[-1] < largest:
        tops.append(int(low / threshold + 1e-9))
        low = tops[-1] + 1
    return tops


def part_signatures(grams: list[str], tops: list[int], threshold: float) -> list[tuple[int, np.ndarray, int, int]]:
    """For a set's size class and the next: the group, hashes of parts, empty parts, and equal parts needed.

    Empty parts are left out unless there are so many that two sets might agree
    in those alone.
    """
    h = np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) for g in grams], np.uint64)
    mixed = h * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    own = int(np.searchsorted(tops, h.size))
    out = []
    for group in (own, own + 1):
        top = tops[group] if group < len(tops) else int((tops[-1] + 1) / threshold + 1e-9)
        differ = int((1 - threshold) / (1 + threshold) * 2 * top + 1e-9)
        needed = 3 + differ // 3 + 1
        parts = differ + needed
        place = (h % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, place, mixed)
        filled = np.bincount(place, minlength=parts) > 0
        empty = int(parts - filled.sum())
        if empty >= needed:
            filled[:] = True
        sums ^= np.arange(parts, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        sums ^= sums >> np.uint64(31)
        out.append((group, sums[filled].view(np.int64), empty, needed))
    return out


def _pigeonhole_pairs(documents: DataFrame, text: str, key: str, threshold: float) -> DataFrame:
    """The pairs of ``similar_pairs``, all of them."""
    sets = shingled(documents.where(F.col(key).isNotNull()), text, key)
    classes = store(sets.groupBy("class").agg(F.min(key).alias("id"), F.first("n").alias("n"), F.first("grams").alias("grams")).drop("class"), "trigram-sets").df
    largest = classes.agg(F.max("n")).first()[0] or 1
    tops = size_classes(threshold, largest)
    kind = documents.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *part) for i, g in enumerate(batch.column(2).to_pylist()) for part in part_signatures(g, tops, threshold)]
            if found:
                size = [f[2].size for f in found]
                row, group, empty, needed = (np.repeat([f[k] for f in found], size) for k in (0, 1, 3, 4))
                at = pa.array(row)
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(group.astype(np.int32)), pa.array(np.concatenate([f[2] for f in found])), pa.array(empty.astype(np.int32)), pa.array(needed.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "grp", "part", "empty", "needed"])

    index = store(classes.select("id", "n", "grams").mapInArrow(sign, f"id {kind}, n int, grp int, part long, empty int, needed int"), "parts").df
    side = lambda name: index.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("empty").alias(f"e{name}"), "grp", "part", *(["needed"] if name == "a" else []))
    near = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - F.lit(1e-9))
    agreeing = side("a").join(side("b"), ["grp", "part"]).where(near).groupBy("a", "b", "grp").agg(F.count("*").alias("equal"), F.first("needed").alias("needed"), F.first(F.least("ea", "eb")).alias("bare"))
    candidates = agreeing.where(F.col("equal") >= F.greatest(F.lit(1), F.col("needed") - F.col("bare"))).select("a", "b").distinct()
    sets = classes.select("id", _hashes(F.col("grams")).alias("hashes"))
    return verify(candidates, sets, threshold)


def band_plan(threshold: float, sets: int) -> tuple[int, int]:
    """Rows and number of bands for a collection of so many sets."""
    needed = lambda rows: max(1, math.ceil(math.log(MISS) / math.log1p(-(min(threshold, 0.999) ** rows))))
    rows = max(2, math.ceil(math.log(max(2, sets)) / -math.log(BACKGROUND)))
    while rows > 1 and needed(rows) > MOST_BANDS:
        rows -= 1
    return rows, needed(rows)


def crowded(threshold: float, sets: int) -> bool:
    """Whether the bands of so many sets would put most of any two texts in a bucket together."""
    rows, bands = band_plan(threshold, sets)
    return bands * BACKGROUND**rows > MOST_SHARED and sets > 1 and rows < math.log2(sets)


def _hashes(grams: Column) -> Column:
    return F.transform(grams, lambda g: F.xxhash64(g))


class TrigramSets:
    """The trigram sets of ``documents(key, text)`` as narrow rows: class, size, buckets and sketch.

    Rows without a key are left out; texts under three characters have no set.
    The texts themselves are neither kept nor shuffled.
    """

    def __init__(self, documents: DataFrame, text: str, key: str, threshold: float):
        self.threshold, self.kind = threshold, documents.schema[key].dataType.simpleString()
        self.texts = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
        # The rows of a band follow from how many texts there are.
        self.rows, self.bands = band_plan(threshold, self.texts.count())
        signed = self._hashed(self.texts).mapInArrow(_signer(self.rows, self.bands), f"id {self.kind}, n int, class binary, buckets array<long>, sketch binary")
        self.signed = store(signed, "signed-sets", counted=True)
        self.classes = store(self.signed.df.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("size")).where("size > 1"), "set-classes")
        self.hot = hot_rows(self.classes.df, "size", self.signed.rows).select("class", "class_id")

    @staticmethod
    def _hashed(texts: DataFrame) -> DataFrame:
        return texts.select("id", _hashes(character_ngrams(F.col("text"), SHINGLE)).alias("hashes"))

    def _joined(self, columns: list[str]) -> DataFrame:
        """The signed rows with their class's id, null where the set stands alone."""
        return lookup_join(self.signed.df.select("class", "id", *columns), "class", self.classes.df.select("class", "class_id"), "class", self.hot, "left")

    def members(self) -> DataFrame:
        """``(id, class_id)`` of every document; the class id is the least id with the same set."""
        return self._joined([]).select("id", F.coalesce("class_id", "id").alias("class_id"))

    def representatives(self) -> DataFrame:
        """``(id, n, buckets, sketch)``: one row for each distinct set."""
        kept = self._joined(["n", "buckets", "sketch"]).where("class_id is null or class_id = id")
        # A repeated row of a representative is the same set again.
        return kept.dropDuplicates(["class", "id"]).select("id", "n", "buckets", "sketch")

    def verified(self, candidates: DataFrame, sketches: DataFrame) -> DataFrame:
        """``(a, b, similarity)`` of the candidates ``(a, b)`` that reach the threshold."""
        side = lambda name: sketches.select(F.col("id").alias(name), F.col("sketch").alias(f"s{name}"))
        weighed = candidates.join(side("a"), "a").join(side("b"), "b").mapInArrow(_weigher(self.threshold, self.rows * self.bands), f"a {self.kind}, b {self.kind}")
        near = store(weighed, "near-candidates", counted=True)
        ids = store(near.df.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
        small = ids.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES
        sets = store(self._hashed(self.texts.join(F.broadcast(ids.df) if small else ids.df, "id", "left_semi")), "near-sets")
        return verify(near.df, sets.df, self.threshold)


class CodedSets(TrigramSets):
    """The trigram sets of ``documents(key, text)`` as rows of packed codes, for ``blocks``: class, size and codes."""

    def __init__(self, documents: DataFrame, text: str, key: str, threshold: float):
        self.threshold, self.kind = threshold, documents.schema[key].dataType.simpleString()
        kept = documents.where(F.col(key).isNotNull() & (F.length(text) >= SHINGLE))
        texts = kept.select(F.col(key).alias("id"), flattened(F.col(text)).alias("text"))
        counted = texts.mapInArrow(blocks.count_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
        known = store(counted, "trigrams", counted=True)
        codes = known.df.orderBy(F.desc("n"), "key").limit(MOST_CODES).select("key").toArrow()["key"].to_numpy()
        self.known = codes.size
        encode = blocks.encoder(codes, known.rows <= MOST_CODES)
        self.signed = store(texts.mapInArrow(encode, f"id {self.kind}, n int, class binary, codes binary, rare array<long>"), "signed-sets", counted=True)
        self.classes = store(self.signed.df.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("size")).where("size > 1"), "set-classes")
        self.hot = hot_rows(self.classes.df, "size", self.signed.rows).select("class", "class_id")

    def representatives(self) -> DataFrame:
        """``(id, n, codes, rare)``: one row for each distinct set."""
        kept = self._joined(["n", "codes", "rare"]).where("class_id is null or class_id = id")
        return kept.dropDuplicates(["class", "id"]).select("id", "n", "codes", "rare")

    def compared(self, linked: bool = False) -> DataFrame:
        """``(a, b, similarity)`` of all pairs that reach the threshold or, if ``linked``, of as many as join the same sets."""
        sizes = self.signed.df.groupBy("n").count().collect()
        ranges = blocks.size_ranges([tuple(r) for r in sizes])
        number = F.lit(0)
        parts: list[tuple[int, int, float]] = []
        for low, high, sets, count in ranges:
            part = len(parts) + (F.pmod(F.xxhash64("id"), F.lit(count)).cast("int") if count > 1 else F.lit(0))
            number = F.when(F.col("n") >= low, part).otherwise(number) if low > ranges[0][0] else part
            parts += [(low, high, sets / count)] * count
        written = store(self.representatives().withColumn("block", number).repartition("block"), "blocks", by="block").df
        pairs = [(x, y) for y in range(len(parts)) for x in range(y + 1) if parts[x][1] >= self.threshold * parts[y][0] - 1e-9]
        # The largest first, so that none of them is left to the end.
        pairs.sort(key=lambda p: -parts[p[0]][2] * parts[p[1]][2] / (1 + (p[0] == p[1])))
        compare, found = blocks.comparer(self.threshold, self.known, linked), []
        for at in range(0, len(pairs), MOST_TASKS):
            tasks = [written.where(F.col("block").isin(x, y)).coalesce(1).withColumn("alone", F.lit(x == y)) for x, y in pairs[at : at + MOST_TASKS]]
            rows = reduce(DataFrame.unionByName, tasks).mapInArrow(compare, f"a {self.kind}, b {self.kind}, similarity double")
            with tasks_apart(self.signed.spark):
                found.append(store(rows, "compared").df)
        return reduce(DataFrame.unionByName, found) if found else self.signed.spark.createDataFrame([], f"a {self.kind}, b {self.kind}, similarity double")


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, similarity)`` of pairs of ``sets(id, hashes)`` whose similarity reaches the threshold."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("hashes").alias(f"g{name}"))
    common = F.size(F.array_intersect("ga", "gb"))
    scored = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", (common / (F.size("ga") + F.size("gb") - common)).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def _signer(rows: int, bands: int):
    """From batches of ``(id, hashes)`` each set's size, class, bucket of each band, and sketch of a byte for each hash function.

    The class is 128 bits that follow from the set alone.  Empty sets give no row.
    """
    rng = np.random.default_rng(rows * 1000 + bands)
    factor = rng.integers(0, 2**64, rows * bands, np.uint64) | np.uint64(1)
    weight = rng.integers(0, 2**64, max(2, rows), np.uint64) | np.uint64(1)

    def least(h: np.ndarray) -> np.ndarray:
        out = np.empty(factor.size, np.uint64)
        # So many functions at a time that the products stay in the cache.
        step = max(1, 32768 // h.size)
        for at in range(0, factor.size, step):
            out[at : at + step] = (factor[at : at + step, None] * h[None, :]).min(1)
        return out

    def whole(h: np.ndarray) -> bytes:
        mixed = h ^ (h >> np.uint64(32))
        halves = [(mixed * weight[0]).sum(dtype=np.uint64)]
        mixed = (h * weight[1]) ^ ((h * weight[1]) >> np.uint64(29))
        return np.array([*halves, (mixed * weight[0]).sum(dtype=np.uint64)], np.uint64).tobytes()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            filled = np.flatnonzero(sizes > 0)
            if not filled.size:
                continue
            offsets = batch.column(1).offsets.to_numpy()
            values = batch.column(1).values.to_numpy().view(np.uint64)
            mins, classes = np.empty((filled.size, factor.size), np.uint64), []
            for at, i in enumerate(filled):
                h = values[offsets[i] : offsets[i + 1]]
                mins[at] = least(h)
                classes.append(whole(h))
            mixed = (mins * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7)).reshape(-1, bands, rows)
            buckets = (mixed * weight[:rows]).sum(2, dtype=np.uint64)
            buckets ^= np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
            buckets ^= buckets >> np.uint64(31)
            flat = pa.array(buckets.view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat)
            low = (mins * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.uint8)
            columns = [batch.column(0).take(pa.array(filled)), pa.array(sizes[filled].astype(np.int32)), pa.array(classes, pa.binary()), lists, pa.array([row.tobytes() for row in low], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class", "buckets", "sketch"])

    return sign


def _weigher(threshold: float, functions: int):
    """Batches of ``(a, b, sketch, sketch)`` without the pairs that lie six deviations under the threshold."""
    least = threshold - 6 * math.sqrt(max(threshold * (1 - threshold), 0.01) / functions)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = (np.frombuffer(b"".join(batch.column(f"s{c}").to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in "ab")
            # Bytes of unequal sets agree by chance once in so many.
            agree = ((first == second).mean(1) - 1 / 256) / (1 - 1 / 256)
            kept = pa.array(np.flatnonzero(agree >= least))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])

    return weigh


def _alike(threshold: float) -> Column:
    """Whether two sizes ``na`` and ``nb`` allow the threshold at all."""
    return F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - F.lit(1e-9)


def _index(representatives: DataFrame) -> Stored:
    return store(representatives.select("id", "n", F.explode("buckets").alias("bucket")), "buckets", counted=True)


def similar_pairs(documents: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, exact: bool = False) -> DataFrame:
    """``(a, b, similarity)`` for the pairs of texts with that Jaccard similarity or more, ``a < b``.

    Each distinct trigram set is represented by its smallest key; copies are not
    expanded into pairs.  Texts under three characters and rows without a key
    match nothing.  The threshold lies above 0; at 1 nothing is left to pair.
    A pair at the threshold is missed with a probability of ``MISS``, or never if
    ``exact``.
    """
    with scratch() as keep:
        if exact:
            found = _pigeonhole_pairs(documents, text, key, threshold)
        elif crowded(threshold, documents.count()):
            found = CodedSets(documents, text, key, threshold).compared()
        else:
            found = _banded_pairs(documents, text, key, threshold)
        return keep(store(found, "similar-pairs")).df


def _banded_pairs(documents: DataFrame, text: str, key: str, threshold: float) -> DataFrame:
    """The pairs of ``similar_pairs`` that share a band."""
    sets = TrigramSets(documents, text, key, threshold)
    representatives = store(sets.representatives(), "representatives").df
    index = _index(representatives).df
    side = lambda name: index.select("bucket", F.col("id").alias(name), F.col("n").alias(f"n{name}"))
    candidates = side("a").join(side("b"), "bucket").where((F.col("a") < F.col("b")) & _alike(threshold)).select("a", "b").distinct()
    return sets.verified(candidates, representatives)


def similar_links(sets: TrigramSets) -> tuple[DataFrame, DataFrame]:
    """Verified links ``(u, v)`` that join the same sets as all similar pairs would, and the groups ``(group_id, id)``.

    A bucket of any size gives one pair a member, and further pairs only between
    members that those links leave in different groups.
    """
    if isinstance(sets, CodedSets):
        links = store(sets.compared(linked=True).select(F.col("a").alias("u"), F.col("b").alias("v")), "links").df
        return links, connected_components(links)
    representatives = store(sets.representatives(), "representatives").df
    indexed = _index(representatives)
    index, threshold = indexed.df, sets.threshold
    anchors = store(index.groupBy("bucket").agg(F.min("id").alias("a"), F.min_by("n", "id").alias("na"), F.count("*").alias("size")).where("size > 1"), "anchors")
    hot = hot_rows(anchors.df, "size", indexed.rows).drop("size")
    shared = store(lookup_join(index, "bucket", anchors.df.drop("size"), "bucket", hot).select("bucket", F.col("id").alias("b"), F.col("n").alias("nb"), "a", "na"), "shared-buckets").df
    first = shared.where((F.col("a") != F.col("b")) & _alike(threshold)).select("a", "b").distinct()
    found = store(sets.verified(first, representatives).select(F.col("a").alias("u"), F.col("b").alias("v")), "links").df
    known = store(connected_components(found), "known-groups").df
    # Members of a bucket that are in one group already are not paired again.
    placed = shared.select("bucket", F.col("b").alias("id"), F.col("nb").alias("n")).join(known, "id", "left").select("bucket", "id", "n", F.coalesce("group_id", "id").alias("group"))
    mixed = placed.groupBy("bucket").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least <> most").select("bucket")
    placed = store(placed.join(mixed, "bucket", "left_semi"), "mixed-buckets").df
    groups = placed.select("bucket", "group").distinct()
    across = groups.select("bucket", F.col("group").alias("x")).join(groups.select("bucket", F.col("group").alias("y")), "bucket").where("x < y")
    side = lambda group, name: placed.select("bucket", F.col("group").alias(group), F.col("id").alias(name), F.col("n").alias(f"n{name}"))
    between = across.join(side("x", "p"), ["bucket", "x"]).join(side("y", "q"), ["bucket", "y"])
    ordered = between.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), F.col("np").alias("na"), F.col("nq").alias("nb")).where(_alike(threshold))
    more = sets.verified(ordered.select("a", "b").distinct(), representatives).select(F.col("a").alias("u"), F.col("b").alias("v"))
    links = store(found.unionByName(more), "links").df
    return links, connected_components(links)


def similar_classes(documents: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``(key, group_id)``: every document in a group of two or more linked by ``similar_pairs`` or equal sets.

    The group id is the smallest key of the group.  A document that stands in
    several rows counts once.
    """
    with scratch() as keep:
        kind = CodedSets if crowded(threshold, documents.count()) else TrigramSets
        sets = kind(documents, text, key, threshold)
        groups = similar_links(sets)[1]
        joined = sets.members().distinct().join(groups.withColumnRenamed("id", "class_id"), "class_id", "left").select(F.col("id").alias(key), F.coalesce("group_id", "class_id").alias("group_id"))
        joined = keep(store(joined.distinct(), "grouped", counted=True))
    sizes = joined.df.groupBy("group_id").agg(F.count("*").alias("size")).where("size > 1")
    return lookup_join(joined.df, "group_id", sizes.select("group_id"), "group_id", hot_rows(sizes, "size", joined.rows).select("group_id")).select(key, "group_id")


def group_statistics(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``(group_id, size, pair_count, min_similarity, max_similarity, average_similarity)`` of each group of near duplicates.

    ``size`` counts the distinct sets of the group; similarities are rounded to
    four places, their sum being taken in whole millionths so that it does not
    depend on row order.
    """
    rounded = lambda c: F.floor(c * 10000 + 0.5) / 10000
    units = F.floor(F.col("similarity") * 1_000_000 + 0.5).cast("long")
    linked = pairs.join(groups.withColumnRenamed("id", "a"), "a").groupBy("group_id")
    found = linked.agg(F.count("*").alias("pair_count"), F.min("similarity").alias("low"), F.max("similarity").alias("high"), F.sum(units).alias("units"))
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("size"))
    return found.join(sizes, "group_id").select("group_id", "size", "pair_count", rounded(F.col("low")).alias("min_similarity"), rounded(F.col("high")).alias("max_similarity"), rounded(F.col("units") / F.col("pair_count") / 1_000_000).alias("average_similarity"))


def shared_bands(pairs: DataFrame, buckets: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pairs ``(a, b, ...)`` with ``shared_bands``, the bands of ``band_buckets`` that both documents share; 0 if none."""
    pairs = store(pairs, "pairs").df
    ids = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    lists = store(buckets.join(ids, key, "left_semi").groupBy(key).agg(F.collect_set("bucket").alias("buckets")), "bucket-lists")
    # The lists are wider than the pairs, which are the more: where they may, they go to the pairs.
    known = F.broadcast(lists.df) if lists.size_bytes() <= BROADCAST_LIMIT_BYTES // 2 else lists.df
    side = lambda name: known.select(F.col(key).alias(name), F.col("buckets").alias(f"k{name}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.select(*pairs.columns, F.coalesce(F.size(F.array_intersect("ka", "kb")), F.lit(0)).cast("long").alias("shared_bands"))


SEEDS = np.array([xxhash.xxh64_intdigest(str(i)) | 1 for i in range(SKETCH)], np.uint64)


def sketches(documents: DataFrame, text: str = "text", key: str = "doc_id", banding: str = "positional") -> DataFrame:
    """``(key, sketch)``: the least of 128 hash functions over each document's trigrams.

    ``banding="sorted"`` sorts the sketch, which makes bands of it order
    statistics and loses most of their recall; ``"positional"`` keeps each
    function in its place.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            # A trigram is hashed once for all the texts of a batch that have it.
            coded = batch.column(1).flatten().dictionary_encode()
            hashes = np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) for g in coded.dictionary.to_pylist()], np.uint64)
            places = coded.indices.to_numpy()
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
            for start, end in zip([0, *ends[:-1]], ends):
                mixed = hashes[places[start:end]][:, None] * SEEDS
                mixed ^= mixed >> np.uint64(32)
                mixed *= np.uint64(0x9E3779B97F4A7C15)
                low = (mixed >> np.uint64(1)).min(0).astype(np.int64)
                out.append((np.sort(low) if banding == "sorted" else low).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=[key, "sketch"])

    return shingled(documents, text, key).select(key, "grams").mapInArrow(run, f"`{key}` {kind}, sketch array<bigint>")


def band_buckets(sketched: DataFrame, key: str = "doc_id", bands: int = BANDS) -> DataFrame:
    """``(bucket, key)``: one row for each band of each sketch."""
    width = SKETCH // bands
    keys = F.array(*[F.xxhash64(F.lit(i), F.slice("sketch", i * width + 1, width)) for i in range(bands)])
    return sketched.select(key, F.explode(keys).alias("bucket"))


def band_groups(sketched: DataFrame, key: str = "doc_id", bands: int = BANDS) -> DataFrame:
    """``(key, anchor)``: documents that share a band with another, each linked to the least of its bucket.

    A bucket of any size gives one row a document, not all its pairs.
    """
    buckets = band_buckets(sketched, key, bands)
    anchors = buckets.groupBy("bucket").agg(F.min(key).alias("anchor"), F.count("*").alias("size")).where("size > 1")
    return buckets.join(anchors, "bucket").where(F.col(key) != F.col("anchor")).select(key, "anchor").distinct()


def sketch_links(documents: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, banding: str = "positional") -> DataFrame:
    """``(a, b, similarity)``: documents verified against the least one of a bucket that they share in ``band_groups``.

    Its recall is that of 16 bands of 8 rows, and that of the least members; see
    ``similar_pairs`` for all pairs.
    """
    found = band_groups(sketches(documents.where(F.col(key).isNotNull()), text, key, banding), key).select(F.col("anchor").alias("a"), F.col(key).alias("b"))
    sets = documents.select(F.col(key).alias("id"), _hashes(character_ngrams(F.col(text), SHINGLE)).alias("hashes"))
    return verify(found, sets, threshold)


def representatives(members: DataFrame) -> DataFrame:
    """``(group_id, doc_id, selection_basis)``: the best document of each group.

    ``members(group_id, doc_id, has_text, quality_score, warning_count)``; a text
    comes first, then the higher score, fewer warnings and the smaller id.
    """
    score, warnings = F.coalesce("quality_score", F.lit(0.0)), F.coalesce("warning_count", F.lit(0))
    rank = F.struct((~F.col("has_text")).alias("bare"), (-score).alias("worse"), warnings.alias("warnings"), F.col("doc_id"))
    best = members.groupBy("group_id").agg(F.min(rank).alias("r"))
    parts = F.array_compact(
        F.array(F.when(~F.col("r.bare"), "has_normalized_text"), F.when(F.col("r.worse") < 0, F.concat(F.lit("quality_score_"), two_places(-F.col("r.worse")))), F.when(F.col("r.warnings") == 0, "no_warnings"))
    )
    basis = F.when(F.size(parts) == 0, "stable_id_tiebreaker").otherwise(F.concat(F.array_join(parts, "_"), F.lit("_stable_id")))
    return best.select("group_id", F.col("r.doc_id").alias("doc_id"), basis.alias("selection_basis"))


def memberships(documents: DataFrame, mode: str = "near", threshold: float = THRESHOLD, texts: DataFrame | None = None) -> DataFrame:
    """``(tier, group_id, doc_id)`` by tier.

    ``documents(doc_id, text, raw_checksum, normalized_checksum)``, or with
    ``has_text`` in place of the text and ``texts(doc_id, text)`` beside it, which
    is read for the near tier only; ``exact`` gives the first tier,
    ``normalized`` the first two, ``near`` all.  Documents of an exact group take
    no part in the near tier; those without a text take part in the first alone.
    """
    none = documents.select(F.lit("").alias("tier"), F.col("doc_id").alias("group_id"), "doc_id").where("false")
    if mode == "none":
        return none
    if texts is None:
        texts = documents.select("doc_id", "text")
        # Checksums are costly to derive and cheap to keep; texts are not kept.
        documents = store(documents.select("doc_id", F.col("text").isNotNull().alias("has_text"), "raw_checksum", "normalized_checksum"), "checksums").df
    narrow = documents.select("doc_id", "has_text", "raw_checksum", "normalized_checksum")
    found = exact_memberships(narrow, "raw_checksum", TIERS[0])
    if mode in ("normalized", "near"):
        found = found.unionByName(exact_memberships(narrow.where("has_text"), "normalized_checksum", TIERS[1]))
    if mode == "near":
        exact = store(found, "exact-members")
        found = exact.df
        taken = found.select("doc_id").distinct()
        rest = texts.join(F.broadcast(taken) if exact.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES else taken, "doc_id", "left_anti")
        found = found.unionByName(similar_classes(rest, threshold=threshold).select(F.lit(TIERS[2]).alias("tier"), "group_id", "doc_id"))
    return found


def result_counts(members: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: documents, those skipped for want of a text with their warning, and groups and members of each tier.

    ``documents(doc_id, has_text)``; texts that are null or empty are skipped by
    the near tier.
    """
    sizes = members.groupBy("tier", "group_id").agg(F.count("*").alias("n"))
    of = lambda tier, value: F.coalesce(F.sum(F.when(F.col("tier") == tier, value)), F.lit(0)).cast("long")
    groups = sizes.agg(*[of(t, F.lit(1)).alias(f"{t}_groups") for t in TIERS], *[of(t, F.col("n")).alias(f"{t}_members") for t in TIERS])
    n, skipped = F.count("*").alias("total_documents"), F.count_if(~F.coalesce("has_text", F.lit(False))).alias("documents_skipped")
    warning = F.when(F.col("documents_skipped") > 0, F.concat(F.col("documents_skipped").cast("string"), F.lit(" documents skipped (no normalized text)")))
    return documents.agg(n, skipped).withColumn("warning", warning).crossJoin(groups)


def keep_first(documents: DataFrame, checksum: str, order: list[str]) -> DataFrame:
    """The first row of each checksum in an order; rows without a checksum are all kept."""
    columns = [c for c in documents.columns if c != checksum]
    rank = F.struct(*order, *[c for c in columns if c not in order])
    kept = documents.where(F.col(checksum).isNotNull()).groupBy(checksum).agg(F.min(rank).alias("r")).select(checksum, "r.*")
    return kept.unionByName(documents.where(F.col(checksum).isNull()).select(checksum, *order, *[c for c in columns if c not in order])).select(*documents.columns)
