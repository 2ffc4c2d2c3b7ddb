"""Mixing sources to target weights.

Every source is cut into blocks of about ``BLOCK_TOKENS`` tokens by a hash of
the document.  A mix takes whole passes over a source, then its blocks in a
permuted order until the target is met, the last of them in part: that is the
source's exact quota of block copies.  A splitting tree hands the quotas of all
sources to the output shards: each node splits its shards in half and draws the
left half's share of every source's copies from the multivariate hypergeometric
law, so each shard gets an exact number of copies.  Shards draw disjoint runs of
each source's permuted copies and are shuffled locally.

Every draw of the tree follows from the seed, the mix and the node's shards
alone, and permutations are keyed bijections of numbers.  So each task works out
the nodes that its own copies pass through, and no table of draws, no global
order and no list of blocks reaches the driver or a broadcast.  Collected are
settings, and three numbers for each target.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataform.llm.tokens import token_count
from strataform.runtime import BROADCAST_LIMIT_BYTES, store, trimmed

#: Rows of the table of targets at most; a larger one is refused.
MAX_TARGETS = 10_000

#: Tokens of an output shard, about, and of a block.
SHARD_TOKENS = 20_000_000
BLOCK_TOKENS = 250_000

SHARES = "mix_name string, source string, target_share double, max_repeats int, target_tokens double, available_tokens long, available_rows long"


def source_key(col: Column) -> Column:
    """Sources compare without case and outer blanks; blank ones count as none."""
    return F.nullif(F.lower(trimmed(col)), F.lit(""))


@dataclass
class Quota:
    """What one mix takes of one source."""

    mix: str
    source: str
    share: float
    max_repeats: int
    target: float
    available: int
    rows: int
    blocks: int
    permuted: int = 0  # blocks of the last pass, which is not whole

    @property
    def passes(self) -> int:
        """Whole passes over the source."""
        if not self.available:
            return 0
        return min(self.max_repeats, int(self.target // self.available))

    @property
    def rest(self) -> float:
        """Tokens of the last pass; none where the repeats are used up."""
        return self.target - self.passes * self.available if self.available and self.passes < self.max_repeats else 0.0

    @property
    def copies(self) -> int:
        return self.passes * self.blocks + self.permuted


def _key(*words: object) -> int:
    return int.from_bytes(hashlib.sha256(repr(words).encode()).digest()[:8], "little")


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed bijection of 0 .. size - 1, applied to ``numbers``: a four-round Feistel network.

    Its domain is the next power of four; what falls outside is sent through again.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [np.uint64(_key(key, r)) for r in range(4)]
    out = numbers.astype(np.uint64)
    todo = np.arange(out.size)
    while todo.size:
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in rounds:
            mixed = (right + r) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(40)) & mask
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def node_draw(quotas: np.ndarray, low: int, high: int, key: int) -> np.ndarray:
    """What the left half of a node's shards ``low .. high - 1`` gets of its quotas.

    Shards differ by at most one copy in total, whatever the quotas.
    """
    left, whole = (high - low) // 2, int(quotas.sum())
    # Shard i of n gets whole * (i + 1) // n - whole * i // n copies, so halves nest.
    take = whole * left // (high - low)
    return np.random.default_rng(_key(key, low, high)).multivariate_hypergeometric(quotas, take, method="marginals")


def shards_of(source: np.ndarray, rank: np.ndarray, quotas: list[int], shards: int, key: int) -> np.ndarray:
    """The shard of each copy, given by its source and its rank among that source's copies.

    Descends the splitting tree; only nodes that hold one of the copies are drawn.
    """
    out = np.zeros(source.size, np.int64)
    todo = [(0, shards, np.asarray(quotas, np.int64), np.zeros(len(quotas), np.int64), np.arange(source.size))]
    while todo:
        low, high, quota, start, at = todo.pop()
        if high - low == 1 or not at.size:
            out[at] = low
            continue
        drawn = node_draw(quota, low, high, key)
        goes_left = rank[at] < (start + drawn)[source[at]]
        middle = low + (high - low) // 2
        todo.append((low, middle, drawn, start, at[goes_left]))
        todo.append((middle, high, quota - drawn, start + drawn, at[~goes_left]))
    return out


def read_targets(targets: DataFrame) -> list[tuple[str, str, float, int, float]]:
    """``(mix, source, share, max_repeats, budget_fraction)``.

    Rows without mix, source or a positive share are left out; a source that a
    mix names twice has its shares added and the larger cap.  A missing cap
    counts as one.  A mix's budget is the largest its rows name, 0 if none.
    """
    rows = targets.select("mix_name", source_key(F.col("source")).alias("source"), "target_share", "max_repeats", "budget_fraction")
    rows = rows.where("mix_name is not null and source is not null and target_share > 0")
    found = rows.groupBy("mix_name", "source").agg(F.sum("target_share").alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("cap"), F.max("budget_fraction").alias("budget"))
    taken = found.orderBy("mix_name", "source").limit(MAX_TARGETS + 1).collect()
    if len(taken) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    budget: dict[str, float] = {}
    for r in taken:
        budget[r.mix_name] = max(budget.get(r.mix_name, 0.0), r.budget or 0.0)
    return [(r.mix_name, r.source, r.share, max(0, r.cap), budget[r.mix_name]) for r in taken]


class Mixture:
    """A planned mixture of ``documents(doc_id, source, text)``.

    Null sources count in the total but are drawn by no mix; a source without
    tokens is short of any target.  Rows with the same id are texts of their own
    in the same block; without an id the text names the block.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, seed: int = 0, shard_tokens: int = SHARD_TOKENS, block_tokens: int = BLOCK_TOKENS):
        self.spark, self.seed = documents.sparkSession, seed
        rows = read_targets(targets)
        key = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(seed))).otherwise(F.xxhash64("doc_id", F.lit(seed)))
        narrow = documents.select("doc_id", source_key(F.col("source")).alias("source"), token_count(F.col("text")).alias("n_tokens"), key.alias("key"))
        self.sized = store(narrow, "sized").df
        named = self.spark.createDataFrame([(s,) for s in sorted({r[1] for r in rows})], "name string")
        # One row for each named source and one for all others.
        sums = self.sized.join(F.broadcast(named), F.col("source") == F.col("name"), "left").groupBy("name").agg(F.sum("n_tokens").alias("n"), F.count_if(F.col("n_tokens") > 0).alias("rows"))
        sizes = {r.name: (r.n, r.rows) for r in sums.collect()}
        total = sum(n for n, _ in sizes.values())
        mixes = sorted({r[0] for r in rows})
        weight = {m: sum(r[2] for r in rows if r[0] == m) for m in mixes}
        blocks = {s: -(-n // block_tokens) for s, (n, _) in sizes.items() if s is not None}
        self.quotas = [Quota(mix, s, share / weight[mix], cap, share / weight[mix] * budget * total, *sizes.get(s, (0, 0)), blocks.get(s, 0)) for mix, s, share, cap, budget in rows]
        cut = self.spark.createDataFrame([(s, n) for s, n in blocks.items() if n], "source string, blocks long")
        # Bounded by the number of targets.
        self.blocked = self.sized.where("n_tokens > 0").join(F.broadcast(cut), "source").select("source", "doc_id", "n_tokens", "key", F.pmod("key", "blocks").alias("block"))
        self.blocks = store(self.blocked.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks").df
        self.last = self._last_passes()
        for r in self.last.df.where("tokens_before < rest").groupBy("target").agg(F.max("place").alias("place")).collect():
            self.quotas[r.target].permuted = r.place + 1
        self.shards = {m: max(1, round(sum(q.target for q in self.quotas if q.mix == m) / shard_tokens)) for m in mixes}

    def _numbered(self, kind: str, rows: list[tuple]) -> DataFrame:
        """A small table about the targets, which are numbered as ``quotas`` is; marked for broadcast."""
        return F.broadcast(self.spark.createDataFrame(rows, f"target int, {kind}"))

    def _last_passes(self):
        """``(target, source, block, tokens, place, tokens_before, rest)``: every block of every target's last pass.

        ``place`` is the block's place in the target's permuted order, and
        ``tokens_before`` what stands before it.  The running sum is taken within
        runs of about the square root of the blocks, and over the runs.
        """
        facts = [(i, q.source, q.rest, q.blocks) for i, q in enumerate(self.quotas) if q.rest > 0]
        each = self.blocks.join(self._numbered("source string, rest double, blocks long", facts), "source")
        keys, blocks = {i: _key(self.seed, q.mix, q.source) for i, q in enumerate(self.quotas)}, {i: q.blocks for i, q in enumerate(self.quotas)}

        def place(target: np.ndarray, block: np.ndarray) -> np.ndarray:
            return _by_group(target, lambda t, at: permuted(block[at], blocks[t], keys[t]))

        placed = _with_column(each.select("target", "source", "block", "tokens", "rest", "blocks"), ("target", "block"), "place", place)
        stored = store(placed.withColumn("run", F.floor(F.col("place") / F.ceil(F.sqrt("blocks"))).cast("long")), "last-passes")
        runs = stored.df.groupBy("target", "run").agg(F.sum("tokens").alias("run_tokens"))
        before = lambda c, w: F.sum(c).over(w) - F.col(c)
        runs = runs.select("target", "run", before("run_tokens", Window.partitionBy("target").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)).alias("runs_before"))
        within = Window.partitionBy("target", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        summed = stored.df.withColumn("here", before("tokens", within)).join(runs, ["target", "run"])
        out = store(summed.select("target", "source", "block", "tokens", "place", (F.col("here") + F.col("runs_before")).alias("tokens_before"), "rest"), "last-passes")
        stored.drop()
        return out

    def draws(self) -> DataFrame:
        """``(target, source, block, repeat_no, part_tokens, shard)``: every block copy that a mix draws.

        ``part_tokens`` is null for a block taken whole.
        """
        quotas = self.quotas
        passes = self._numbered("source string, passes int, blocks long", [(i, q.source, q.passes, q.blocks) for i, q in enumerate(quotas) if q.passes])
        whole = self.blocks.join(passes, "source").select("target", "source", "block", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("repeat_no"), F.lit(None).cast("double").alias("part_tokens"), (F.col("repeat_no") * F.col("blocks") + F.col("block")).alias("number"))
        firsts = self._numbered("last int, done long", [(i, q.passes, q.passes * q.blocks) for i, q in enumerate(quotas) if q.rest > 0])
        left = F.col("rest") - F.col("tokens_before")
        last = self.last.df.where("tokens_before < rest").join(firsts, "target")
        last = last.select("target", "source", "block", F.col("last").alias("repeat_no"), F.when(F.col("tokens") > left, left).alias("part_tokens"), (F.col("done") + F.col("place")).alias("number"))
        mixes = sorted(self.shards)
        members = {m: [i for i, q in enumerate(quotas) if q.mix == m] for m in mixes}
        mix_of = np.array([mixes.index(q.mix) for q in quotas])
        place_of = np.array([members[q.mix].index(i) for i, q in enumerate(quotas)])
        copies, shards, seed = [q.copies for q in quotas], self.shards, self.seed
        keys = [_key(seed, q.mix, q.source, "copies") for q in quotas]

        def shard(target: np.ndarray, number: np.ndarray) -> np.ndarray:
            rank = _by_group(target, lambda t, at: permuted(number[at], copies[t], keys[t]))
            return _by_group(mix_of[target], lambda m, at: shards_of(place_of[target[at]], rank[at], [copies[i] for i in members[mixes[m]]], shards[mixes[m]], _key(seed, mixes[m])))

        return _with_column(whole.unionByName(last), ("target", "number"), "shard", shard).drop("number")

    def _taken(self) -> DataFrame:
        """``(target, source, doc_id, n_tokens, repeat_no, shard)``.

        A block taken in part gives documents in a hashed order until half of
        the next one would be too much.
        """
        draws = store(self.draws(), "draws")
        # One row for each block copy; beyond the limit they are joined by a shuffle.
        # A block has about BLOCK_TOKENS, so no key of that join is hot.
        copies = F.broadcast(draws.df) if draws.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES else draws.df
        taken = self.blocked.join(copies, ["source", "block"])
        columns = ["target", "source", "doc_id", "n_tokens", "repeat_no", "shard"]
        order = Window.partitionBy("target", "block").orderBy(F.xxhash64("key", F.lit(self.seed + 1)), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
        part = taken.where("part_tokens is not null").withColumn("upto", F.sum("n_tokens").over(order)).where(F.col("upto") - F.col("n_tokens") / 2 <= F.col("part_tokens"))
        return taken.where("part_tokens is null").select(*columns).unionByName(part.select(*columns))

    def drawn(self) -> DataFrame:
        """``(mix_name, source, doc_id, n_tokens, repeat_no, shard, position)``; positions order a shard at random."""
        named = self._numbered("mix_name string", [(i, q.mix) for i, q in enumerate(self.quotas)])
        shuffled = Window.partitionBy("mix_name", "shard").orderBy(F.xxhash64("doc_id", "source", "repeat_no", F.lit(self.seed + 2)), "doc_id", "source", "repeat_no", "n_tokens")
        return self._taken().join(named, "target").select("mix_name", "source", "doc_id", "n_tokens", "repeat_no", "shard", F.row_number().over(shuffled).alias("position"))

    def shares(self) -> DataFrame:
        """The plan and what was drawn, for each mix and source.

        A source is ``short`` where all its repeats were drawn and yet its target
        was not reached.
        """
        plan = self._numbered(SHARES, [(i, q.mix, q.source, q.share, q.max_repeats, q.target, q.available, q.rows) for i, q in enumerate(self.quotas)])
        got = self._taken().groupBy("target").agg(F.sum("n_tokens").alias("drawn_tokens"), F.count("*").alias("drawn_rows"), (F.max("repeat_no") + 1).alias("repeats"))
        joined = plan.join(got, "target", "left").fillna(0, ["drawn_tokens", "drawn_rows", "repeats"])
        whole = F.sum("drawn_tokens").over(Window.partitionBy("mix_name"))
        used_up = F.col("drawn_rows") == F.col("available_rows") * F.col("max_repeats")
        return joined.select(
            *[c.split()[0] for c in SHARES.split(", ")], (used_up & (F.col("drawn_tokens") < F.col("target_tokens"))).alias("short"), "drawn_tokens", "drawn_rows", "repeats",
            F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(0.0).alias("actual_share"),
        )


def _by_group(group: np.ndarray, of: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """``of(g, where)`` for the places of each group, put together again."""
    out = np.zeros(group.size, np.int64)
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        out[at] = of(int(g), at)
    return out


def _with_column(rows: DataFrame, inputs: tuple[str, str], name: str, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Add a column of numbers computed from two columns, a batch at a time."""
    names = [*rows.columns, name]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(rows_at).to_numpy(zero_copy_only=False) for rows_at in places)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of(first, second), pa.int64())], names=names)

    places = [rows.columns.index(c) for c in inputs]
    return rows.mapInArrow(add, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", `{name}` long")


def short_sources(shares: DataFrame) -> DataFrame:
    """``(mix_name, source)`` of the sources too small for their target."""
    return shares.where("short").select("mix_name", "source")


def invariants(mixture: Mixture) -> DataFrame:
    """``(mix_name, source, target_tokens, available_tokens, short, off_target, drawn_too_often, uneven_shards)``; the last three are false or 0.

    A source that is not short is off its target if what was drawn differs from
    it by more than the longest text; a shard is uneven if it has over one block
    copy more than its share.
    """
    shares = store(mixture.shares(), "shares").df
    longest = mixture.sized.agg(F.max("n_tokens")).first()[0] or 0
    often = mixture.drawn().where("doc_id is not null").groupBy("mix_name", "source", "doc_id", "repeat_no").agg(F.count("*").alias("n")).where("n > 1").groupBy("mix_name", "source").agg(F.count("*").alias("drawn_too_often"))
    numbered = mixture._numbered("mix_name string", [(i, q.mix) for i, q in enumerate(mixture.quotas)])
    each = mixture.draws().join(numbered, "target").groupBy("mix_name", "shard").agg(F.count("*").alias("n"))
    copies = {m: sum(q.copies for q in mixture.quotas if q.mix == m) / n for m, n in mixture.shards.items()}
    most = mixture.spark.createDataFrame([(m, float(c)) for m, c in copies.items()], "mix_name string, share double")
    uneven = each.join(F.broadcast(most), "mix_name").groupBy("mix_name").agg(F.count_if(F.col("n") > F.col("share") + 1).alias("uneven_shards"))
    off = ~F.col("short") & (F.abs(F.col("drawn_tokens") - F.col("target_tokens")) > longest)
    joined = shares.join(often, ["mix_name", "source"], "left").join(uneven, "mix_name", "left").fillna(0, ["drawn_too_often", "uneven_shards"])
    return joined.select("mix_name", "source", (F.floor(F.col("target_tokens") * 1000 + 0.5) / 1000).alias("target_tokens"), "available_tokens", "short", off.alias("off_target"), "drawn_too_often", "uneven_shards")
