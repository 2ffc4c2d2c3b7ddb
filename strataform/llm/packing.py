"""Filling fixed-capacity containers by bounded-space online best-fit.

The documents are spread evenly over shards by a hash of their id; each shard
packs its stream online, holding a fixed number of open containers.  The open
containers are found through a bitset keyed by free space: the lowest set bit at
or above an item's size is the best fit.  When an item fits nowhere and all
containers are open, the fullest one closes.  Only ids and sizes are shuffled.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.llm.tokens import token_count
from strataform.runtime import store

#: Containers that stay open in a shard; the more, the better the fit.
OPEN_CONTAINERS = 64

#: Items of one shard, about; a shard leaves at most OPEN_CONTAINERS part-filled.
SHARD_ITEMS = 100_000

#: Specs are packed in one pass, so their number is bounded.
MAX_SPECS = 1_000

ASSIGNMENT = "spec_name string, doc_id long, piece_no int, token_start long, n_tokens long, doc_tokens long, container_id long"


class Shelf:
    """The open containers of one spec in one shard."""

    def __init__(self, capacity: int, open_containers: int, first_id: int):
        self.capacity, self.most, self.next_id = capacity, open_containers, first_id
        self.free_bits, self.by_free, self.open = 0, {}, 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        container = held.pop()
        if not held:
            self.free_bits &= ~(1 << free)
        self.open -= 1
        return container

    def place(self, size: int) -> int:
        """The container for an item of 1 to ``capacity`` tokens."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            container = self._take(free)
        else:
            if size < self.capacity and self.open >= self.most:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            free, container = self.capacity, self.next_id
            self.next_id += 1
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(container)
            self.free_bits |= 1 << left
            self.open += 1
        return container


def sized(documents: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens)`` of every document with an id; null texts have none."""
    return documents.where("doc_id is not null").select("doc_id", token_count(F.col(text)).alias("n_tokens"))


def read_specs(specs: DataFrame, size: str, *more: str) -> list[tuple]:
    """The valid rows of a small table of settings: named, with a positive size."""
    rows = specs.where(F.col("spec_name").isNotNull() & (F.col(size) > 0)).select("spec_name", size, *more).distinct()
    taken = rows.orderBy("spec_name", size, *more).limit(MAX_SPECS + 1).collect()
    if len(taken) > MAX_SPECS:
        raise ValueError(f"more than {MAX_SPECS} specs")
    return [tuple(r) for r in taken]


def pack(items: DataFrame, specs: list[tuple[str, int]], open_containers: int = OPEN_CONTAINERS, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Assign every item to a container of each spec.

    ``items(doc_id, n_tokens)`` are whole texts.  An item larger than the
    capacity is cut into full pieces and a rest; nothing else is cut.  An item
    without tokens takes no space and gets a null container.  Container ids are
    unique within a spec.  Rows with the same id are items of their own.
    """
    stored = store(items.select("doc_id", "n_tokens"), "sized").df
    shards = max(1, -(-stored.count() // shard_items))
    sharded = stored.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("n_tokens", "ascending")])
        # A fixed scramble keeps neighbouring ids, often alike in size, apart.
        pairs = sorted(zip(table["doc_id"].to_pylist(), table["n_tokens"].to_pylist(), strict=True), key=lambda x: ((x[0] * 0x9E3779B97F4A7C15 & (1 << 64) - 1), x))
        first = table["shard"][0].as_py() << 40 if len(table) else 0
        out: list[list] = [[] for _ in range(7)]
        name_of, doc, piece, start, tokens, total, where = out
        for name, capacity in specs:
            shelf = Shelf(capacity, open_containers, first)
            for doc_id, n in pairs:
                at = number = 0
                while True:
                    size = min(capacity, n - at)
                    name_of.append(name)
                    doc.append(doc_id)
                    piece.append(number)
                    start.append(at)
                    tokens.append(size)
                    total.append(n)
                    where.append(shelf.place(size) if size else None)
                    at, number = at + size, number + 1
                    if at >= n:
                        break
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["spec_name", "doc_id", "piece_no", "token_start", "n_tokens", "doc_tokens", "container_id"])

    return sharded.groupBy("shard").applyInArrow(fill, ASSIGNMENT)


def pack_documents(documents: DataFrame, container_specs: DataFrame) -> DataFrame:
    """``pack`` of all documents into the containers of each row of ``container_specs``."""
    return pack(sized(documents), read_specs(container_specs, "capacity_tokens"))


def oversized(assignment: DataFrame) -> DataFrame:
    """``(spec_name, doc_id)`` of the documents that had to be cut."""
    return assignment.where("piece_no = 1").select("spec_name", "doc_id").distinct()


def fill_report(assignment: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """Containers, tokens and fill rate of each spec."""
    used = assignment.where("container_id is not null").groupBy("spec_name", "container_id").agg(F.sum("n_tokens").alias("used"))
    totals = used.groupBy("spec_name").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    capacity = F.create_map(*[F.lit(x) for spec in specs for x in spec])
    return totals.withColumn("fill_rate", F.col("tokens") / (F.col("containers") * capacity[F.col("spec_name")]))


def invariants(assignment: DataFrame, specs: list[tuple[str, int]]) -> DataFrame:
    """``(spec_name, documents, tokens, overfull, needless_cuts)`` of each spec; the last two are 0."""
    capacity = F.create_map(*[F.lit(x) for spec in specs for x in spec])[F.col("spec_name")]
    pieces = assignment.groupBy("spec_name").agg(
        F.count_if(F.col("piece_no") == 0).alias("documents"), F.sum("n_tokens").alias("tokens"), F.count_if((F.col("piece_no") > 0) & (F.col("doc_tokens") <= capacity)).alias("needless_cuts")
    )
    used = assignment.where("container_id is not null").groupBy("spec_name", "container_id").agg(F.sum("n_tokens").alias("used"))
    overfull = used.groupBy("spec_name").agg(F.count_if(F.col("used") > capacity).alias("overfull"))
    return pieces.join(overfull, "spec_name", "left").select("spec_name", "documents", "tokens", F.coalesce("overfull", F.lit(0)).cast("long").alias("overfull"), "needless_cuts")
