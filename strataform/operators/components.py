"""Connected components: one group for all records linked directly or indirectly.

Minimum labels travel along the edges and are accelerated by pointer jumping.
Each round hooks every node to its least neighbour, jumps the pointers, relabels
the edges by the labels reached and keeps those that still join two labels; every
round is written to the shared folder.  The loop ends when no edge is left, that
is when no label changes.

Least is meant by a hash of the node.  Whatever the ids, a node with neighbours
is the least of its neighbourhood with a probability of at most a half, so in
expectation a round with a new hash at least halves the nodes that still have
edges.  (By the ids themselves it need not: a star whose centre has the largest
id keeps all its leaves.)  Every hash serves two rounds: a star's leaves find in
the second the one that their centre was hooked to in the first.  The smallest
id of a group names it in the end.

Edges that are too many for one task are thinned first: a task keeps of those it
reads only what joins the same nodes, so dense groups shrink to about their nodes.

Once the edges left are few, a count that is measured and bounded, one task
finishes them by the same rule in memory.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.runtime import BROADCAST_LIMIT_BYTES, Stored, hot_rows, lookup_join, store

#: Edges that one task finishes in memory, at most.
FINISH_EDGES = 250_000

#: Jumps of the pointers in a round.
JUMPS = 2


def _priority(name: str, turn: int) -> Column:
    return F.struct(F.xxhash64(name, F.lit(turn // 2)).alias("order"), F.col(name).alias("node"))


def _hook(edges: DataFrame, turn: int) -> DataFrame:
    """``(id, label, degree)``: every node with the least of its neighbours and itself."""
    both = edges.select(F.col("u").alias("id"), F.col("v").alias("other")).unionByName(edges.select(F.col("v").alias("id"), F.col("u").alias("other")))
    least = both.groupBy("id").agg(F.min(_priority("other", turn)).alias("least"), F.count("*").alias("degree"))
    return least.select("id", F.least(F.col("least"), _priority("id", turn))["node"].alias("label"), "degree")


def _through(rows: DataFrame, key: str, table: Stored, id_column: str, value: str, counts: DataFrame | None, total: int) -> DataFrame:
    """Replace ``rows[key]`` by ``table``'s value for it, all keys being in the table.

    A table of measured small size is broadcast.  A larger one is joined by a
    shuffle, its hot keys apart: ``counts(id, n)`` says how many rows hold a key.
    """
    pairs = table.df.select(F.col(id_column).alias(key), F.col(value).alias("_to"))
    if table.size_bytes() <= BROADCAST_LIMIT_BYTES // 4:
        joined = rows.join(F.broadcast(pairs), key)
    else:
        if counts is None:
            counts = rows.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
        hot = store(hot_rows(counts, "n", total).select(F.col("id").alias(key)), "hot").df
        joined = lookup_join(rows, key, pairs, key, pairs.join(F.broadcast(hot), key, "left_semi"))
    return joined.drop(key).withColumnRenamed("_to", key)


def least_labels(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The least node that each of ``nodes`` numbered nodes reaches: hook and jump until nothing changes."""
    label = np.arange(nodes)
    while u.size:
        low, high = np.minimum(u, v), np.maximum(u, v)
        np.minimum.at(label, high, low)
        while not np.array_equal(label[label], label):
            label = label[label]
        u, v = label[u], label[v]
        apart = u != v
        u, v = u[apart], v[apart]
    return label


def _labelled(rows: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray]:
    """The nodes of the edges in ``rows``, and for each the place of the one that labels its group."""
    ends = [pa.chunked_array([b.column(i) for b in rows]).combine_chunks() for i in (0, 1)]
    names = pc.unique(pa.chunked_array(ends))
    at = [pc.index_in(e, names).to_numpy(zero_copy_only=False).astype(np.int64) for e in ends]
    return names, least_labels(at[0], at[1], len(names))


def _forest(edges: DataFrame, most: int) -> DataFrame:
    """Edges ``(u, v)`` that join the same nodes: of every ``most`` or so that a task reads, one for each node but one of a group."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(b.num_rows for b in held) >= most):
                names, label = _labelled(held)
                led = np.flatnonzero(label != np.arange(label.size))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(label[led])), names.take(pa.array(led))], names=["u", "v"])
                held = []

    found = edges.select("u", "v").mapInArrow(run, f"u {kind}, v {kind}")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _finish(edges: DataFrame) -> DataFrame:
    """``(id, label)`` of the nodes of a bounded number of edges, worked out in one task."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        names, label = _labelled(rows)
        yield pa.RecordBatch.from_arrays([names, names.take(pa.array(label))], names=["id", "label"])

    return edges.select("u", "v").coalesce(1).mapInArrow(run, f"id {kind}, label {kind}")


def connected_components(edges: DataFrame, finish_edges: int = FINISH_EDGES, least_rounds: int = 0, rounds: list[int] | None = None) -> DataFrame:
    """``(group_id, id)`` for every node of ``edges(u, v)``; the group id is the smallest id reached.

    An empty table gives an empty result.  Null ends and a node paired with
    itself link nothing; repeated and turned edges count once.  At least
    ``least_rounds`` rounds run before one task finishes the edges left, if they
    are few enough.  ``rounds``, if given, receives the number of nodes with edges
    before each round.
    """
    ends = F.col("u") < F.col("v")
    known = edges.where("u <> v").select(F.when(ends, F.col("u")).otherwise(F.col("v")).alias("u"), F.when(ends, F.col("v")).otherwise(F.col("u")).alias("v"))
    current = store(known.distinct(), "edges", counted=True)
    levels: list[Stored] = []
    if not least_rounds and 0 < finish_edges < current.rows:
        # Where groups are dense, few of their edges are needed.
        thinned = store(_forest(current.df, finish_edges).distinct(), "edges", counted=True)
        current.drop()
        current = thinned
    while current.rows:
        turn = len(levels)
        if turn >= least_rounds and current.rows <= finish_edges:
            levels.append(store(_finish(current.df), "finished", counted=True))
            break
        hook = store(_hook(current.df, turn), "hook", counted=True)
        if rounds is not None:
            rounds.append(hook.rows)
        degrees = hook.df.select("id", F.col("degree").alias("n"))
        jumped = hook
        for _ in range(JUMPS):
            following = store(_through(jumped.df.select("id", "label"), "label", jumped, "id", "label", None, hook.rows).select("id", "label"), "jump", counted=True)
            if jumped is not hook:
                jumped.drop()
            jumped = following
        n = 2 * current.rows
        moved = _through(_through(current.df, "u", jumped, "id", "label", degrees, n), "v", jumped, "id", "label", degrees, n)
        following = store(moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges", counted=True)
        current.drop()
        hook.drop()
        current, levels = following, [*levels, jumped]
    if not levels:
        return current.df.select(F.col("u").alias("group_id"), F.col("v").alias("id"))
    # Compose the rounds from the last to the first: a label of one round is a
    # node of the next, or the final label when it has no edge left.
    final = levels[-1]
    for level in reversed(levels[:-1]):
        rows = level.df.select("id", "label")
        ends = rows.select(F.col("label").alias("node")).distinct().join(final.df.select(F.col("id").alias("node"), F.col("label").alias("to")), "node", "left")
        table = store(ends.select(F.col("node").alias("id"), F.coalesce("to", "node").alias("label")), "labels")
        composed = store(_through(rows, "label", table, "id", "label", None, level.rows), "composed", counted=True)
        for used in (final, level, table):
            used.drop()
        final = composed
    named = store(final.df.groupBy("label").agg(F.min("id").alias("group_id"), F.count("*").alias("n")), "named")
    counts = named.df.select(F.col("label").alias("id"), "n")
    out = _through(final.df.select("id", "label"), "label", named, "label", "group_id", counts, final.rows)
    return out.select(F.col("label").alias("group_id"), "id")
