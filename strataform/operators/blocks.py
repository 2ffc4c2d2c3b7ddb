"""All similar pairs of sets, block against block, where buckets would hold most of the collection.

Sets become ascending codes: the place of a trigram when trigrams are ordered by
how many sets hold it.  Trigrams of one set alone can be common to no two sets and
get no code, though they count for a set's size.  Codes are written once, as their
differences in a byte or two each, in blocks of sets of like size; one task reads
two blocks and compares what their sizes allow.  Nothing is shuffled for it.

A task multiplies sketches: codes are added with random signs into ``WIDTH``
places, the frequent ones each in a place of its own, so that products of two
sketches are the number of common codes and noise from codes that share a place.
What may reach the threshold within ``DEVIATIONS`` of that noise is counted on
the codes themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Places of a sketch.
WIDTH = 2048
#: Deviations of a pair's noise that it may lie under the threshold; 4 are exceeded by chance 3 times in 100,000.
DEVIATIONS = 4.5
#: Characters turned into trigrams at a time.
PORTION = 4_000_000
#: Sets and codes of a block, about.
BLOCK_SETS, BLOCK_CODES = 25_000, 25_000_000
#: Rows compared at a time with all of a block, and padded codes held together.
TILE_ROWS, TILE_CODES = 512, 16_000_000


def trigram_keys(texts: list[str]) -> list[np.ndarray]:
    """The distinct trigrams of each text in ascending order, 21 bits a character."""
    lengths = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    keys = points[:-2] | (points[1:-1] << np.uint64(21)) | (points[2:] << np.uint64(42))
    ends = np.cumsum(lengths)
    return [np.unique(keys[e - n : e - 2]).view(np.int64) if n > 2 else np.empty(0, np.int64) for n, e in zip(lengths, ends)]


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """From batches of ``(id, flat text)`` the ids and trigrams of the texts that have any, a bounded number at a time."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PORTION, "right")))
            part = batch.slice(at, to - at)
            keys = trigram_keys([t or "" for t in part.column(1).to_pylist()])
            filled = [i for i, k in enumerate(keys) if k.size]
            if filled:
                yield part.column(0).take(pa.array(filled)), [keys[i] for i in filled]
            at = to


def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts ``(key, n)`` of the sets that hold a trigram."""
    for _, keys in portions(batches):
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["key", "n"])


def pack(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 as bytes, seven bits each, the last with its top bit set."""
    v = values.astype(np.uint64)
    size = np.ones(v.size, np.int64)
    for bits in range(7, 63, 7):
        size += v >= np.uint64(1 << bits)
    ends = np.cumsum(size)
    out, starts = np.zeros(int(ends[-1]) if v.size else 0, np.uint8), ends - size
    for k in range(int(size.max()) if v.size else 0):
        own = size > k
        out[starts[own] + k] = (v[own] >> np.uint64(7 * k)) & np.uint64(127)
    out[ends - 1] |= 128
    return out


def unpack(packed: np.ndarray) -> np.ndarray:
    """What ``pack`` was given."""
    last = packed >= 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1]) if ends.size else ends
    size, low = ends - starts + 1, (packed & 127).astype(np.int64)
    out = low[starts]
    for k in range(1, int(size.max()) if ends.size else 0):
        own = size > k
        out[own] |= low[starts[own] + k] << (7 * k)
    return out


def encoder(known: np.ndarray, whole: bool):
    """From batches of ``(id, flat text)`` each set's size, class and packed codes.

    ``known`` has the trigrams by falling count.  Unless it is ``whole``, those it
    lacks may still be common to two sets and stay in ``rare`` as they are.
    """
    order = np.argsort(known)
    ascending = known[order]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys in portions(batches):
            flat, n = np.concatenate(keys), np.array([k.size for k in keys])
            row = np.repeat(np.arange(n.size), n)
            at = np.minimum(np.searchsorted(ascending, flat), max(0, ascending.size - 1))
            has = ascending[at] == flat if ascending.size else np.zeros(flat.size, bool)
            code, owner = order[at[has]] if ascending.size else np.empty(0, np.int64), row[has]
            # Sets one after the other, codes ascending in each.
            joined = np.sort((owner.astype(np.int64) << 32) | code)
            owner, code = joined >> 32, joined & 0xFFFFFFFF
            step = np.diff(code, prepend=0)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            step[first] = code[first]
            packed = pack(step)
            # The bytes of a set end where its last code does.
            ends = np.concatenate([[0], np.flatnonzero(packed >= 128) + 1])[np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n.size))])]
            rare = row[~has] if not whole else np.empty(0, np.int64)
            left = pa.array(flat[~has] if not whole else np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rare, minlength=n.size))]).astype(np.int32)
            columns = [
                ids,
                pa.array(n.astype(np.int32)),
                pa.array([xxhash.xxh3_128_digest(k.tobytes()) for k in keys], pa.binary()),
                pa.array([packed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), left),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class", "codes", "rare"])

    return encode


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of bytes or lists one after the other, and where each row's begin and the last one's end."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2] if pa.types.is_binary(column.type) else None
    values = column.values.to_numpy() if pa.types.is_list(column.type) else np.frombuffer(held, kind) if held else np.empty(0, kind)
    return values[ends[0] : ends[-1]], ends - ends[0]


class Sets:
    """Sets of a task, ordered by block and size: ids, sizes and codes, one set after the other."""

    def __init__(self, batches: list[pa.RecordBatch], known: int):
        table = pa.Table.from_batches(batches)
        table = table.take(pc.sort_indices(table, sort_keys=[("block", "ascending"), ("n", "ascending")]))
        self.ids, self.n, self.block = table.column("id").combine_chunks(), table.column("n").to_numpy().astype(np.int64), table.column("block").to_numpy()
        packed, ends = _flat(table.column("codes").combine_chunks(), np.uint8)
        parts, sizes = [], []
        for at in range(0, table.num_rows, TILE_ROWS):
            to = min(table.num_rows, at + TILE_ROWS)
            own = packed[ends[at] : ends[to]]
            size = np.diff(np.concatenate([[0], np.cumsum(own >= 128)])[ends[at : to + 1] - ends[at]])
            total = np.concatenate([[0], np.cumsum(unpack(own))])
            before = total[np.concatenate([[0], np.cumsum(size)[:-1]])]
            parts.append((total[1:] - np.repeat(before, size)).astype(np.int32))
            sizes.append(size)
        codes, size = np.concatenate(parts), np.concatenate(sizes)
        rare, ends = _flat(table.column("rare").combine_chunks(), np.int64)
        self.known = known
        if rare.size:
            # Trigrams without a code get one that holds in this task.
            own, lengths = np.unique(rare), np.diff(ends)
            row = np.concatenate([np.repeat(np.arange(size.size), size), np.repeat(np.arange(size.size), lengths)])
            codes = np.concatenate([codes, known + np.searchsorted(own, rare)])[np.argsort(row, kind="stable")].astype(np.int32)
            self.known, size = known + own.size, size + lengths
        self.codes, self.starts = codes, np.concatenate([[0], np.cumsum(size)])
        rng = np.random.default_rng(7)
        self.sign = rng.choice(np.array([-1, 1], np.int8), self.known)

    def sketch(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of some rows with three places left free, and the square root of the deviation of the noise in each with its like."""
        sums, noise = np.empty((high - low, WIDTH + 3), np.float32), np.empty(high - low)
        for at in range(low, high, TILE_ROWS):
            to = min(high, at + TILE_ROWS)
            code, cells = self.codes[self.starts[at] : self.starts[to]], (to - at) * WIDTH
            place = np.repeat(np.arange(to - at) * WIDTH, np.diff(self.starts[at : to + 1])) + code % WIDTH
            sums[at - low : to - low, :WIDTH] = np.bincount(place, self.sign[code], cells).reshape(-1, WIDTH)
            held = np.bincount(place, minlength=cells).reshape(-1, WIDTH)
            noise[at - low : to - low] = (2.0 * (held * (held - 1)).sum(1)) ** 0.25
        return sums, noise

    def padded(self, low: int, high: int) -> list[tuple[int, int, np.ndarray]]:
        """Rows of codes in runs of like size, filled to whole words with a code that no set has."""
        out = []
        while low < high:
            size = np.diff(self.starts[low : high + 1])
            most = np.maximum.accumulate(size)
            wide = (most > 1.5 * most[0] + 8) | (most * np.arange(1, size.size + 1) > TILE_CODES)
            run = max(1, int(wide.argmax()) if wide.any() else size.size)
            rows = np.full((run, max(8, -(-int(most[run - 1]) // 8) * 8)), self.known, np.int32)
            rows[np.arange(rows.shape[1])[None, :] < size[:run, None]] = self.codes[self.starts[low] : self.starts[low + run]]
            out.append((low, low + run, rows))
            low += run
        return out


def compare(sets: Sets, threshold: float, linked: bool, alone: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(i, j, similarity)`` of the sets of two blocks, or of one ``alone``, that reach the threshold.

    ``linked`` leaves out pairs whose sets earlier ones have linked already.
    """
    n, share = sets.n, threshold / (1 + threshold)
    begin = 0 if alone else int(np.searchsorted(sets.block, sets.block[-1]))
    if not alone and not begin:
        return
    mark, label = np.zeros(sets.known + 1, np.uint8), np.arange(n.size)
    members: dict[int, list[int]] = {}
    # Products of these rows and those below are what the threshold lacks at most.
    right, noise = sets.sketch(begin, n.size)
    right[:, WIDTH:] = np.column_stack([np.ones(n.size - begin), n[begin:], noise])
    runs = sets.padded(begin, n.size)
    for top in range(0, n.size if alone else begin, TILE_ROWS):
        end = min(top + TILE_ROWS, n.size if alone else begin)
        low, high = max(begin, top), begin + int(np.searchsorted(n[begin:], n[end - 1] / threshold + 1e-6, "right"))
        if low >= high:
            continue
        left, noise = sets.sketch(top, end)
        left[:, WIDTH:] = np.column_stack([-share * n[top:end], np.full(end - top, -share), DEVIATIONS * noise])
        likely = left @ right[low - begin : high - begin].T >= -0.05
        if alone:
            likely &= np.arange(top, end)[:, None] < np.arange(low, high)[None, :]
        for own, row in zip(range(top, end), likely):
            others = low + np.flatnonzero(row)
            if linked:
                others = others[label[others] != label[own]]
            if not others.size:
                continue
            codes = sets.codes[sets.starts[own] : sets.starts[own + 1]]
            mark[codes] = 1
            common = []
            for first, last, padded in runs:
                some = others[np.searchsorted(others, first) : np.searchsorted(others, last)]
                if some.size:
                    common.append(np.bitwise_count(mark[padded[some - first]].view(np.uint64)).sum(1, dtype=np.int64))
            mark[codes] = 0
            common = np.concatenate(common)
            similarity = common / (n[own] + n[others] - common)
            near = similarity >= threshold
            found, similarity = others[near], similarity[near]
            if linked and found.size:
                groups, once = np.unique(label[found], return_index=True)
                found, similarity = found[once], similarity[once]
                held = [members.pop(g, [g]) for g in (*groups.tolist(), int(label[own]))]
                # All take the label of the largest group.
                largest = max(held, key=len)
                to = int(label[largest[0]])
                for other in held:
                    if other is not largest:
                        label[other] = to
                        largest.extend(other)
                members[to] = largest
            if found.size:
                yield np.full(found.size, own), found, similarity


def comparer(threshold: float, known: int, linked: bool):
    """From the batches of ``(id, n, codes, rare, block, alone)`` of two blocks, or of one alone, ``(a, b, similarity)`` with ``a < b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        sets, alone = Sets(rows, known), rows[0].column("alone")[0].as_py()
        held, count = [], 0

        def batch() -> pa.RecordBatch:
            i, j, similarity = (np.concatenate(x) for x in zip(*held))
            a, b = sets.ids.take(pa.array(i)), sets.ids.take(pa.array(j))
            turned = pc.greater(a, b)
            return pa.RecordBatch.from_arrays([pc.if_else(turned, b, a), pc.if_else(turned, a, b), pa.array(similarity)], names=["a", "b", "similarity"])

        for found in compare(sets, threshold, linked, alone):
            held.append(found)
            count += found[0].size
            if count >= 100_000:
                yield batch()
                held, count = [], 0
        if held:
            yield batch()

    return run


def size_ranges(counts: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """``(smallest, largest, sets, parts)`` of ranges of sizes, from how many sets have each.

    A range is one block or, for a size of more sets than fit, as many parts.
    """
    out: list[list] = []
    load = 0.0
    for n, count in sorted(counts):
        weight = count * (1 / BLOCK_SETS + n / BLOCK_CODES)
        if not out or load + weight > 1:
            out.append([n, n, 0, max(1, math.ceil(weight))])
            load = 0.0
        out[-1][1:3], load = [n, out[-1][2] + count], load + weight
    return [tuple(r) for r in out]
