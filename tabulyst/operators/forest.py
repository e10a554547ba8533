"""Bagged regression trees over a binned design, grown by histograms and finished in bounded groups.

Columns are cut into at most 256 codes once, so a row of the design is a string of bytes. Trees grow in two phases. While a
node holds more rows than one task should, its split comes from histograms that tasks fill and Spark adds up, one pass a
level for a block of trees; only the smaller of two siblings is filled, the other one is the parent less its sibling. Passes read
rows packed in blocks, and columns of few codes are counted together. Nodes small enough are finished where their rows meet: rows are dealt by (tree, node), and each
group grows its subtree alone. Trees of a few levels over many rows are grown by histograms alone, as dealing every row to every
tree costs more than a pass a level; and rows of nodes that can't be split any more are never dealt. Bootstrap weights are hashes of (tree, row), so a lost task draws the same rows again.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import discard, materialize

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CODES = 256
#: Rows of a node that one task finishes; nodes of more rows are split by histograms.
LOCAL_ROWS = 2_000_000
#: Trees of at most so many levels over more than so many rows are grown by histograms alone.
SHALLOW, DEALT_ROWS = 8, 1 << 16
#: Share of a node's squares below which a gain is rounding.
NOISE = 1e-12
#: Trees whose rows are dealt at once, and bytes of histograms of a task.
BLOCK_TREES, HISTOGRAM_BYTES = 50, 256 << 20
#: Parts of the dealt rows for each tree of a block.
PARTS = 4
#: Rows that are carried on together once nodes are small: as many as stay in a core's cache.
NEAR_ROWS = 1 << 13
#: Rows that are packed in one record of the passes: few enough that their cells stay in a core's cache.
BLOCK_ROWS = 1 << 14
#: Least and most rows of a task of a pass; and bytes of a row group of blocks.
TASK_ROWS, TASK_MOST, GROUP_BYTES = 1 << 16, 1 << 22, 8 << 20
#: Cells that a node may have when columns are counted together, unless its own are half as many.
JOINT_CELLS = 1 << 12
#: Bytes of trees that one broadcast holds when rows are scored.
MODEL_BYTES = 128 << 20
QUANTILE_ACCURACY = 20_000
# Chances of 0, 1, 2, ... draws of a row in a bootstrap sample.
_DRAWS = np.cumsum(np.exp(-1) / np.cumprod(np.concatenate(([1.0], np.arange(1, 12)))))
_ODD = np.uint64(0x9E3779B97F4A7C15)
# The same chances as whole numbers of 53 bits; the draws by the leading 16 bits, where they tell.
_LIMITS = np.ceil(_DRAWS * 2.0**53).astype(np.uint64)
_UNSURE = 255
_EDGES = [np.searchsorted(_LIMITS, (np.arange(1 << 16, dtype=np.uint64) << np.uint64(37)) + np.uint64(x), "right") for x in (0, (1 << 37) - 1)]
_BY_BITS = np.where(_EDGES[0] == _EDGES[1], _EDGES[0], _UNSURE).astype(np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of whole numbers, in their place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def bootstrap_weights(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson of mean one, by a hash of row, seed and tree."""
    return _times(keys, seed, tree).astype(np.float64)


def _times(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """The bootstrap weights as bytes: the leading bits of a hash tell nearly always, else all of its 53."""
    salt = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64) * _ODD)
    drawn = _mixed(keys ^ salt)
    times = _BY_BITS.take((drawn >> np.uint64(48)).view(np.int64))
    unsure = np.flatnonzero(times == _UNSURE)
    times[unsure] = np.searchsorted(_LIMITS, drawn[unsure] >> np.uint64(11), "right")
    return times


def cut_points(df: DataFrame, width: int, codes: int = CODES) -> list[np.ndarray]:
    """Cuts of each slot of `features`: a value's code is the number of cuts below it.

    A column of few values has a cut at each of them but the greatest, another one at approximate quantiles.
    """
    if not width:
        return []
    shares = [i / codes for i in range(1, codes)]
    slots = df.select(vector_to_array("features").alias("x"))
    found = slots.agg(*[F.array_union(
        F.percentile_approx(F.get("x", F.lit(i)), shares, QUANTILE_ACCURACY), F.array(F.max(F.get("x", F.lit(i))))).alias(f"q{i}") for i in range(width)]).first()
    return [np.unique(np.array(found[i] or [], float))[:-1] for i in range(width)]


def encode(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Codes (row, column) of values (row, column)."""
    out = np.empty(values.shape, np.uint8)
    for i, own in enumerate(cuts):
        out[:, i] = np.searchsorted(own, values[:, i], "left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def binned(df: DataFrame, row_id: str, cuts: list[np.ndarray]) -> DataFrame:
    """(row_id, key, label, codes) of a design (row_id, features, label)."""
    known = df.sparkSession.sparkContext.broadcast(cuts)
    kind = df.schema[row_id].dataType.simpleString()
    rows = df.select(row_id, F.xxhash64(F.col(row_id).cast("string")).alias("key"), F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = encode(_matrix(batch.column("x"), len(known.value)), known.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in (row_id, "key", "label")), _packed(codes)], names=[row_id, "key", "label", "codes"])

    return rows.mapInArrow(run, f"{row_id} {kind}, key bigint, label double, codes binary")


def _packed(codes: np.ndarray) -> pa.Array:
    n, width = codes.shape
    bounds = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(codes))])


def _codes(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    return raw[start : start + len(column) * width].reshape(len(column), width)


def packed(rows: DataFrame, names: Sequence[str], width: int) -> DataFrame:
    """Rows of 8-byte columns `names` and codes as blocks of at most BLOCK_ROWS: the columns' values end to end, and the codes column by column."""
    names = list(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def block(own: list[list[np.ndarray]]) -> pa.RecordBatch:
            values = [np.concatenate(x) for x in zip(*own)]
            blobs = [x.tobytes() for x in values[:-1]] + [np.ascontiguousarray(values[-1].T).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([len(values[0])], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=["rows", *names, "codes"])

        for batch in batches:
            values = [*(batch.column(x).to_numpy(zero_copy_only=False) for x in names), _codes(batch.column("codes"), width)]
            at = 0
            while at < len(batch):
                # Copied, as what waits would keep its whole batch.
                part = [x[at : at + BLOCK_ROWS - waiting].copy() for x in values]
                held.append(part)
                at, waiting = at + len(part[0]), waiting + len(part[0])
                if waiting == BLOCK_ROWS:
                    yield block(held)
                    held, waiting = [], 0
        if held:
            yield block(held)

    return rows.mapInArrow(run, ", ".join(["rows int", *(f"{x} binary" for x in names), "codes binary"]))


def blocks_of(batches: Iterator[pa.RecordBatch], names: Sequence[str], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of each block, whole numbers or doubles by their name, and its codes (column, row)."""
    for batch in batches:
        for i in range(len(batch)):
            own = [np.frombuffer(batch.column(x)[i].as_buffer(), np.uint64 if x == "key" else np.float64) for x in names]
            yield *own, np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8).reshape(width, len(own[0]))


def pass_tasks(spark: SparkSession, n: int, least: int = TASK_ROWS) -> int:
    """Tasks of a pass over n packed rows, of `least` rows or more: few for a few rows, else all cores alike."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, -(-n // least))) * max(1, -(-n // (cores * TASK_MOST)))


class Joint:
    """Columns of few codes counted together: the codes of a group of columns make one code, also of one byte.

    Sums of the columns' own cells are those of the groups' cells, added up.
    """

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes.tolist()
        self.first = np.concatenate(([0], sizes.cumsum())).astype(np.int64)
        self.groups: list[list[int]] = []
        wide: list[int] = []
        spare = max(JOINT_CELLS - int(sizes.sum()), int(sizes.sum()))
        for i in sorted(range(len(sizes)), key=lambda i: (-self.sizes[i], i)):
            for g, own in enumerate(wide):
                more = own * self.sizes[i] - own - self.sizes[i]
                if own * self.sizes[i] <= CODES and more <= spare:
                    self.groups[g].append(i)
                    wide[g], spare = own * self.sizes[i], spare - more
                    break
            else:
                self.groups.append([i])
                wide.append(self.sizes[i])
        self.start = np.concatenate(([0], np.cumsum(wide))).astype(np.int64)
        self.count = int(self.start[-1])

    def place(self, codes: np.ndarray) -> list[np.ndarray]:
        """Joint code of each row in each group, from codes (column, row); a group's cells begin at its `start`."""
        out = []
        for head, *rest in self.groups:
            own = codes[head]
            for i in rest:
                own = own * np.uint8(self.sizes[i]) + codes[i]
            out.append(own)
        return out

    def apart(self, sums: np.ndarray) -> np.ndarray:
        """Sums (node, cell) of the groups as sums of the columns' own cells."""
        out = np.empty((len(sums), int(self.first[-1])), sums.dtype)
        for start, end, group in zip(self.start, self.start[1:], self.groups):
            part = sums[:, start:end].reshape(len(sums), *(self.sizes[i] for i in group))
            for axis, i in enumerate(group):
                out[:, self.first[i] : self.first[i + 1]] = part.sum(tuple(a + 1 for a in range(len(group)) if a != axis))
        return out


def steps_to(shape: tuple[np.ndarray, ...], nodes: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(node, column, code, left child) of the splits above the nodes, from the top."""
    column, code, left = (x.tolist() for x in shape)
    above = {child: at for at, first in enumerate(left) if first >= 0 for child in (first, first + 1)}
    found: set[int] = set()
    for at in nodes:
        while at in above and above[at] not in found:
            at = above[at]
            found.add(at)
    return [(at, column[at], code[at], left[at]) for at in sorted(found)]


def reached(steps: Sequence[tuple[int, int, int, int]], codes: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """Which of the rows lie in each node that the steps lead to, from codes (column, row)."""
    found = {0: rows}
    for at, column, code, left in steps:
        own, right = found[at], codes[column] > code
        found[left], found[left + 1] = own > right, own & right
    return found


def slots(found: dict[int, np.ndarray], nodes: Sequence[int], n: int) -> np.ndarray:
    """For each row the place, from 1, of its node in `nodes`; 0 if it lies in none."""
    kind = np.uint8 if len(nodes) < 256 else np.int32
    out = np.zeros(n, kind)
    for k, node in enumerate(nodes, 1):
        out += found[node] * kind(k)
    return out


@dataclass
class Tree:
    """Nodes by number: column (-1: leaf), greatest code that goes left, left child (right is next), value, gain."""

    column: list[int] = field(default_factory=list)
    code: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for own, x in ((self.column, -1), (self.code, 0), (self.left, -1), (self.value, value), (self.gain, 0.0)):
            own.append(x)
        return len(self.column) - 1


def _place(column: np.ndarray, code: np.ndarray, left: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    at = np.zeros(len(codes), np.int64)
    live = np.arange(len(codes))
    while len(live):
        own = at[live]
        inner = column[own] >= 0
        live, own = live[inner], own[inner]
        at[live] = left[own] + (codes[live, column[own]] > code[own])
    return at


def _best_splits(sums: np.ndarray, min_leaf: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, column, code) of each node from sums (node, column, code, (weight, weighted label)); gain 0 if there is none."""
    w, m = (sums[..., k].cumsum(2) for k in (0, 1))
    whole_w, whole_m = w[:, :, -1:], m[:, :, -1:]
    rest_w, rest_m = whole_w - w, whole_m - m
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = m**2 / w + rest_m**2 / rest_w - whole_m**2 / whole_w
    gain[~((w >= min_leaf) & (rest_w >= min_leaf))] = 0.0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    return flat[np.arange(len(flat)), best], best // sums.shape[2], best % sums.shape[2]


def _histograms(codes: np.ndarray, node: np.ndarray, nodes: int, weight: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Sums (node, column, code, (weight, weighted label))."""
    width = codes.shape[1]
    out = np.empty((nodes, width, CODES, 2))
    for i in range(width):
        cell = node * CODES + codes[:, i]
        for k, x in enumerate((weight, moment)):
            out[:, i, :, k] = np.bincount(cell, x, nodes * CODES).reshape(nodes, CODES)
    return out


def _histogram_splits(codes: np.ndarray, node: np.ndarray, nodes: int, weight: np.ndarray, moment: np.ndarray, min_leaf: float):
    """As _best_splits, from histograms of one column after the other, as wide as its codes."""
    best, column, code = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    every = np.arange(nodes)
    pair = np.empty(len(node), complex)
    pair.real, pair.imag = weight, moment
    for i, own in enumerate(codes.T):
        size = int(own.max()) + 1
        sums = np.zeros(nodes * size, complex)
        np.add.at(sums, node * size + own, pair)
        w, m = (x.reshape(nodes, size).cumsum(1) for x in (sums.real, sums.imag))
        whole_w, whole_m = w[:, -1:], m[:, -1:]
        rest_w, rest_m = whole_w - w, whole_m - m
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = m**2 / w + rest_m**2 / rest_w - whole_m**2 / whole_w
        gain[~((w >= min_leaf) & (rest_w >= min_leaf))] = 0.0
        at = gain.argmax(1)
        top = gain[every, at]
        better = np.flatnonzero(top > best)
        best[better], column[better], code[better] = top[better], i, at[better]
    return best, column, code


def _sorted_splits(codes: np.ndarray, node: np.ndarray, nodes: int, weight: np.ndarray, moment: np.ndarray, min_leaf: float):
    """As _best_splits, by sorting: work follows the rows, not the nodes times the codes."""
    if (node[1:] < node[:-1]).any():
        order = np.argsort(node, kind="stable")
        codes, node, weight, moment = codes[order], node[order], weight[order], moment[order]
    total = np.stack([np.bincount(node, x, nodes) for x in (weight, moment)])
    base = total[1] ** 2 / total[0]
    best, column, code = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    width, n = codes.shape[1], len(node)
    start = np.searchsorted(node, np.arange(nodes))
    # Node, code and place in one number: a plain sort of it is a stable one by node and code.
    bits = n.bit_length()
    kind = np.uint32 if (nodes * CODES) << bits <= 1 << 32 else np.int64
    packed = (node * CODES).astype(kind) + codes.T
    packed <<= kind(bits)
    packed |= np.arange(n, dtype=kind)
    packed.sort(1)
    key, order = packed >> kind(bits), packed & kind((1 << bits) - 1)
    # Only the last row of a code can be the end of a left side.
    spot = np.zeros((width, n), bool)
    np.logical_and(key[:, 1:] != key[:, :-1], node[1:] == node[:-1], out=spot[:, :-1])
    spot = np.flatnonzero(spot)
    column_of, place = np.divmod(spot, n)
    own = node.take(place)
    before = column_of * n + np.maximum(start - 1, 0).take(own)
    after_first = (start > 0).take(own)
    w, m = (x.take(order).cumsum(1).ravel() for x in (weight, moment))
    w, m = (x.take(spot) - np.where(after_first, x.take(before), 0.0) for x in (w, m))
    rest = total[0].take(own) - w
    able = np.flatnonzero((w >= min_leaf) & (rest >= min_leaf))
    if not len(able):
        return best, column, code
    of, spot, own, w, m, rest = (x.take(able) for x in (column_of * nodes + own, spot, own, w, m, rest))
    gain = m**2 / w + (total[1].take(own) - m) ** 2 / rest - base.take(own)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    top = np.maximum.reduceat(gain, first)
    is_top = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(first, len(of)))))
    is_top = is_top[np.diff(of[is_top], prepend=-1) != 0]
    chosen, of = (key.ravel().take(spot[is_top]) % CODES).astype(np.int64), of[first]
    edges = np.searchsorted(of, np.arange(width + 1) * nodes).tolist()
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        who, found = of[low:high] - i * nodes, top[low:high]
        better = np.flatnonzero(found > best[who] * (1 + 1e-12) + 1e-12)
        who = who[better]
        best[who], column[who], code[who] = found[better], i, chosen[low:high][better]
    return best, column, code


def grow(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, min_leaf: float, depth: int) -> Tree:
    """One tree over the rows, level by level; a node splits where the squared error falls most.

    Once nodes are small, they are carried on in parts of as many rows as stay in cache.
    """
    total = weight.sum()
    centre = float((weight * label).sum() / total) if total else 0.0
    # Labels are centred, so that sums of squares lose no digits.
    moment = weight * (label - centre)
    values, splits, size = [np.array([centre])], [], 1
    rows = np.flatnonzero(weight > 0)
    # Parts of a level: numbers of their nodes; node, codes by column, weight and moment of their rows.
    parts = [(np.zeros(1, np.int64), np.zeros(len(rows), np.int64), codes.take(rows, 0).T.copy(), weight.take(rows), moment.take(rows))] if len(rows) else []
    for _ in range(depth):
        parts = [x for part in parts for x in _cut(*part)]
        found = []
        for number, node, own, w, m in parts:
            nodes = len(number)
            best = _histogram_splits if nodes * CODES <= 2 * len(node) else _sorted_splits
            found.append(best(own.T, node, nodes, w, m, min_leaf))
        least = 1e-12 * max(1.0, sum(float((m * m).sum()) for *_, m in parts))
        level, parts = zip(parts, found), []
        for (number, node, own, w, m), (gain, column, code) in level:
            split = np.flatnonzero(gain > least)
            if not len(split):
                continue
            to = np.full(len(number), -1, np.int64)
            to[split] = np.arange(len(split))
            right = own.ravel().take(column.take(node) * len(node) + np.arange(len(node))) > code.take(node)
            child = 2 * to.take(node) + right
            inside = np.flatnonzero(child >= 0)
            of = child.take(inside)
            sums = [np.bincount(of, x.take(inside), 2 * len(split)) for x in (w, m)]
            splits.append((number[split], column[split], code[split], size + 2 * np.arange(len(split)), gain[split]))
            values.append(centre + sums[1] / sums[0])
            wide = sums[0] >= 2 * min_leaf  # others can't split again
            number, to = size + np.flatnonzero(wide), np.cumsum(wide) - 1
            size += 2 * len(split)
            # Rows are kept in the order of their nodes, and inside a node in their own.
            kept = np.flatnonzero(wide.take(of))
            if len(kept):
                bits = np.int64(len(kept).bit_length())
                packed = np.sort((to.take(of.take(kept)) << bits) | np.arange(len(kept)))
                rows = inside.take(kept).take(packed & ((1 << bits) - 1))
                parts.append((number, packed >> bits, own.take(rows, 1), w.take(rows), m.take(rows)))
        if not parts:
            break
    found = [np.full(size, x, np.int64) for x in (-1, 0, -1)] + [np.zeros(size)]
    for at, *own in splits:
        for out, x in zip(found, own):
            out[at] = x
    column, code, left, gain = (x.tolist() for x in found)
    return Tree(column, code, left, np.concatenate(values).tolist(), gain)


def _cut(number: np.ndarray, node: np.ndarray, own: np.ndarray, w: np.ndarray, m: np.ndarray) -> Iterator[tuple]:
    """A level's part as parts of at most NEAR_ROWS rows or one node, if its nodes are small."""
    nodes = len(number)
    if nodes * CODES <= 2 * len(node) or len(node) <= NEAR_ROWS:
        yield number, node, own, w, m
        return
    ends = np.bincount(node, minlength=nodes).cumsum()
    low = at = 0
    while low < nodes:
        high = max(low + 1, int(np.searchsorted(ends, at + NEAR_ROWS, "right")))
        end = int(ends[high - 1])
        yield number[low:high], node[at:end] - low, own[:, at:end].copy(), w[at:end], m[at:end]
        low, at = high, end


_TYPES = {"tree": pa.int32(), "root": pa.int64(), "node": pa.int64(), "col": pa.int32(), "code": pa.int32(), "first": pa.int64(), "value": pa.float64(), "gain": pa.float64()}
_NODES = "tree int, root bigint, node bigint, col int, code int, first bigint, value double, gain double"


def _finish(width: int, min_leaf: float, depth: int):
    """Rows of one (tree, root) to the nodes of the subtree under that root, numbered from 0."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        label, weight, codes = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])
            for name, kind in (("label", np.float64), ("weight", np.uint8), ("codes", np.uint8)))
        tree = grow(codes.reshape(len(label), width), label, weight.astype(np.float64), min_leaf, depth - table.column("level")[0].as_py())
        n = len(tree.column)
        return pa.table({
            "tree": pa.array(np.full(n, key[0].as_py(), np.int32)), "root": pa.array(np.full(n, key[1].as_py(), np.int64)), "node": pa.array(np.arange(n)),
            "col": pa.array(tree.column, pa.int32()), "code": pa.array(tree.code, pa.int32()), "first": pa.array(tree.left, pa.int64()),
            "value": pa.array(tree.value, pa.float64()), "gain": pa.array(tree.gain, pa.float64())})

    return run


def _arrays(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array(tree.column, np.int64), np.array(tree.code, np.int64), np.array(tree.left, np.int64)


def _deal(known, seed: int, width: int):
    """Each row once for every tree that drew it, with its node in the tree so far and that node's level.

    Rows of a batch that meet in a node travel as one: their labels, weights and codes end to end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, keys = _codes(batch.column("codes"), width), batch.column("key").to_numpy().view(np.uint64)
            labels, out = batch.column("label").to_numpy(), []
            for number, (shape, level, unfinished) in known.value.items():
                if not unfinished.any():
                    continue
                weight = _times(keys, seed, number)
                drawn = np.flatnonzero(weight)
                at = _place(*shape, codes[drawn])
                drawn, at = drawn[unfinished[at]], at[unfinished[at]]
                order = np.argsort(at, kind="stable")
                drawn, at = drawn[order], at[order]
                heads = np.flatnonzero(np.diff(at, prepend=-1))
                for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(at)]):
                    own, root = drawn[low:high], int(at[low])
                    out.append((number, root, int(level[root]), labels[own].tobytes(), weight[own].tobytes(), codes[own].tobytes()))
            if out:
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=["tree", "root", "level", "label", "weight", "codes"])

    return run


def _fill(known, seed: int, sizes: np.ndarray):
    """Histograms of the asked nodes over the task's rows, a row for each (tree, node): (weight, weighted label) of the columns' codes."""
    joint = Joint(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, centre = known.value
        steps = {number: steps_to(shape, ask.tolist()) for number, (shape, ask, _) in trees.items()}
        # A weight and a weighted label are added as one complex number.
        sums = {number: np.zeros(len(ask) * joint.count, complex) for number, (_, ask, _) in trees.items()}
        squares = {number: np.zeros(len(ask)) for number, (_, ask, _) in trees.items()}
        for keys, labels, codes in blocks_of(batches, ("key", "label"), len(sizes)):
            place, labels = joint.place(codes), labels - centre
            for number, (_, ask, _) in trees.items():
                weight = _times(keys, seed, number)
                slot = slots(reached(steps[number], codes, weight > 0), ask.tolist(), len(weight))
                rows = np.flatnonzero(slot > 0)
                slot = slot.take(rows).astype(np.int64) - 1
                pair, label = np.empty(len(rows), complex), labels.take(rows)
                pair.real = weight.take(rows)
                np.multiply(pair.real, label, out=pair.imag)
                squares[number] += np.bincount(slot, label * pair.imag, len(ask))
                slot *= joint.count
                for start, own in zip(joint.start.tolist(), place):
                    np.add.at(sums[number][start:], slot + own.take(rows), pair)
        for number, (_, ask, parents) in trees.items():
            found = joint.apart(sums.pop(number).reshape(len(ask), -1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ask), number, np.int32)), pa.array(parents), pa.array(ask), pa.array([np.stack((x.real, x.imag)).tobytes() for x in found], pa.binary()), pa.array(squares[number])],
                names=["tree", "parent", "node", "sums", "squares"])

    return run


_SUMS = "tree int, parent bigint, node bigint, sums binary, squares double"
_CHOSEN = "tree int, node bigint, gain double, col int, code int, n_low double, y_low double, n double, y double, sums binary, squares double"


def _choose(sizes: np.ndarray, min_leaf: float, keep: bool):
    """The best split of a node, and of its sibling from the parent's sums (node -1), by the histograms of all tasks; none if its gain is but rounding.

    Sums are handed on (`keep`) for nodes that split.
    """
    start, width = np.concatenate(([0], sizes.cumsum())), len(sizes)

    def best(tree: int, node: int, cells: np.ndarray, squares: float) -> tuple:
        sums = np.zeros((1, width, CODES, 2))
        for i, size in enumerate(sizes.tolist()):
            sums[0, i, :size] = cells[:, start[i] : start[i + 1]].T
        whole = sums[0, 0].sum(0)
        # Splits are chosen on centred labels, as sums of squares of others lose digits.
        mean = whole[1] / whole[0] if whole[0] else 0.0
        centred = sums.copy()
        centred[..., 1] -= mean * sums[..., 0]
        gain, column, code = (x[0] for x in _best_splits(centred, min_leaf))
        if gain <= NOISE * max(1.0, squares):
            gain = 0.0
        low = sums[0, column, : code + 1].sum(0)
        return tree, node, float(gain), int(column), int(code), float(low[0]), float(low[1]), float(whole[0]), float(whole[1]), cells.tobytes() if keep and gain > 0 else None, squares

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree, parent = (x.as_py() for x in key)
        own, above, asked = [np.zeros((2, start[-1])), 0.0], None, -1
        for node, cells, squares in zip(table.column("node").to_pylist(), table.column("sums"), table.column("squares").to_pylist()):
            cells = np.frombuffer(cells.as_buffer()).reshape(2, -1)
            if node < 0:
                above = cells, squares
            else:
                own, asked = [own[0] + cells, own[1] + squares], node
        found = [] if asked < 0 else [best(tree, asked, *own)]
        if found and above is not None:
            # Numbers of siblings follow each other, and the left one is odd.
            found.append(best(tree, asked + 1 if asked % 2 else asked - 1, above[0] - own[0], max(above[1] - own[1], 0.0)))
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.binary(), pa.float64())
        return pa.table([pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds)], names=[x.split()[0] for x in _CHOSEN.split(", ")])

    return run


def _limit(n: int, min_leaf: float, depth: int) -> float:
    """Nodes of more rows than this are split by histograms, in shallow trees over many rows all of them."""
    return 2 * max(min_leaf, 1) - 1 if depth <= SHALLOW and n > DEALT_ROWS else LOCAL_ROWS


def _top(blocks: DataFrame | None, numbers: Sequence[int], centre: float, sizes: np.ndarray, min_leaf: float, depth: int, seed: int, limit: float) -> dict[int, tuple[Tree, np.ndarray, np.ndarray]]:
    """Trees as far as histograms over the packed rows take them, each node's level, and which nodes are still to be finished."""
    least = 2 * max(min_leaf, 1)
    trees = {t: (Tree(), [0], {0}) for t in numbers}
    for tree, *_ in trees.values():
        tree.add(0.0)
    # Trees that take their next pass together: their open nodes, and the table of their parents' sums.
    waiting = [({t: [0] for t in numbers}, None)] if blocks is not None else []
    one, written = Joint(sizes).count * 16, []
    count: dict[tuple[int, int], float] = {}
    while waiting:
        open_, above = waiting.pop()
        ask = {}
        for t, nodes in open_.items():
            # The smaller one of siblings is filled, also if only the other one is open.
            first = sorted({n - (1 - n % 2) for n in nodes if n})
            ask[t] = [0] if not first else [min(n, n + 1, key=lambda x: (count[t, x], x)) for n in first]
        if len(open_) > 1 and one * sum(map(len, ask.values())) > HISTOGRAM_BYTES:  # as many nodes at once as a task's histograms may take
            own = list(open_)
            waiting += [({t: open_[t] for t in part}, above) for part in (own[len(own) // 2 :], own[: len(own) // 2])]
            continue
        keep = any(trees[t][1][n] + 1 < depth for t, nodes in open_.items() for n in nodes)
        parents = {t: np.array([trees[t][0].left.index(n - (1 - n % 2)) if n else -1 for n in nodes], np.int64) for t, nodes in ask.items()}
        known = blocks.sparkSession.sparkContext.broadcast(({t: (_arrays(trees[t][0]), np.array(nodes, np.int64), parents[t]) for t, nodes in ask.items()}, centre))
        filled = blocks.mapInArrow(_fill(known, seed, sizes), _SUMS)
        if above is not None:
            filled = filled.union(above.where("sums is not null").select("tree", F.col("node").alias("parent"), F.lit(-1).cast("bigint"), "sums", "squares"))
        chosen = filled.groupBy("tree", "parent").applyInArrow(_choose(sizes, min_leaf, keep), _CHOSEN)
        if keep:
            chosen = materialize(chosen)
            written.append(chosen)
        follow: dict[int, list[int]] = {}
        for r in chosen.drop("sums", "squares").collect():
            t, at = r["tree"], r["node"]
            tree, level, unfinished = trees[t]
            if at not in open_.get(t, ()):
                continue
            unfinished.discard(at)
            if not at and r["n"]:
                tree.value[0] = centre + r["y"] / r["n"]
            if r["gain"] <= 0:
                continue
            tree.column[at], tree.code[at], tree.gain[at] = r["col"], r["code"], r["gain"]
            for k, (weight, total) in enumerate(((r["n_low"], r["y_low"]), (r["n"] - r["n_low"], r["y"] - r["y_low"]))):
                child = tree.add(centre + total / weight)
                level.append(level[at] + 1)
                count[t, child] = weight
                if not k:
                    tree.left[at] = child
                if weight >= least and level[child] < depth:
                    unfinished.add(child)
                    if weight > limit:
                        follow.setdefault(t, []).append(child)
        known.unpersist()
        if follow:
            waiting.append((follow, chosen))
    for table in written:
        discard(table)
    return {t: (tree, np.array(level), np.isin(np.arange(len(level)), list(unfinished))) for t, (tree, level, unfinished) in trees.items()}


class ForestModel:
    """Mean of trees over binned columns; `nodes` is a table of all of them, one row a node."""

    def __init__(self, nodes: DataFrame, cuts: list[np.ndarray], trees: int):
        self.nodes, self.cuts, self.trees, self.column = nodes, cuts, trees, "prediction"
        self._blocks = None

    def setPredictionCol(self, name: str) -> "ForestModel":
        self.column = name
        return self

    @property
    def featureImportances(self) -> np.ndarray:
        """Share of each column in the error that its splits remove, mean over the trees."""
        gains = self.nodes.where("col >= 0").groupBy("tree", "col").agg(F.sum("gain").alias("gain"))
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        shares = gains.join(whole, "tree").where("whole > 0").groupBy("col").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
        out = np.zeros(len(self.cuts))
        for r in shares.collect():
            out[r["col"]] = r["share"]
        return out / out.sum() if out.sum() else out

    def gains(self) -> np.ndarray:
        """Error that the splits of each column remove, mean over the trees."""
        out = np.zeros(len(self.cuts))
        for r in self.nodes.where("col >= 0").groupBy("col").agg(F.sum("gain").alias("gain")).collect():
            out[r["col"]] = r["gain"] / self.trees
        return out

    def _broadcasts(self) -> list:
        """Trees in blocks of at most MODEL_BYTES; they are put together from their subtrees in Spark."""
        if self._blocks is None:
            context, size = self.nodes.sparkSession.sparkContext, 24
            count = self.nodes.count()
            blocks = max(1, -(-count * size // MODEL_BYTES))
            self._blocks = []
            for b in range(blocks):
                own = self.nodes.where(F.col("tree") % blocks == b) if blocks > 1 else self.nodes
                table = own.select("tree", "root", "node", "col", "code", "first", "value").toArrow()
                self._blocks.append(context.broadcast(_assembled(table)))
        return self._blocks

    def transform(self, df: DataFrame) -> DataFrame:
        total = None
        for block in self._broadcasts():
            one = F.pandas_udf(_summed(block, self.cuts), "double")(vector_to_array("features"))
            total = one if total is None else total + one
        return df.withColumn(self.column, total / F.lit(float(self.trees)))

    def write(self) -> "ForestModel":
        return self

    def save(self, path: str) -> None:
        self.nodes.write.parquet(f"{path}/nodes")
        state = json.dumps({"trees": self.trees, "cuts": [x.tolist() for x in self.cuts]})
        self.nodes.sparkSession.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{path}/cuts")

    @classmethod
    def load(cls, path: str) -> "ForestModel":
        spark = SparkSession.getActiveSession()
        state = json.loads(spark.read.text(f"{path}/cuts", wholetext=True).first()["value"])
        return cls(spark.read.parquet(f"{path}/nodes"), [np.array(x, float) for x in state["cuts"]], state["trees"])


def _assembled(table: pa.Table) -> list[tuple[np.ndarray, ...]]:
    """(column, code, left, value) of each tree. Root -1 is the top; a leaf of it that was carried on is replaced by its subtree."""
    own = {x: table.column(x).to_numpy() for x in table.column_names}
    order = np.lexsort((own["node"], own["root"], own["tree"]))
    own = {k: v[order] for k, v in own.items()}
    out = []
    edges = np.flatnonzero(np.diff(own["tree"], prepend=-1))
    for low, high in zip(edges, np.append(edges[1:], len(order))):
        root, part = own["root"][low:high], {k: own[k][low:high].copy() for k in ("col", "code", "first", "value")}
        heads = np.flatnonzero(np.diff(root, prepend=-2))
        start = np.repeat(heads, np.diff(np.append(heads, len(root))))
        left = np.where(part["first"] >= 0, part["first"] + start, -1)
        column, code, value = part["col"].astype(np.int16), part["code"].astype(np.uint8), part["value"]
        for head in heads.tolist():  # hang each subtree on its leaf of the top
            if root[head] >= 0:
                at = int(root[head])
                column[at], code[at], left[at], value[at] = column[head], code[head], left[head], value[head]
        out.append((column, code, left.astype(np.int32), value))
    return out


def _summed(block, cuts: list[np.ndarray]):
    def run(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        codes = encode(np.stack(x.to_numpy()), cuts)
        total = np.zeros(len(codes))
        for column, code, left, value in block.value:
            total += value[_place(column, code, left, codes)]
        return pd.Series(total)

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return run


class Forest:
    """Estimator with the settings of the family; fit(design) takes (row_id, features, label)."""

    def __init__(self, seed: int, trees: int, min_leaf: int, depth: int, row_id: str = "_id"):
        self.seed, self.trees, self.min_leaf, self.depth, self.row_id = seed, trees, min_leaf, depth, row_id

    def fit(self, design: DataFrame) -> ForestModel:
        width = len(design.first()["features"])
        cuts = cut_points(design, width)
        return fit_binned(materialize(binned(design, self.row_id, cuts)), cuts, self.trees, self.min_leaf, self.depth, self.seed)


def fit_binned(rows: DataFrame, cuts: list[np.ndarray], trees: int, min_leaf: float, depth: int, seed: int, block_trees: int = BLOCK_TREES, n: int | None = None) -> ForestModel:
    """A forest over (key, label, codes), in blocks of trees. Shallow trees over many rows (`n`, if known) read them once."""
    width, spark = len(cuts), rows.sparkSession
    n = rows.count() if n is None else n
    sizes = np.array([len(own) + 1 for own in cuts], np.int64)
    rows = rows.select("key", "label", "codes")
    limit, blocks, centre = _limit(n, min_leaf, depth), None, 0.0
    if n > limit and depth and width:
        tasks = pass_tasks(spark, n)
        blocks = materialize(packed(rows.repartition(tasks, "key"), ("key", "label"), width), GROUP_BYTES)
        centre = _centre(blocks)
    found = None
    for low in range(0, trees, block_trees):
        numbers = range(low, min(trees, low + block_trees))
        tops = _top(blocks, numbers, centre, sizes, min_leaf, depth, seed, limit)
        top = [(t, -1, i, tree.column[i], tree.code[i], tree.left[i], tree.value[i], tree.gain[i]) for t, (tree, *_) in tops.items() for i in range(len(tree.column))]
        nodes = spark.createDataFrame(pa.table(dict(zip(_TYPES, map(pa.array, zip(*top), _TYPES.values())))))
        if not any(unfinished.any() for *_, unfinished in tops.values()):
            block = materialize(nodes.coalesce(1))
        else:
            known = spark.sparkContext.broadcast({t: (_arrays(tree), level, unfinished) for t, (tree, level, unfinished) in tops.items()})
            dealt = rows.mapInArrow(_deal(known, seed, width), "tree int, root bigint, level int, label binary, weight binary, codes binary")
            if n > DEALT_ROWS:
                # Nodes are many rows each: more parts than nodes, so that few parts hold several and the slots end together.
                dealt = dealt.repartition(PARTS * len(numbers), "tree", "root")
            grown = dealt.groupBy("tree", "root").applyInArrow(_finish(width, min_leaf, depth), _NODES)
            block = materialize(grown.union(nodes))
        found = block if found is None else found.union(block)
    if blocks is not None:
        discard(blocks)
    return ForestModel(found, cuts, trees)


def _centre(blocks: DataFrame) -> float:
    """Mean label of packed rows as a whole number, so that labels that are whole stay so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer()) for x in batch.column("label")]
            yield pa.RecordBatch.from_arrays([pa.array([float(np.nansum(x)) for x in own]), pa.array([int(np.isfinite(x).sum()) for x in own])], names=["total", "n"])

    found = blocks.select("label").mapInArrow(run, "total double, n bigint").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    return float(np.rint(found["total"] / found["n"])) if found["n"] else 0.0
