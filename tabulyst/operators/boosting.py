"""Boosted regression trees over a binned design: grown leaf by leaf, or with one split for a whole level.

A pass over the rows fills histograms of the nodes whose splits are still unknown; Spark adds them up cell by cell, and the
driver keeps one sum for each cell of each open node, so its memory follows leaves and codes, never rows. Only the smaller
of two siblings is filled, the other one is the parent less its sibling. Residuals are whole numbers of a fixed unit, so
sums are exact: trees depend neither on the order of rows nor on how they are dealt to tasks, also after a task is lost.
Rows travel packed in blocks, columns of few codes are counted together, and a row's place in a tree is told by masks.

`leafwise` splits the leaf of greatest gain until there are `leaves`. One pass fills all nodes that the order known so far
would split, so there are about as many passes as levels. `symmetric` takes for every level the split of greatest gain summed
over its nodes, and a row's leaf is the number whose bits are its answers. Ties go to the first column, code and node.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import discard, materialize
from .forest import BLOCK_ROWS, GROUP_BYTES, HISTOGRAM_BYTES, ForestModel, Joint, Tree, _arrays, _place, _summed, binned, blocks_of, cut_points, packed, pass_tasks, reached, slots, steps_to

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees after which residuals are written, so that a pass walks fewer than that many.
WRITE_TREES = 8
#: Bits of a residual and of a whole sum. A block's rows are summed as doubles, which hold whole numbers of up to 53 bits.
VALUE_BITS, SUM_BITS = min(38, 52 - BLOCK_ROWS.bit_length() + 1), 61
#: Least rows of a task: a pass lasts as long as its tasks start, so a few rows are not dealt to many.
TASK_ROWS = 1 << 17
#: Bytes of the tasks' sums that the driver adds up itself; more are added up by Spark.
COLLECT_BYTES = 16 << 20
LEAVES, DEPTH, MIN_LEAF = 31, 6, 20
_LESS = (1 << 30) - 1

#: From the shape so far and the numbers of its open leaves to their sums (leaf, (rows, residual), cell).
Fill = Callable[[object, Sequence[int]], np.ndarray]


@dataclass
class Cells:
    """Places of the columns' codes in one row of cells; a column has as many as it has codes."""

    sizes: np.ndarray

    def __post_init__(self) -> None:
        self.start = np.concatenate(([0], self.sizes.cumsum())).astype(np.int64)
        self.column = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.count = int(self.start[-1])

    def split(self, cell: int) -> tuple[int, int]:
        column = int(self.column[cell])
        return column, int(cell - self.start[column])


def _lower(sums: np.ndarray, cells: Cells, whole: tuple[int, int]) -> np.ndarray:
    """Sums of the codes up to each cell's own, inside its column. Every column holds all rows of the node."""
    before = np.array(whole, np.int64)[:, None] * cells.column  # wraps around as the running sums do
    return sums.cumsum(1) - before


def _gains(low: np.ndarray, whole: tuple[int, int], min_leaf: int) -> np.ndarray:
    """How far each cell's split lowers the squared error; 0 where a side has too few rows."""
    n, m = whole
    rows, rest = low[0].astype(float), (n - low[0]).astype(float)
    # Products of whole sums pass 53 bits on large tables; rounded, a node of equal residuals would seem to have splits. So
    # left residual * n - residual * left rows is taken in two parts of 30 bits, which hold it exactly.
    high = (low[1] >> 30) * n - (m >> 30) * low[0]
    less = (low[1] & _LESS) * n - (m & _LESS) * low[0]
    apart = (high + (less >> 30)).astype(float) * 2.0**30 + (less & _LESS)
    able = (low[0] >= max(min_leaf, 1)) & (n - low[0] >= max(min_leaf, 1))
    return np.where(able, apart * apart / np.where(able, rows * rest * max(n, 1), 1.0), 0.0)


@dataclass
class _Node:
    rows: int
    total: int
    sums: np.ndarray | None = None
    split: tuple | None = None  # gain, cell, rows and residual of the left side
    known: bool = False
    children: tuple[int, int] | None = None


def leafwise(fill: Fill, cells: Cells, leaves: int = LEAVES, min_leaf: int = MIN_LEAF) -> tuple[Tree, list[tuple[int, int]]]:
    """A tree grown by the greatest gain first, and (rows, residual) of its nodes."""
    root = fill(_arrays(_single()), [0])[0]
    first = slice(0, int(cells.sizes[0]))
    nodes = [_Node(int(root[0, first].sum()), int(root[1, first].sum()))]

    def learn(at: int, sums: np.ndarray) -> None:
        own = nodes[at]
        own.sums, own.known = sums, True
        low = _lower(sums, cells, (own.rows, own.total))
        gain = _gains(low, (own.rows, own.total), min_leaf)
        best = int(gain.argmax())
        if gain[best] > 0:
            own.split = float(gain[best]), best, int(low[0, best]), int(low[1, best])

    def open_children(at: int) -> None:
        own = nodes[at]
        if own.children is None:
            _, _, rows, total = own.split
            own.children = len(nodes), len(nodes) + 1
            for n, m in ((rows, total), (own.rows - rows, own.total - total)):
                nodes.append(_Node(n, m, known=n < 2 * max(min_leaf, 1)))

    learn(0, root)
    while True:
        # The order by what is known; a leaf without sums yet stands aside, so what follows it is a guess.
        age, order = {0: 0}, []
        leaf = {0}
        while len(leaf) < leaves:
            able = [at for at in leaf if nodes[at].split is not None]
            if not able:
                break
            best = min(able, key=lambda at: (-nodes[at].split[0], age[at]))
            open_children(best)
            order.append(best)
            leaf.remove(best)
            for c in nodes[best].children:
                age[c] = len(age)
                leaf.add(c)
        last = order[-1] if len(leaf) == leaves and order else None
        ask = [at for at in order if at != last and not all(nodes[c].known for c in nodes[at].children)]
        if not ask:
            break
        # The smaller child is filled from rows, the other is what is left of the parent.
        less = [min(nodes[at].children, key=lambda c: (nodes[c].rows, c)) for at in ask]
        for at, small, sums in zip(ask, less, fill(_shape(nodes, cells), less)):
            left, right = nodes[at].children
            large = right if small == left else left
            rest = nodes[at].sums - sums
            for c, found in ((small, sums), (large, rest)):
                if not nodes[c].known:
                    learn(c, found)
            nodes[at].sums = None
    tree, totals, number = Tree(), [(nodes[0].rows, nodes[0].total)], {0: 0}
    tree.add(0.0)
    for at in order:
        here, (gain, cell, *_) = number[at], nodes[at].split
        (tree.column[here], tree.code[here]), tree.gain[here] = cells.split(cell), gain
        for k, c in enumerate(nodes[at].children):
            number[c] = tree.add(0.0)
            totals.append((nodes[c].rows, nodes[c].total))
            if not k:
                tree.left[here] = number[c]
    return tree, totals


def symmetric(fill: Fill, cells: Cells, depth: int = DEPTH, min_leaf: int = 1) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(column, code) of every level, and (rows, residual) of the leaves; bit l of a leaf's number says whether it lies right of split l."""
    sums = fill([], [0])
    first = slice(0, int(cells.sizes[0]))
    wholes = [(int(sums[0, 0, first].sum()), int(sums[0, 1, first].sum()))]
    bits: list[tuple[int, int]] = []
    for level in range(depth):
        lows = [_lower(own, cells, whole) for own, whole in zip(sums, wholes)]
        gain = np.zeros(cells.count)
        for low, whole in zip(lows, wholes):
            gain += _gains(low, whole, min_leaf)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        bits.append(cells.split(best))
        left = [(int(low[0, best]), int(low[1, best])) for low in lows]
        right = [(n - a, m - b) for (n, m), (a, b) in zip(wholes, left)]
        parents, wholes = sums, left + right
        if level + 1 == depth:
            break
        half = len(left)
        small = [i if left[i][0] <= right[i][0] else i + half for i in range(half)]
        ask = [i for i in small if wholes[i][0]]
        sums = np.zeros((2 * half, 2, cells.count), np.int64)
        if ask:
            sums[ask] = fill(bits, ask)
        for i, own in enumerate(small):
            sums[(own + half) % (2 * half)] = parents[i] - sums[own]
    return bits, wholes


def _single() -> Tree:
    tree = Tree()
    tree.add(0.0)
    return tree


def _shape(nodes: list[_Node], cells: Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column, code, left = (np.full(len(nodes), x, np.int64) for x in (-1, 0, -1))
    for at, own in enumerate(nodes):
        if own.children is not None:
            (column[at], code[at]), left[at] = cells.split(own.split[1]), own.children[0]
    return column, code, left


def _as_tree(bits: Sequence[tuple[int, int]], values: np.ndarray) -> Tree:
    """The complete tree whose leaves have the values by their bits."""
    tree = _single()
    level = [(0, 0)]
    for depth, (column, code) in enumerate(bits):
        below = []
        for at, number in level:
            tree.column[at], tree.code[at] = column, code
            tree.left[at] = tree.add(0.0)
            below += [(tree.left[at], number), (tree.add(0.0), number + (1 << depth))]
        level = below
    for at, number in level:
        tree.value[at] = float(values[number])
    return tree


def _leaf(shape, codes: np.ndarray) -> np.ndarray:
    """Leaf of each row: by the bits of the answers, or by a walk."""
    if not isinstance(shape, list):
        return _place(*shape, codes)
    at = np.zeros(len(codes), np.int64)
    for level, (column, code) in enumerate(shape):
        at |= (codes[:, column] > code).astype(np.int64) << level
    return at


class _Walk:
    """Leaves of a tree or of the answers' bits for rows of codes (column, row)."""

    def __init__(self, shape, leaves: Sequence[int] | None = None):
        self.bits = shape if isinstance(shape, list) else None
        if self.bits is None:
            self.shape = shape
            self.nodes = np.flatnonzero(shape[0] < 0).tolist() if leaves is None else list(leaves)
            self.steps = steps_to(shape, self.nodes)
        else:
            self.nodes = list(range(1 << len(shape))) if leaves is None else list(leaves)

    def answers(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(codes.shape[1], np.uint8 if len(self.bits) <= 8 else np.int64)
        for level, (column, code) in enumerate(self.bits):
            at += (codes[column] > code) * at.dtype.type(1 << level)
        return at

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """For each row the place, from 1, of its leaf among those asked for; 0 if it is none of them."""
        if self.bits is None:
            return slots(reached(self.steps, codes, np.ones(codes.shape[1], bool)), self.nodes, codes.shape[1])
        table = np.zeros(1 << len(self.bits), np.int64)
        table[self.nodes] = np.arange(1, len(self.nodes) + 1)
        return table.take(self.answers(codes))

    def values(self, codes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The value of each row's leaf."""
        if self.bits is not None:
            return values.take(self.answers(codes))
        if len(self.nodes) > 255:
            return values.take(_leaf(self.shape, codes.T))
        return values[self.nodes].take(self.slots(codes) - np.uint8(1))


def _walks(done) -> list[tuple[_Walk, np.ndarray]]:
    return [(_Walk(shape), values) for shape, values in done]


def _left_over(residual: np.ndarray, codes: np.ndarray, walks, rate: float) -> np.ndarray:
    for walk, values in walks:
        residual = residual - walk.values(codes, rate * values)
    return residual


def _sum_cells(known, cells: Cells):
    """Sums of the open leaves' cells over the task's rows: (cell, rows, residual in units)."""
    joint = Joint(cells.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, rate, shape, leaves, unit = known.value
        walks, asked, out = _walks(done), _Walk(shape, leaves.tolist()), np.zeros((2, len(leaves) * joint.count), np.int64)
        root = len(shape[0]) == 1 if asked.bits is None else not asked.bits
        for residuals, codes in blocks_of(batches, ("residual",), len(cells.sizes)):
            rows, slot = slice(None), 0
            if not root:
                slot = asked.slots(codes)
                rows = np.flatnonzero(slot > 0)
                if not len(rows):
                    continue
                slot = (slot.take(rows).astype(np.int64) - 1) * joint.count
                codes, residuals = codes.take(rows, 1), residuals.take(rows)
            # A row and its residual are added as one complex number.
            pair, found = np.ones(len(residuals), complex), np.zeros(out.shape[1], complex)
            pair.imag = np.rint(_left_over(residuals, codes, walks, rate) / unit)
            for start, own in zip(joint.start.tolist(), joint.place(codes)):
                np.add.at(found[start:], slot + own.astype(np.int64), pair)
            out[0] += found.real.astype(np.int64)
            out[1] += found.imag.astype(np.int64)
        rows, residual = (joint.apart(x.reshape(len(leaves), -1)).ravel() for x in out)
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(rows[some]), pa.array(residual[some])], names=["cell", "n", "m"])

    return run


def _write_residuals(known, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, rate = known.value
        walks = _walks(done)
        for batch in batches:
            left = [_left_over(residual, codes, walks, rate).tobytes() for residual, codes in blocks_of(iter([batch]), ("residual",), width)]
            yield batch.set_column(batch.schema.get_field_index("residual"), "residual", pa.array(left, pa.binary()))

    return run


class BoostedModel(ForestModel):
    """A start and the sum of trees times a rate, over binned columns."""

    def __init__(self, nodes: DataFrame, cuts: list[np.ndarray], trees: int, start: float, rate: float):
        super().__init__(nodes, cuts, trees)
        self.start, self.rate = start, rate

    def transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(self.start)
        for block in self._broadcasts():
            total = total + F.lit(self.rate) * F.pandas_udf(_summed(block, self.cuts), "double")(vector_to_array("features"))
        return df.withColumn(self.column, total)

    def save(self, path: str) -> None:
        super().save(path)
        state = json.dumps({"start": self.start, "rate": self.rate})
        self.nodes.sparkSession.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{path}/steps")

    @classmethod
    def load(cls, path: str) -> "BoostedModel":
        forest = ForestModel.load(path)
        state = json.loads(SparkSession.getActiveSession().read.text(f"{path}/steps", wholetext=True).first()["value"])
        return cls(forest.nodes, forest.cuts, forest.trees, **state)


_NODES = "tree int, root bigint, node bigint, col int, code int, first bigint, value double, gain double"


def _unit(bound: float, bits: int) -> float:
    """A power of two of which numbers up to twice the bound are less than 2^bits."""
    return 2.0 ** (math.frexp(bound)[1] + 1 - bits)


def fit_boosted(rows: DataFrame, cuts: list[np.ndarray], trees: int, rate: float, grow: str = "leafwise", write_trees: int = WRITE_TREES, **options) -> BoostedModel:
    """Boosting of the squared error over (label, codes); rows without a label are left out.

    `grow` is leafwise (options leaves, min_leaf) or symmetric (depth, min_leaf). Without a column, or once no split lowers the error,
    no more trees are grown: a later one could not find a split either.
    """
    growers = {"leafwise": leafwise, "symmetric": symmetric}
    if grow not in growers:
        raise ValueError(f"{grow} is no way to grow a tree")
    spark = rows.sparkSession
    y = F.col("label")
    rows = rows.where(y.isNotNull() & ~F.isnan(y))
    seen = rows.agg(F.count("*").alias("n"), F.min(y).alias("low"), F.max(y).alias("high")).first()
    if not seen["n"]:
        raise ValueError("A fit needs a labelled row")
    bits = min(VALUE_BITS, SUM_BITS - seen["n"].bit_length())
    unit = _unit(max(abs(seen["low"]), abs(seen["high"])), bits)
    start = rows.agg(F.sum(F.rint(y / F.lit(unit)).cast("bigint")).alias("s")).first()["s"] / seen["n"] * unit
    spread = max(seen["high"] - start, start - seen["low"])
    cells = Cells(np.array([len(own) + 1 for own in cuts], np.int64))
    nodes: list[tuple] = []
    grown = 0
    if cuts and seen["high"] > seen["low"]:
        unit = _unit(spread, bits)
        tasks = pass_tasks(spark, seen["n"], TASK_ROWS)
        state = materialize(packed(rows.select((y - F.lit(start)).alias("residual"), "codes").repartition(tasks), ("residual",), len(cuts)), GROUP_BYTES)
        done: list = []

        at_once = max(1, HISTOGRAM_BYTES // (16 * Joint(cells.sizes).count))

        def fill(shape, leaves: Sequence[int]) -> np.ndarray:
            if len(leaves) > at_once:
                return np.concatenate([fill(shape, leaves[i : i + at_once]) for i in range(0, len(leaves), at_once)])
            known = spark.sparkContext.broadcast((done, rate, shape, np.array(leaves, np.int64), unit))
            found = state.coalesce(tasks).mapInArrow(_sum_cells(known, cells), "cell bigint, n bigint, m bigint")
            if tasks * len(leaves) * cells.count * 24 > COLLECT_BYTES:
                found = found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
            table = found.toArrow()
            sums = np.zeros((2, len(leaves) * cells.count), np.int64)
            for own, x in zip(sums, ("n", "m")):
                np.add.at(own, table.column("cell").to_numpy(), table.column(x).to_numpy())
            known.unpersist()
            return np.ascontiguousarray(sums.reshape(2, len(leaves), cells.count).transpose(1, 0, 2))

        for t in range(trees):
            shape, totals = growers[grow](fill, cells, **options)
            values = np.array([m / n * unit if n else 0.0 for n, m in totals])
            if len(values) == 1:
                break
            if grow == "leafwise":
                tree, shape = shape, _arrays(shape)
                tree.value = values.tolist()
            else:
                tree = _as_tree(shape, values)
            nodes += [(t, -1, i, tree.column[i], tree.code[i], tree.left[i], tree.value[i], tree.gain[i]) for i in range(len(tree.column))]
            grown = t + 1
            done.append((shape, values))
            if len(done) == write_trees and grown < trees:
                known = spark.sparkContext.broadcast((done, rate))
                after = materialize(state.coalesce(tasks).mapInArrow(_write_residuals(known, len(cuts)), state.schema), GROUP_BYTES)
                discard(state)
                state, done = after, []
        discard(state)
    return BoostedModel(spark.createDataFrame(nodes, _NODES), cuts, grown, float(start), float(rate))


class Boosted:
    """Estimator with the settings of the family; fit(design) takes (row_id, features, label)."""

    def __init__(self, trees: int, rate: float, bins: int, grow: str, row_id: str = "_id", **options):
        self.trees, self.rate, self.bins, self.grow, self.row_id, self.options = trees, rate, bins, grow, row_id, options

    def fit(self, design: DataFrame) -> BoostedModel:
        width = len(design.first()["features"])
        cuts = cut_points(design, width, self.bins)
        rows = materialize(binned(design, self.row_id, cuts))
        model = fit_boosted(rows.select("label", "codes"), cuts, self.trees, self.rate, self.grow, **self.options)
        discard(rows)
        return model
