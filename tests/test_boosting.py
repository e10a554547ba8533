"""Leaf-wise and symmetric trees against plain loops over rows; one model however the rows are dealt."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyst.operators import boosting
from tabulyst.operators.boosting import BoostedModel, fit_boosted
from tabulyst.operators.select import assemble


def rows_of(seed, n=300, codes=9, columns=4):
    draw = np.random.default_rng(seed)
    table = draw.integers(0, codes, (n, columns)).astype(np.uint8)
    label = table[:, 0] * 3 + (table[:, 1] > 4) * (table[:, 2] + 1) * 5 + draw.integers(-4, 5, n)
    return table, label.astype(np.int64)


def filler(codes, label, cells):
    """Sums of the leaves from the rows at hand."""

    def fill(shape, leaves):
        at = boosting._leaf(shape, codes)
        out = np.zeros((len(leaves), 2, cells.count), np.int64)
        for k, leaf in enumerate(leaves):
            for i in range(codes.shape[1]):
                for row in np.flatnonzero(at == leaf):
                    out[k, 0, cells.start[i] + codes[row, i]] += 1
                    out[k, 1, cells.start[i] + codes[row, i]] += label[row]
        return out

    return fill


def fall(label, low, min_leaf):
    """How far a split lowers the squared error, as a fraction; 0 where a side is too small."""
    sides = [label[low], label[~low]]
    if min(map(len, sides)) < max(min_leaf, 1):
        return Fraction(0)
    square = lambda y: Fraction(int(y.sum()) ** 2, len(y))
    return square(sides[0]) + square(sides[1]) - square(label)


def splits(codes, label, rows, size, min_leaf):
    return [(fall(label[rows], codes[rows, i] <= c, min_leaf), i, c) for i in range(codes.shape[1]) for c in range(size)]


def best_first(codes, label, leaves, min_leaf, size):
    """Mean of each row's leaf: always split the leaf of the greatest fall."""
    parts = [np.arange(len(label))]
    while len(parts) < leaves:
        found = [max(splits(codes, label, rows, size, min_leaf), key=lambda s: s[0]) for rows in parts]
        k = max(range(len(parts)), key=lambda i: found[i][0])
        gain, i, c = found[k]
        if gain <= 0:
            break
        low = codes[parts[k], i] <= c
        parts += [parts[k][low], parts[k][~low]]
        del parts[k]
    out = np.zeros(len(label))
    for rows in parts:
        out[rows] = label[rows].sum() / len(rows)
    return out


def level_wise(codes, label, depth, size):
    """Mean of each row's leaf: one split for all nodes of a level."""
    parts = [np.arange(len(label))]
    for _ in range(depth):
        whole = [splits(codes, label, rows, size, 1) for rows in parts if len(rows)]
        total = [(sum(s[k][0] for s in whole), *whole[0][k][1:]) for k in range(len(whole[0]))]
        gain, i, c = max(total, key=lambda s: s[0])
        if gain <= 0:
            break
        parts = [rows[side] for rows in parts for side in (codes[rows, i] <= c, codes[rows, i] > c)]
    out = np.zeros(len(label))
    for rows in parts:
        if len(rows):
            out[rows] = label[rows].sum() / len(rows)
    return out


@pytest.mark.parametrize("seed,leaves,min_leaf", [(0, 2, 1), (1, 7, 1), (2, 31, 5), (3, 31, 1), (4, 400, 1), (5, 12, 40), (6, 1, 1)])
def test_leafwise_trees_are_brute_force(seed, leaves, min_leaf):
    codes, label = rows_of(seed)
    cells = boosting.Cells(np.full(4, 9))
    tree, totals = boosting.leafwise(filler(codes, label, cells), cells, leaves, min_leaf)
    values = np.array([m / n for n, m in totals])
    found = values[boosting._leaf(boosting._arrays(tree), codes)]
    assert found == pytest.approx(best_first(codes, label, leaves, min_leaf, 9), abs=1e-12)
    assert sum(c < 0 for c in tree.column) <= leaves
    sizes = np.bincount(boosting._leaf(boosting._arrays(tree), codes))
    assert sizes[sizes > 0].min() >= min_leaf


@pytest.mark.parametrize("seed,depth", [(0, 1), (1, 3), (2, 6), (3, 9)])
def test_symmetric_trees_are_brute_force(seed, depth):
    codes, label = rows_of(seed)
    cells = boosting.Cells(np.full(4, 9))
    bits, totals = boosting.symmetric(filler(codes, label, cells), cells, depth)
    assert len(bits) <= depth and len(totals) == 2 ** len(bits)
    values = np.array([m / n if n else 0.0 for n, m in totals])
    found = values[boosting._leaf(bits, codes)]
    assert found == pytest.approx(level_wise(codes, label, depth, 9), abs=1e-12)
    tree = boosting._as_tree(bits, values)
    assert np.array(tree.value)[boosting._leaf(boosting._arrays(tree), codes)] == pytest.approx(found)


@pytest.fixture(scope="module")
def table(spark):
    codes, label = rows_of(7, n=500)
    rows = [(float(y) / 8, bytes(c)) for c, y in zip(codes, label)]
    return codes, label / 8, spark.createDataFrame(rows, "label double, codes binary").cache()


def features(spark, codes):
    rows = [(i, *map(float, c)) for i, c in enumerate(codes)]
    return assemble(spark.createDataFrame(rows, "id int, a double, b double, c double, d double"), list("abcd"))


def scored(model, spark, codes):
    found = model.setPredictionCol("p").transform(features(spark, codes)).select("id", "p").collect()
    return np.array([r["p"] for r in sorted(found)])


CUTS = [np.arange(8.0)] * 4


@pytest.mark.parametrize("grow,options,tree", [
    ("leafwise", {"leaves": 6, "min_leaf": 3}, lambda c, y: best_first(c, y, 6, 3, 9)),
    ("symmetric", {"depth": 3}, lambda c, y: level_wise(c, y, 3, 9)),
])
def test_boosting_is_brute_force(spark, table, grow, options, tree, tmp_path):
    codes, label, rows = table
    model = fit_boosted(rows, CUTS, 5, 0.3, grow, write_trees=2, **options)
    want = np.full(len(label), label.mean())
    for _ in range(5):
        # Residuals in whole units of 2^-30, so that the fractions of the brute force stay exact.
        want += 0.3 * tree(codes, np.rint((label - want) * 2.0**30).astype(np.int64)) / 2.0**30
    assert scored(model, spark, codes) == pytest.approx(want, abs=1e-6)
    model.save(str(tmp_path / "m"))
    assert (scored(BoostedModel.load(str(tmp_path / "m")), spark, codes) == scored(model, spark, codes)).all()


@pytest.mark.parametrize("grow", ["leafwise", "symmetric"])
def test_order_of_rows_is_no_matter(spark, table, grow, monkeypatch):
    rows = table[2]
    monkeypatch.setattr(boosting, "TASK_ROWS", 40)
    models = [fit_boosted(df, CUTS, 3, 0.1, grow, write_trees=2, min_leaf=2) for df in (rows.repartition(1), rows.orderBy(F.rand(3)).repartition(13))]
    one, two = (sorted(map(tuple, m.nodes.collect())) for m in models)
    assert one == two and len(one) > 9 and models[0].start == models[1].start


def test_odd_rows(spark, table):
    rows = table[2]
    odd = rows.limit(0).unionByName(spark.createDataFrame([(None, b"\0\0\0\0"), (float("nan"), b"\1\0\0\0"), (2.5, b"\1\2\0\0"), (2.5, b"\7\2\0\0")], rows.schema))
    for grow in ("leafwise", "symmetric"):
        model = fit_boosted(odd, CUTS, 4, 0.1, grow)
        assert model.trees == 0 and scored(model, spark, np.zeros((2, 4), np.uint8)).tolist() == [2.5, 2.5]
        assert fit_boosted(odd, [], 4, 0.1, grow).start == 2.5
        with pytest.raises(ValueError):
            fit_boosted(rows.limit(0), CUTS, 4, 0.1, grow)
    with pytest.raises(ValueError):
        fit_boosted(rows, CUTS, 4, 0.1, "sideways")


def test_repeated_rows_weigh_as_often_as_they_stand(spark, table):
    rows = table[2]
    one, two = fit_boosted(rows, CUTS, 2, 0.1, min_leaf=2), fit_boosted(rows.union(rows), CUTS, 2, 0.1, min_leaf=4)
    shape = ["tree", "node", "col", "code", "first"]
    assert sorted(map(tuple, one.nodes.select(*shape).collect())) == sorted(map(tuple, two.nodes.select(*shape).collect()))


def test_equal_residuals_have_no_split_however_large_their_sums():
    rows = np.array([3_000_001, 1_234_567, 8_999_999, 1, 4_765_433], np.int64)
    for residual in (-123_456_789_123, 98_765_432_109):
        n = int(rows.sum())
        low = np.stack([rows.cumsum(), rows.cumsum() * residual])
        assert (boosting._gains(low, (n, n * residual), 1) == 0).all()
        low[1, 2:] += 1
        found = boosting._gains(low, (n, n * residual + 1), 1)
        exact = [(int(b) * n - (n * residual + 1) * int(a)) ** 2 / (int(a) * (n - int(a)) * n) if a < n else 0 for a, b in low.T]
        assert found == pytest.approx(exact, rel=1e-12) and found.max() > 0


@pytest.mark.parametrize("grow", ["leafwise", "symmetric"])
def test_sums_added_by_the_driver_are_those_of_spark(spark, table, grow, monkeypatch):
    rows = table[2]
    monkeypatch.setattr(boosting, "TASK_ROWS", 40)
    one = fit_boosted(rows, CUTS, 3, 0.1, grow, write_trees=2, min_leaf=2)
    monkeypatch.setattr(boosting, "COLLECT_BYTES", 0)
    two = fit_boosted(rows, CUTS, 3, 0.1, grow, write_trees=2, min_leaf=2)
    assert sorted(map(tuple, one.nodes.collect())) == sorted(map(tuple, two.nodes.collect()))


@pytest.mark.parametrize("leaves", [6, 200, 400])
def test_leaves_by_masks_are_those_of_a_walk(leaves):
    codes, label = rows_of(3, n=900)
    cells = boosting.Cells(np.full(4, 9))
    tree, totals = boosting.leafwise(filler(codes, label, cells), cells, leaves, 1)
    shape, values = boosting._arrays(tree), np.array([m / n for n, m in totals])
    by_column = np.ascontiguousarray(codes.T)
    assert (boosting._Walk(shape).values(by_column, values) == values[boosting._leaf(shape, codes)]).all()
    bits = [(0, 3), (1, 4), (2, 0), (3, 7)]
    values = np.arange(16.0)
    walk = boosting._Walk(bits, [3, 8, 15])
    at = boosting._leaf(bits, codes)
    assert (walk.values(by_column, values) == values[at]).all()
    assert (walk.slots(by_column) == np.select([at == 3, at == 8, at == 15], [1, 2, 3])).all()
