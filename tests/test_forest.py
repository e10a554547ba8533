"""The binned forest against plain loops; its two phases against each other."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabulyst.operators import forest
from tabulyst.operators.select import FeatureSelector, assemble


def brute(codes, label, weight, min_leaf, depth):
    """Prediction of each row of a tree grown by trying every split of every node."""
    out = np.zeros(len(label))

    def go(rows, left):
        w, y = weight[rows], label[rows]
        mean = (w * y).sum() / w.sum()
        best = (1e-9 * (weight * (label - (weight * label).sum() / weight.sum()) ** 2).sum(), None)
        for column in range(codes.shape[1] if left else 0):
            for code in np.unique(codes[rows, column])[:-1]:
                low = codes[rows, column] <= code
                if w[low].sum() >= min_leaf and w[~low].sum() >= min_leaf:
                    fall = (w * (y - mean) ** 2).sum() - sum((w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum() for s in (low, ~low))
                    if fall > best[0] * (1 + 1e-9):
                        best = (fall, (column, code))
        if best[1] is None:
            out[rows] = mean
            return
        low = codes[rows, best[1][0]] <= best[1][1]
        go(rows[low], left - 1)
        go(rows[~low], left - 1)

    go(np.flatnonzero(weight > 0), depth)
    return out


@pytest.mark.parametrize("seed,depth,min_leaf", [(0, 3, 1), (1, 30, 2), (2, 6, 5), (3, 0, 1)])
def test_trees_are_brute_force(seed, depth, min_leaf):
    draw = np.random.default_rng(seed)
    codes = draw.integers(0, 12, (150, 4)).astype(np.uint8)
    label = codes[:, 0] * 2.0 + (codes[:, 1] > 5) * 7 + draw.normal(size=150) + 1000
    weight = draw.integers(0, 3, 150).astype(float)
    tree = forest.grow(codes, label, weight, min_leaf, depth)
    found = np.array(tree.value)[forest._place(*forest._arrays(tree), codes)]
    some = weight > 0
    assert found[some] == pytest.approx(brute(codes, label, weight, min_leaf, depth)[some])


def test_both_ways_to_a_split_agree():
    draw = np.random.default_rng(4)
    codes, node = draw.integers(0, 256, (4000, 5)).astype(np.uint8), draw.integers(0, 9, 4000)
    weight, moment = draw.integers(1, 4, 4000).astype(float), draw.normal(size=4000)
    one = forest._best_splits(forest._histograms(codes, node, 9, weight, moment), 3)
    two = forest._sorted_splits(codes, node, 9, weight, moment, 3)
    assert one[0] == pytest.approx(two[0]) and (one[1] == two[1]).all() and (one[2] == two[2]).all()


def test_weights_are_bootstrap_draws():
    keys = np.arange(200_000, dtype=np.uint64)
    one, again, other = (forest.bootstrap_weights(keys, s, t) for s, t in ((7, 3), (7, 3), (7, 4)))
    assert (one == again).all() and one.mean() == pytest.approx(1, abs=0.02) and one.var() == pytest.approx(1, abs=0.03)
    assert abs(np.corrcoef(one, other)[0, 1]) < 0.01


@pytest.fixture(scope="module")
def design(spark):
    draw = np.random.default_rng(6)
    frame = pd.DataFrame(draw.normal(size=(900, 3)), columns=["a", "b", "c"])
    frame["d"] = draw.integers(0, 3, 900).astype(float)
    frame["label"] = np.where(frame.a > 0.5, 20.0, 0.0) + 5 * frame.d + draw.normal(size=900)
    frame["_id"] = [str(i) for i in range(900)]
    return assemble(spark.createDataFrame(frame).repartition(5), ["a", "b", "c", "d"])


def predicted(model, design):
    return {r["_id"]: r["p"] for r in model.setPredictionCol("p").transform(design).collect()}


def test_phases_give_one_forest(design, monkeypatch):
    """Nodes split by summed histograms and nodes finished in groups make the same trees, whatever the bounds."""
    whole = predicted(forest.Forest(5, 6, 3, 8).fit(design), design)
    monkeypatch.setattr(forest, "BLOCK_TREES", 4)
    monkeypatch.setattr(forest, "MODEL_BYTES", 20_000)
    for rows, size in ((60, 1 << 28), (200, 40_000), (0, 1 << 28)):
        monkeypatch.setattr(forest, "LOCAL_ROWS", rows)
        monkeypatch.setattr(forest, "HISTOGRAM_BYTES", size)
        parts = predicted(forest.Forest(5, 6, 3, 8).fit(design), design)
        same = np.array([abs(whole[i] - parts[i]) < 1e-6 for i in whole])
        # Sums are added in another order, so a split that ties with another may differ.
        assert same.mean() > 0.99


def test_forest_learns_and_is_saved(spark, design, tmp_path):
    model = forest.Forest(1, 30, 2, 30).fit(design)
    found = model.setPredictionCol("p").transform(design)
    error = found.agg(F.avg(F.pow(F.col("p") - F.col("label"), 2))).first()[0]
    assert error < 1.0
    gains = model.featureImportances
    assert gains.sum() == pytest.approx(1) and gains[0] > 0.6 and gains[3] > 0.1 > max(gains[1], gains[2])
    model.write().save(str(tmp_path / "m"))
    assert predicted(forest.ForestModel.load(str(tmp_path / "m")), design) == predicted(model, design)


def test_codes_keep_order(spark):
    df = assemble(spark.createDataFrame([(float(i % 700), 1.0) for i in range(2000)], "x double, k double"), ["x", "k"])
    cuts = forest.cut_points(df, 2)
    assert 200 <= len(cuts[0]) <= 255 and len(cuts[1]) == 0
    values = np.array([[-5.0, 1.0], [0.0, 1.0], [350.0, 1.0], [699.0, 1.0], [10**9, 1.0]])
    codes = forest.encode(values, cuts)[:, 0].tolist()
    assert codes == sorted(codes) and codes[0] == codes[1] == 0 and codes[3] == codes[4] == len(cuts[0])


def test_shadows_confirm_what_matters(spark):
    """Planted columns are confirmed. A column of noise may be by its chance correlation, as one in ten beats most shadows."""
    draw = np.random.default_rng(8)
    names = [f"x{i}" for i in range(14)]
    x = draw.normal(size=(500, 14))
    frame = pd.DataFrame(x, columns=names).assign(label=3 * x[:, 0] - 4 * x[:, 2] + draw.normal(size=500) * 0.5, id=[str(i) for i in range(500)])
    df = assemble(spark.createDataFrame(frame), names)
    selector = FeatureSelector("boruta", iterations=12, seed=3, trees=40).fit(df, names, "id")
    assert selector.support[0] and selector.support[2] and not selector.fallback
    assert sum(selector.support) <= 2 + 3
    assert selector.details["ranking"][0] == selector.details["ranking"][2] == 1


def shallow(spark, monkeypatch, dealt_rows, label=None):
    draw = np.random.default_rng(5)
    x = draw.integers(0, 40, (3000, 3)).astype(float)
    y = x[:, 0] + 5.0 * (x[:, 1] > 17) + draw.normal(size=3000) + 1000 if label is None else label(x)
    frame = pd.DataFrame({"_id": range(3000), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y})
    design = assemble(spark.createDataFrame(frame), ["a", "b", "c"]).select("_id", "features", "label")
    monkeypatch.setattr(forest, "DEALT_ROWS", dealt_rows)
    return design, forest.Forest(3, 6, 2, 5).fit(design)


def test_shallow_trees_by_histograms_are_those_of_dealt_rows(spark, monkeypatch):
    design, dealt = shallow(spark, monkeypatch, 1 << 16)
    _, filled = shallow(spark, monkeypatch, 10)
    assert filled.gains() == pytest.approx(dealt.gains(), rel=1e-9)
    price = [{r["_id"]: r["prediction"] for r in m.transform(design).collect()} for m in (dealt, filled)]
    assert price[0] == pytest.approx(price[1], rel=1e-9)
    # No row was dealt: every node is one of the top.
    assert filled.nodes.where("root >= 0").count() == 0 and dealt.nodes.where("root >= 0").count() > 0


def test_nodes_without_a_split_are_not_dealt(spark, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_ROWS", 100)
    draw = np.random.default_rng(6)
    x = draw.integers(0, 40, (3000, 2)).astype(float)
    frame = pd.DataFrame({"_id": range(3000), "a": x[:, 0], "b": x[:, 1], "label": np.where(x[:, 0] > 20, 11.3, 9.7)})
    design = assemble(spark.createDataFrame(frame), ["a", "b"]).select("_id", "features", "label")
    model = forest.Forest(3, 4, 2, 30).fit(design)
    assert model.nodes.count() == 12 and model.nodes.where("root >= 0").count() == 0
    found = model.transform(design).select("label", "prediction").toPandas()
    assert found["prediction"].to_numpy() == pytest.approx(found["label"].to_numpy())


def test_a_large_table_of_one_label_is_a_forest_of_leaves(spark, monkeypatch):
    design, model = shallow(spark, monkeypatch, 10, lambda x: np.full(len(x), 7.25))
    assert [r["prediction"] for r in model.transform(design).select("prediction").distinct().collect()] == [pytest.approx(7.25)]


def test_dealt_rows_of_a_node_travel_as_one():
    draw = np.random.default_rng(6)
    codes, label = draw.integers(0, 9, (500, 3)).astype(np.uint8), draw.normal(size=500)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(500)), pa.array(label), forest._packed(codes)], names=["key", "label", "codes"])
    tree = forest.grow(codes, label, np.ones(500), 1, 1)
    known = SimpleNamespace(value={t: (forest._arrays(tree), np.array([0, 1, 1]), np.array([False, True, True])) for t in range(4)})
    dealt = pa.Table.from_batches(forest._deal(known, 7, 3)(iter([batch])))
    assert dealt.num_rows == 8
    keys = np.arange(500, dtype=np.uint64)
    for r in dealt.to_pylist():
        weight = forest.bootstrap_weights(keys, 7, r["tree"])
        own = (weight > 0) & (forest._place(*forest._arrays(tree), codes) == r["root"])
        assert np.frombuffer(r["label"]).tolist() == label[own].tolist()
        assert np.frombuffer(r["weight"], np.uint8).tolist() == weight[own].tolist()
        assert np.frombuffer(r["codes"], np.uint8).tolist() == codes[own].ravel().tolist()


def test_splits_by_columns_are_those_of_all_columns():
    draw = np.random.default_rng(8)
    codes, node = draw.integers(0, 40, (3000, 4)).astype(np.uint8), draw.integers(0, 9, 3000)
    weight, moment = draw.integers(1, 4, 3000).astype(float), draw.normal(size=3000)
    one = forest._best_splits(forest._histograms(codes, node, 9, weight, moment), 3)
    two = forest._histogram_splits(codes, node, 9, weight, moment, 3)
    assert all((a == b).all() for a, b in zip(one, two))


def test_draws_by_leading_bits_are_those_of_all_bits():
    edges = np.concatenate([forest._LIMITS[:-1] + np.uint64(x) for x in (0, 1)] + [forest._LIMITS[:-1] - np.uint64(1)]) << np.uint64(11)
    drawn = np.concatenate([edges, np.random.default_rng(3).integers(0, 2**64, 100_000, np.uint64)])
    keys = np.arange(100_000, dtype=np.uint64)
    salt = forest._mixed(np.array([7 * 1_000_003 + 3 + 1], np.uint64) * forest._ODD)
    for hashes, found in ((drawn, None), (forest._mixed(keys ^ salt), forest._times(keys, 7, 3))):
        plain = ((hashes >> np.uint64(11)).astype(float)[:, None] / 2.0**53 >= forest._DRAWS).sum(1)
        by_bits = forest._BY_BITS[hashes >> np.uint64(48)]
        told = by_bits != forest._UNSURE
        assert told.mean() > 0.99 and (by_bits[told] == plain[told]).all()
        if found is not None:
            assert (found == plain).all()


def test_columns_counted_together_give_the_sums_of_each():
    draw = np.random.default_rng(11)
    sizes = np.array([3, 200, 16, 16, 1, 5, 256, 2])
    codes = np.stack([draw.integers(0, s, 4000) for s in sizes]).astype(np.uint8)
    joint, value, node = forest.Joint(sizes), draw.normal(size=4000), draw.integers(0, 3, 4000)
    assert len(joint.groups) < len(sizes) and sorted(sum(joint.groups, [])) == list(range(8))
    sums = np.zeros((3, joint.count))
    for start, own in zip(joint.start, joint.place(codes)):
        np.add.at(sums, (node, start + own.astype(int)), value)
    found, first = joint.apart(sums), np.concatenate(([0], sizes.cumsum()))
    for i, size in enumerate(sizes):
        for k in range(3):
            assert found[k, first[i] : first[i + 1]] == pytest.approx(np.bincount(codes[i][node == k], value[node == k], size))


def test_many_binary_columns_do_not_blow_up_the_cells():
    sizes = np.full(5000, 2)
    assert forest.Joint(sizes).count <= 2 * sizes.sum()


def test_rows_are_packed_in_blocks(spark, monkeypatch):
    frame = [(i, float(i) / 3, bytes([i % 7, i % 11])) for i in range(1000)]
    rows = spark.createDataFrame(frame, "key long, label double, codes binary").coalesce(1)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 300)
    blocks = forest.packed(rows, ("key", "label"), 2).toArrow()
    assert blocks.column("rows").to_pylist() == [300, 300, 300, 100]
    parts = list(forest.blocks_of(iter(blocks.to_batches()), ("key", "label"), 2))
    keys, labels = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    codes = np.concatenate([p[2] for p in parts], axis=1)
    assert sorted(zip(keys.tolist(), labels.tolist(), map(bytes, codes.T))) == frame


def test_only_the_smaller_sibling_is_filled(spark, monkeypatch):
    asked, fill = [], forest._fill

    def seen(known, *more):
        asked.append({t: ask.tolist() for t, (_, ask, _) in known.value[0].items()})
        return fill(known, *more)

    monkeypatch.setattr(forest, "_fill", seen)
    _, model = shallow(spark, monkeypatch, 10)
    assert asked[0] == {t: [0] for t in range(6)}
    tree = model.nodes.where("tree = 0").orderBy("node").toPandas()
    for level, nodes in enumerate(x[0] for x in asked[1:]):
        assert len({(n - 1) // 2 for n in nodes}) == len(nodes) <= 2**level
    # As many passes as levels; every split is known though no pair of siblings was filled.
    assert len(asked) == 5 and (tree["col"] >= 0).sum() > sum(len(x[0]) for x in asked)


def test_small_nodes_are_grown_in_parts_of_few_rows(monkeypatch):
    draw = np.random.default_rng(12)
    codes = draw.integers(0, 200, (6000, 3)).astype(np.uint8)
    label, weight = codes[:, 0] % 17 + draw.normal(size=6000), draw.integers(0, 3, 6000).astype(float)
    whole = forest.grow(codes, label, weight, 2, 30)
    seen, sort = [], forest._sorted_splits
    monkeypatch.setattr(forest, "_sorted_splits", lambda codes, *more: seen.append(len(codes)) or sort(codes, *more))
    monkeypatch.setattr(forest, "NEAR_ROWS", 256)
    parts = forest.grow(codes, label, weight, 2, 30)
    assert len(seen) > 20 and max(seen) <= 256
    assert len(parts.column) == len(whole.column)
    value = [np.array(t.value)[forest._place(*forest._arrays(t), codes)] for t in (whole, parts)]
    assert value[0] == pytest.approx(value[1])


def test_equal_splits_go_to_the_first_column():
    draw = np.random.default_rng(13)
    one = draw.integers(0, 250, 70_000).astype(np.uint8)
    codes = np.stack([one, one, one], axis=1)
    tree = forest.grow(codes, one + draw.normal(size=70_000) * 50, np.ones(70_000), 1, 30)
    assert set(tree.column) == {-1, 0}
