"""Features, encoders and comparables: learned on training rows only, own label never seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyst.functions.hashing import hash_fold
from tabulyst.operators.encode import OneHotEncoder, TargetEncoder
from tabulyst.operators.features import RoleFeatures
from tabulyst.operators import knn, quantile
from tabulyst.operators.knn import PeerComparables
from tabulyst.operators.quantile import quantile_table
from tabulyst.roles import LISTING, ORDER_LISTING
from tabulyst.sources.demo import make_listings


@pytest.fixture(scope="module")
def demo(spark):
    return make_listings(spark, 60).cache()


def test_target_encoding_leaves_out_the_own_fold(spark):
    rows = [(str(i), f"unique_{i}", float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, cat string, y double")
    df = df.withColumn("fold", hash_fold(F.col("id"), 4, "t"))

    def encoded(frame, **options):
        encoder = TargetEncoder(4, **options).fit(frame, [], ["cat"], "y", "fold")
        return encoder, {r["id"]: r["cat_encoded"] for r in encoder.transform(frame, True).collect()}

    changed = df.withColumn("y", F.when(F.col("id") == "0", 1e6).otherwise(F.col("y")))
    encoder, before = encoded(df)
    assert before["0"] == encoded(changed)[1]["0"]
    assert before == pytest.approx(encoded(df, map_keys=0)[1])
    new = spark.createDataFrame([("x", "unseen")], "id string, cat string")
    assert encoder.transform(new).first()["cat_encoded"] == pytest.approx(9.5)


def test_onehot_of_a_new_category_is_zero(spark):
    df = spark.createDataFrame([("1", "b"), ("2", "a")], "id string, c string")
    encoder = OneHotEncoder().fit(df, [], ["c"])
    assert encoder.columns == ["c_a", "c_b"]
    new = spark.createDataFrame([("3", "z")], "id string, c string")
    assert encoder.transform(new).first()["_onehot0"].toArray().tolist() == [0.0, 0.0]
    cases = spark.createDataFrame([("1", "Gd"), ("2", "GD"), ("3", None), ("4", "a.b")], "id string, `c.d` string")
    encoder = OneHotEncoder().fit(cases, [], ["c.d"])
    assert encoder.columns == ["c.d_GD", "c.d_Gd", "c.d_a.b"] and encoder.inputs == ["_onehot0"]
    found = {r["id"]: r["_onehot0"].toArray().tolist() for r in encoder.transform(cases).collect()}
    assert found == {"1": [0, 1, 0], "2": [1, 0, 0], "3": [0, 0, 0], "4": [0, 0, 1]}


def test_group_statistics_are_frozen(spark, demo):
    features = RoleFeatures(LISTING, "extended").fit(demo)
    two = demo.limit(2).withColumn("Neighborhood", F.lit("NewNeighborhood"))
    before = {r["Id"]: r["SF_Rel_to_Nbhd"] for r in features.transform(two).collect()}
    first, second = sorted(before)
    moved = two.withColumn(
        "TotalBsmtSF", F.when(F.col("Id") == second, 1e6).otherwise(F.col("TotalBsmtSF"))
    )
    after = {r["Id"]: r["SF_Rel_to_Nbhd"] for r in features.transform(moved).collect()}
    assert after[first] == before[first] and after[second] != before[second]
    again = RoleFeatures(LISTING, "extended").fit(demo.repartition(3))
    assert features.groups.mapping == again.groups.mapping


def test_drop_policy(spark, demo):
    gone = demo.withColumn("LotFrontage", F.lit(None).cast("double"))
    features = RoleFeatures(LISTING, "original", "drop").fit(gone)
    assert "LotFrontage" not in features.transform(gone).columns
    assert not {"SalePrice", "Id"} & {*features.numeric_columns(), *features.categorical_columns()}


def brute(train, asked, k=5):
    def axes(f):
        return np.stack([f.size_a + f.size_b + f.size_c, f.quality, f.year_sold - f.year_built], 1)

    points, wanted = axes(train), axes(asked)
    median = np.nanmedian(points, 0)
    points = np.where(np.isnan(points), median, points)
    wanted = np.where(np.isnan(wanted), median, wanted)
    scale = points.std(0)
    scale[scale == 0] = 1
    out = []
    for place, group in zip(wanted, asked.grp):
        gap = 1.0 if group not in set(train.grp) else np.where(train.grp == group, 0.0, 2.0)
        d2 = (((points - place) / scale) ** 2).sum(1) + gap
        best = np.lexsort((train.id.to_numpy(str), d2))[:k]
        near, price = d2[best], train.label.to_numpy()[best]
        weight = (near == 0).astype(float) if (near == 0).any() else 1 / np.sqrt(near)
        out.append((weight * price).sum() / weight.sum())
    return np.array(out)


def listing_frame(spark, n=700):
    from tabulyst.functions.hashing import uniform

    def u(name):
        return uniform(F.col("id"), name)

    # One hot group, one tiny group, many equal points, a far outlier and a constant axis.
    df = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(u("g") < 0.5, "hot").when(F.col("id") < 3, "tiny").otherwise(
            F.concat(F.lit("g"), F.floor(u("g2") * 4))).alias("grp"),
        F.floor(u("a") * 40).cast("double").alias("size_a"),
        F.when(u("nb") > 0.2, F.floor(u("b") * 40)).cast("double").alias("size_b"),
        F.when(F.col("id") == 5, 1e6).otherwise(1.0).alias("size_c"),
        F.floor(u("q") * 5).cast("double").alias("quality"),
        F.lit(2000.0).alias("year_sold"), F.lit(1990.0).alias("year_built"),
        (u("y") * 1000 + 1).alias("label"),
        F.lit("x").alias("segment"), F.lit("x").alias("status"),
        F.lit(1.0).alias("full_cnt"), F.lit(1.0).alias("half_cnt"), F.lit(0.0).alias("acctbal"),
    )
    return df.withColumn("fold", hash_fold(F.col("id"), 3, "t")).cache()


def test_comparables_equal_brute_force(spark):
    df = listing_frame(spark)
    frame = df.toPandas()
    peers = PeerComparables(ORDER_LISTING, cell_bits=3).fit(df, "label")
    asked = df.withColumn("grp", F.when(F.col("id") % 10 == 0, "new").otherwise(F.col("grp")))
    found = peers.transform(asked).toPandas()
    np.testing.assert_allclose(found.Peer_Comp_Price, brute(frame, found), rtol=1e-9)

    crossed = PeerComparables(ORDER_LISTING, cell_bits=3).fit_folds(df, "label", "fold", 3)
    found = crossed.transform(df, fold="fold").toPandas()
    for fold, part in found.groupby("fold"):
        np.testing.assert_allclose(part.Peer_Comp_Price, brute(frame[frame.fold != fold], part), rtol=1e-9)


def test_comparables_with_fewer_rows_than_neighbours(spark):
    df = listing_frame(spark, 3)
    found = PeerComparables(ORDER_LISTING).fit(df, "label").transform(df).toPandas()
    np.testing.assert_allclose(found.Peer_Comp_Price, brute(df.toPandas(), found, 3), rtol=1e-9)


def test_folds_share_one_pass_for_medians(spark, monkeypatch):
    calls = []

    def counting(*args, **options):
        calls.append(1)
        return quantile_table(*args, **options)

    monkeypatch.setattr(quantile, "quantile_table", counting)
    monkeypatch.setattr(knn, "quantile_table", counting, raising=False)
    rows = [(f"{i:03d}", 10.0 + i, None if i % 9 == 0 else float(i % 7), 2000.0, 1.0 * i, 2.0, 3.0, None, "g", i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, label double, quality double, year_sold double, size_a double, size_b double, "
                                     "size_c double, year_built double, grp string, fold int")
    peers = PeerComparables(ORDER_LISTING, cell_bits=3).fit_folds(df, "label", "fold", 3)
    assert len(calls) == 1
    for fold, (size, quality, age) in enumerate(peers.axes.medians):
        others = [r for r in rows if r[-1] != fold]
        assert size == np.median([r[4] + 5.0 for r in others]) and age == 0.0
        assert quality == np.median([r[2] for r in others if r[2] is not None])
