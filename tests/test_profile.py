"""Descriptive tables against pandas and MLlib."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabulyst.operators import ordering, profile
from tabulyst.operators.profile import (
    category_counts, correlation_p_value, histogram, missing_profile, numeric_summary, pearson_matrix,
    spearman_target,
)
from tabulyst.scratch import materialize
from tabulyst.sources.sinks import write_table


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 400
    x = rng.integers(0, 20, n).astype(float)
    return pd.DataFrame({
        "x": np.where(rng.random(n) < 0.2, np.nan, x),
        "z": rng.normal(size=n) * 1e6 + 1e9,
        "same": 0.1,
        "y": x * 3 + rng.integers(0, 30, n),
        "c": np.where(rng.random(n) < 0.1, None, np.where(x > 9, " a", "a")),
    })


@pytest.fixture(scope="module")
def df(spark, frame):
    plain = frame.astype(object).where(frame.notna(), None)
    return spark.createDataFrame(plain, "x double, z double, same double, y double, c string")


def test_correlations(df, frame):
    names = ["x", "z", "same", "y"]
    found = {(r["feature_x"], r["feature_y"]): r["pearson"] for r in pearson_matrix(df, names).collect()}
    expected = frame[names].corr()
    assert len(found) == 16
    for a in names:
        for b in names:
            if "same" in (a, b):
                assert found[a, b] is None
            else:
                assert found[a, b] == pytest.approx(expected.loc[a, b], abs=1e-9)


def test_rank_correlation_and_p_value(spark, df, frame):
    rows = {r["feature"]: r for r in spearman_target(df, ["x", "z", "same"], "y").collect()}
    assert set(rows) == {"x", "z"}
    valid = frame.dropna(subset="x")
    ranks = pd.DataFrame({"a": valid.x.rank(), "b": valid.y.rank()})
    assert rows["x"]["spearman"] == pytest.approx(ranks.a.corr(ranks.b), abs=1e-12)
    assert rows["x"]["rows"] == len(valid)
    z = pd.DataFrame({"a": frame.z.rank(), "b": frame.y.rank()})
    design = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame(z))
    fit = LinearRegression(labelCol="b", solver="normal").fit(design)
    assert rows["z"]["p_value"] == pytest.approx(fit.summary.pValues[0], rel=1e-6)
    assert correlation_p_value(1.0, 10) == 0.0 and correlation_p_value(0.3, 2) is None
    assert correlation_p_value(0.001, 1_000_000) == pytest.approx(correlation_p_value(0.001, 1_000_004), rel=1e-3)


def test_tables(df, frame):
    gone = {r["column"]: r["missing_rows"] for r in missing_profile(df).collect()}
    assert gone == {c: int(frame[c].isna().sum()) for c in frame}
    row = numeric_summary(df, ["x"]).first()
    expected = frame.x.describe()
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("q25", "25%"), ("max", "max")]:
        assert row[ours] == pytest.approx(expected[theirs])
    counts = {r["category"]: r["rows"] for r in category_counts(df, ["c"]).collect()}
    assert counts == frame.c.fillna("Missing").value_counts().to_dict()
    bins = histogram(df, ["y"]).orderBy("bin").collect()
    assert [r["rows"] for r in bins] == np.histogram(frame.y, 30)[0].tolist()
    flat = histogram(df, ["same"]).agg(F.sum("rows"), F.count("*")).first()
    assert list(flat) == [400, 30]


def test_written_counts_descend(spark, tmp_path):
    rows = [(f"k{i % 13}", f"t{i % 3}") for i in range(200)] + [(None, None)] * 30
    counts = category_counts(spark.createDataFrame(rows, "a string, b string").repartition(4), ["a", "b"])
    write_table(counts, str(tmp_path), "counts", ("feature", F.desc("rows"), "category"))
    files = sorted((tmp_path / "counts").glob("part-*.parquet"))
    read = pd.concat([pd.read_parquet(f) for f in files], ignore_index=True)
    pd.testing.assert_frame_equal(
        read, read.sort_values(["feature", "rows", "category"], ascending=[True, False, True], ignore_index=True))
    assert len(read) == 14 + 4 and read["rows"].sum() == 2 * len(rows)
    assert read.iloc[0].tolist() == ["a", "Missing", 30]


def test_ranks_order_the_label_once(spark, tmp_path, monkeypatch):
    """What is written between stages grows with the rows, not with rows times columns."""
    rng = np.random.default_rng(5)
    n = 3000
    frame = pd.DataFrame({f"v{i}": rng.integers(0, 12, n).astype(float) for i in range(8)})
    frame["gaps"] = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
    frame["none"] = np.nan
    frame["y"] = np.where(rng.random(n) < 0.4, 7.0, np.arange(n) / 8)
    frame.loc[:20, "y"] = np.nan
    plain = frame.astype(object).where(frame.notna(), None)
    df = spark.createDataFrame(plain, ", ".join(f"{c} double" for c in frame))
    written = []

    def counting(stage):
        out = materialize(stage)
        written.append(out.count())
        return out

    monkeypatch.setattr(ordering, "materialize", counting)
    monkeypatch.setattr(profile, "materialize", counting, raising=False)
    columns = [c for c in frame if c != "y"]
    found = {r["feature"]: r for r in spearman_target(df, columns, "y").collect()}
    assert set(found) == set(columns) - {"none"}
    for name in found:
        pair = frame[[name, "y"]].dropna().rank()
        assert found[name]["rows"] == len(pair)
        assert found[name]["spearman"] == pytest.approx(pair[name].corr(pair.y), abs=1e-12)
    assert sum(written) < 2 * n + 500
    nothing = spearman_target(df, ["none"], "y")
    assert nothing.collect() == [] and nothing.columns == ["feature", "rows", "spearman", "p_value"]
