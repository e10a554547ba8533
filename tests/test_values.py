"""Text cleaning, quantiles, order, splits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulyst.functions.text import clean_category, null_if_token, parse_money, parse_number
from tabulyst.operators.metrics import metric_summary
from tabulyst.operators.ordering import running_total, with_row_index
from tabulyst.operators.quantile import column_quantiles, quantile_table
from tabulyst.operators.split import kfold, split_rows


def test_text_to_value(spark):
    cases = {
        " 12 ": 12.0, "1d": None, "inf": None, "NaN": None, "-.5e1": -5.0, "5.": 5.0, "1e999": None,
        "": None, " 7\t": 7.0, "abc": None, "+3": 3.0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    found = {r["t"]: r["v"] for r in df.select("t", parse_number(F.col("t")).alias("v")).collect()}
    assert found == cases
    row = df.limit(1).select(
        parse_money(F.lit("$1,200.50")), clean_category(F.lit(" \ta b\n")), clean_category(F.lit("  ")),
        clean_category(F.lit(None).cast("string")), null_if_token(F.lit("N/A")), null_if_token(F.lit("x")),
    ).first()
    assert list(row) == [1200.5, "a b", "Missing", "Missing", None, "x"]


def test_exact_quantiles_on_both_paths(spark):
    rng = np.random.default_rng(1)
    n = 3000
    frame = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 5, n).astype(str)),
        "a": np.where(rng.random(n) < 0.3, 7.0, rng.normal(size=n) ** 9),
        "b": np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 4, n)),
    })
    df = spark.createDataFrame(frame).withColumn("b", F.nanvl("b", F.lit(None).cast("double")))
    probs = [0.0, 0.1, 0.5, 0.93, 1.0]
    for limit in (10**6, 600):
        found = column_quantiles(df, ["a", "b"], probs, direct_values=limit)
        for c in ("a", "b"):
            expected = np.nanquantile(frame[c], probs)
            np.testing.assert_allclose([found[c][p] for p in probs], expected, rtol=1e-12)
        grouped = quantile_table(df, ["a"], [0.5], ["g"], direct_values=limit).collect()
        medians = frame.groupby("g")["a"].median()
        assert len(grouped) == len(medians)
        for row in grouped:
            assert row["value"] == pytest.approx(medians[row["g"]], rel=1e-12)


def test_quantiles_and_metrics_alike_on_both_paths(spark):
    """Null keys, groups without a value and columns without any give equal rows beyond the bound."""
    rows = [(None if i % 5 == 0 else f"g{i % 5}", float(i % 37), None, 3.0) for i in range(900)]
    rows += [("empty", None, None, 1.0)] * 3
    df = spark.createDataFrame(rows, "g string, a double, b double, p double")
    both = [
        {(r["g"], r["column"], r["prob"]): r["value"] for r in quantile_table(df, ["a", "b"], [0.25, 0.5], ["g"], direct_values=n).collect()}
        for n in (10**6, 600)
    ]
    assert both[0].keys() == both[1].keys() and len(both[0]) == 6 * 4
    for key, value in both[0].items():
        assert both[1][key] == (value if value is None else pytest.approx(value, rel=1e-12))
    for n in (10**6, 600):
        assert column_quantiles(df, ["b"], [0.5], direct_values=n) == {"b": {0.5: None}}
        assert column_quantiles(df.limit(0), ["a"], [0.5], direct_values=n) == {"a": {0.5: None}}
    known = df.where("a is not null").withColumn("a", F.col("a") + 1)
    small, large = (
        {r["g"]: tuple(r)[1:] for r in metric_summary(known, "a", "p", ["g"], direct_values=n).collect()} for n in (10**6, 100)
    )
    assert small.keys() == large.keys() == {None, "g1", "g2", "g3", "g4"}
    for key in small:
        assert large[key] == pytest.approx(small[key], rel=1e-12)


def test_order_without_a_single_partition(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000).repartition(5)
    rows = with_row_index(df, [F.col("v")]).collect()
    assert len(rows) == 1000 and all(r["row_index"] == r["v"] for r in rows)
    total = running_total(df.withColumn("k", F.col("id") % 2), ["k"], "v", "id", "t").toPandas()
    expected = total.sort_values("v").groupby("k")["id"].cumsum()
    assert (total.loc[expected.index, "t"] == expected).all()


def test_split_and_folds_are_exact_and_stable(spark):
    df = spark.range(100).select(F.format_string("%04d", "id").alias("id"))
    parts = split_rows(df, "id", 42, 0.20, 0.16, 2)
    sizes = {r["partition"]: r["count"] for r in parts.groupBy("partition").count().collect()}
    assert sizes == {"holdout": 20, "validation": 16, "train": 64}
    again = split_rows(df.repartition(7), "id", 42, 0.20, 0.16, 2)
    assert parts.exceptAll(again).count() == 0
    folds = kfold(df.limit(11), "id", 4, 44).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [3, 3, 3, 2]
    with pytest.raises(ValueError):
        split_rows(df.limit(6), "id", 42, 0.2, 0.16, 3)
