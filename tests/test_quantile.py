"""Exact quantiles against sorted values, and how little of the rows they move."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulyst.operators.quantile import CUT_ACCURACY, _bracketed, _targets, column_quantiles, quantile_table

PROBS = [0.0, 0.001, 0.25, 0.5, 0.95, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """One group with half of the rows, some small ones, one of a null key and one of nulls only; ties and nulls."""
    n = 30_000
    frame = spark.range(n).select(
        "id", F.when(F.col("id") < n // 2, "hot").when(F.col("id") % 7 == 0, None).when(F.col("id") == n - 1, "none")
        .otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("kind"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("x"), (F.pmod(F.xxhash64("id"), F.lit(9)) - 4).cast("double").alias("tied"),
    )
    return frame.withColumn("x", F.when((F.col("kind") == "none") | (F.col("id") % 11 == 0), None).otherwise(F.col("x"))).cache()


def _by_sorting(frame: pd.DataFrame, column: str, prob: float):
    values = np.sort(frame[column].dropna().to_numpy())
    if not len(values):
        return None
    at = prob * (len(values) - 1)
    low, high = int(np.floor(at)), int(np.ceil(at))
    return values[low] if at == low else (1 - (at - low)) * values[low] + (at - low) * values[high]


def test_narrowed_quantiles_are_those_of_sorted_values(rows):
    local = rows.toPandas()
    local["kind"] = local["kind"].astype(object).where(local["kind"].notna(), None)
    found = quantile_table(rows, ["x", "tied"], PROBS, by=["kind"], direct_values=100).collect()
    groups = {k: g for k, g in local.groupby("kind", dropna=False)}
    assert len(found) == len(groups) * 2 * len(PROBS)
    for r in found:
        own = local[local["kind"].isna()] if r["kind"] is None else groups[r["kind"]]
        want = _by_sorting(own, r["column"], r["prob"])
        assert (r["value"] is None and want is None) or r["value"] == pytest.approx(want, rel=1e-12), r
    whole = column_quantiles(rows, ["x", "tied"], PROBS, direct_values=100)
    assert whole == {c: {p: pytest.approx(_by_sorting(local, c, p), rel=1e-12) for p in PROBS} for c in ("x", "tied")}


def test_only_values_near_the_ranks_move(rows):
    plain = rows.select(F.struct(F.lit(0).alias("_all")).alias("g"), F.col("id").cast("double").alias("v0"))
    targets = _targets(plain, ["id"], [0.5]).cache()
    bounds = targets.first()
    assert bounds["lo"] < 14_999 and bounds["hi"] > 15_000 and bounds["below"] == bounds["lo"]
    moved = _bracketed(plain, targets, 1).count()
    assert moved <= 6 * 30_000 / CUT_ACCURACY + 2


def test_a_pass_of_counters_has_as_many_for_any_number_of_columns(rows):
    def counters(width):
        names = [f"v{i}" for i in range(width)]
        plain = rows.select(F.struct("kind").alias("g"), *[(F.col("x") + i).alias(n) for i, n in enumerate(names)])
        return _targets(plain, names, PROBS)._jdf.queryExecution().analyzed().toString().count("count_if")

    assert counters(1) == counters(9) > 0


def test_values_that_are_no_numbers_come_last(spark):
    frame = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"))
    found = column_quantiles(frame, ["x"], [0.25, 0.75], direct_values=100)["x"]
    # 2,000 odd numbers, then as many that are none: rank 999.75 lies between 1999 and 2001.
    assert found[0.25] == pytest.approx(0.25 * 1999 + 0.75 * 2001) and np.isnan(found[0.75])


def test_no_rows_have_no_quantile(spark):
    empty = spark.createDataFrame([], "kind string, x double")
    assert column_quantiles(empty, ["x"], [0.5], direct_values=0, rows=1) == {"x": {0.5: None}}
    assert quantile_table(empty, ["x"], [0.5], by=["kind"], direct_values=0, rows=1).collect() == []
