"""Descriptive statistics: missing values, summaries, correlations, category counts, histograms."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from ..functions.text import MISSING, absent, col
from .ordering import running_total, running_totals
from .quantile import DIRECT_VALUES, quantile_table

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing_rows, missing_percent) over the raw rows; NaN counts as missing."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(absent(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_rows"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select("rows", F.inline(F.array(*cells))).select(
        "column", "missing_rows", (100 * F.col("missing_rows") / F.col("rows")).alias("missing_percent")
    )


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    typed = df.select(*map(col, keep), *[col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(map(col, keep)), list(map(col, columns)), "column", "v")


def numeric_summary(
    df: DataFrame, columns: Sequence[str], direct_values: int = DIRECT_VALUES
) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles, max per numeric column."""
    typed = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = typed.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in parts.items()])
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in parts])
        for i, c in enumerate(columns)
    ]
    moments = wide.select(F.inline(F.array(*cells)))
    quartiles = quantile_table(df, columns, list(QUARTILES), direct_values=direct_values)
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in QUARTILES.items()]
    )
    return moments.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_x, feature_y, pearson) over pairwise complete rows, null for a constant side.

    Each task multiplies its masked, centred batches, so a task emits one partial row per pair and
    the shuffle does not grow with the rows.
    """
    columns = list(columns)
    names = [f"c{i}" for i in range(len(columns))]
    plain = df.select(*[col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    centre = plain.agg(*[F.avg(n).alias(n) for n in names]).first()
    shift = np.array([centre[n] if centre[n] is not None else 0.0 for n in names])
    size = len(names)
    upper = [(i, j) for i in range(size) for j in range(i, size)]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, size, size))
        for batch in batches:
            values = batch.to_numpy(dtype=float) - shift
            present = (~np.isnan(values)).astype(float)
            values = np.where(present > 0, values, 0.0)
            squares = values * values
            sums += np.stack([
                present.T @ present, values.T @ present, present.T @ values,
                squares.T @ present, present.T @ squares, values.T @ values,
            ])
        yield pd.DataFrame(
            [(i, j, *sums[:, i, j]) for i, j in upper],
            columns=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    total = plain.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    var_x = F.expr("sxx - sx * sx / nullif(n, 0)")
    var_y = F.expr("syy - sy * sy / nullif(n, 0)")
    enough = (F.col("n") > 1) & (var_x > F.expr("1e-13 * sxx")) & (var_y > F.expr("1e-13 * syy"))
    cov = F.expr("sxy - sx * sy / nullif(n, 0)")
    r = F.when(enough, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(var_x * var_y))))
    pairs = total.withColumn("pearson", r)
    mirrored = F.when(
        F.col("i") < F.col("j"),
        F.array(F.struct(F.col("i").alias("x"), F.col("j").alias("y")),
                F.struct(F.col("j").alias("x"), F.col("i").alias("y"))),
    ).otherwise(F.array(F.struct(F.col("i").alias("x"), F.col("j").alias("y"))))
    labels = F.array(*map(F.lit, columns))
    return pairs.select("pearson", F.inline(mirrored)).select(
        F.get(labels, F.col("x")).alias("feature_x"),
        F.get(labels, F.col("y")).alias("feature_y"),
        "pearson",
    )


def spearman_target(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, rows, spearman, p_value) of each numeric column against the label.

    Rows where the column is null are left out for that column; a side with one distinct value
    drops the column. Ranks come from value counts, so equal values never pile up in one task. The label
    is ordered once for all columns; what a column adds are sums for each of its distinct values. `df` is
    passed over three times.
    """
    typed = df.select(col(label).cast("double").alias("y"), *[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    rows = typed.where(F.col("y").isNotNull())
    seen = _two_sided(rows, len(columns))
    total, kept = seen["total"], [i for i in range(len(columns)) if seen[f"kept{i}"]]
    # The label's ranks are the same for all columns without a null.
    masks = {i: "c" if seen[f"n{i}"] == total else f"c{i}" for i in kept}
    counted = {"c": F.count("*")} | {f"c{i}": F.count(f"v{i}") for i, m in masks.items() if m != "c"}
    of_label = rows.groupBy("y").agg(*[n.alias(c) for c, n in counted.items()])
    ranked = running_totals(of_label, [], "y", {c: f"upto_{c}" for c in counted})
    sizes = {"c": total} | {f"c{i}": seen[f"n{i}"] for i in kept}

    def centred(upto: str, n: str, size) -> Column:
        return F.col(upto) - (F.col(n) - 1) / 2 - (size + F.lit(1)) / 2

    dealt = rows.join(ranked.select("y", *[centred(f"upto_{c}", c, F.lit(sizes[c])).alias(f"d_{c}") for c in counted]), "y")
    cells = [
        F.struct(F.lit(columns[i]).alias("feature"), F.lit(sizes[f"c{i}"]).cast("bigint").alias("rows"),
                 F.col(f"v{i}").alias("x"), F.col(f"d_{m}").alias("dy"))
        for i, m in masks.items()
    ]
    empty = F.expr("array_repeat(named_struct('feature', '', 'rows', 0L, 'x', 0d, 'dy', 0d), 0)")
    sums = (
        dealt.select(F.inline(F.array(*cells) if cells else empty))
        .where(F.col("x").isNotNull())
        .groupBy("feature", "rows", "x")
        .agg(F.count("*").alias("n"), F.sum("dy").alias("dy"), F.sum(F.col("dy") * F.col("dy")).alias("dy2"))
    )
    placed = running_total(sums, ["feature", "rows"], "x", "n", "upto")
    crossed = placed.withColumn("dx", centred("upto", "n", F.col("rows")))
    rho = F.expr("sum(dx * dy) / sqrt(sum(n * dx * dx) * sum(dy2))")
    result = crossed.groupBy("feature", "rows").agg(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho)).alias("spearman")
    )
    return result.withColumn("p_value", _two_sided_p("spearman", "rows"))


def _two_sided(rows: DataFrame, width: int) -> Row:
    """`total`, and for each v0, v1, ... its count `n` and whether it and `y` have two values there: bounded by the columns."""
    ends = []
    for v in (f"v{i}" for i in range(width)):
        y = F.when(F.col(v).isNotNull(), F.col("y"))
        ends.append(((F.min(v) != F.max(v)) & (F.min(y) != F.max(y)), F.count(v)))
    return rows.agg(
        F.count("*").alias("total"),
        *[k.alias(f"kept{i}") for i, (k, _) in enumerate(ends)], *[n.alias(f"n{i}") for i, (_, n) in enumerate(ends)],
    ).first()


@F.pandas_udf(T.DoubleType())
def _two_sided_p(rho: pd.Series, rows: pd.Series) -> pd.Series:
    return pd.Series([correlation_p_value(r, n) for r, n in zip(rho, rows)])


def correlation_p_value(rho: float, rows: int) -> float | None:
    """Two-sided p of a correlation by Student's t with rows - 2 degrees of freedom."""
    freedom = rows - 2
    if freedom < 1:
        return None
    if abs(rho) >= 1.0:
        return 0.0
    # P(|T| > t) = I(freedom / (freedom + t^2); freedom / 2, 1/2) and here that argument is 1 - rho^2.
    return _incomplete_beta(freedom / 2.0, 0.5, 1.0 - rho * rho)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x)
    front = math.exp(log_front + b * math.log1p(-x)) / a
    # Even and odd terms of the continued fraction, evaluated from the tail; it settles after about
    # the square root of the larger parameter.
    tail = 1.0
    for m in range(200 + 10 * math.isqrt(int(max(a, b)) + 1), 0, -1):
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        tail = 1.0 + odd / (1.0 + even / tail)
    return front / tail


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, rows); null counts as "Missing" and texts are not stripped."""
    texts = df.select(
        *[F.coalesce(col(c).cast("string"), F.lit(MISSING)).alias(c) for c in columns]
    )
    return (
        texts.unpivot([], list(map(col, columns)), "feature", "category")
        .groupBy("feature", "category")
        .agg(F.count("*").alias("rows"))
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """(variable, bin, lower, upper, rows): equal-width bins 1..bins, the maximum in the last one."""
    values = _long(df, columns).where(F.col("v").isNotNull())
    bounds = values.groupBy("column").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    spread = {
        r["column"]: (r["lo"] - 0.5, r["hi"] + 0.5) if r["lo"] == r["hi"] else (r["lo"], r["hi"])
        for r in bounds
    }
    edges = df.sparkSession.createDataFrame(
        [
            (c, b + 1, low + (high - low) * b / bins, low + (high - low) * (b + 1) / bins, low, high)
            for c, (low, high) in spread.items()
            for b in range(bins)
        ],
        "variable string, bin int, lower double, upper double, lo double, hi double",
    )
    scale = F.broadcast(edges.where("bin = 1").select(F.col("variable").alias("column"), "lo", "hi"))
    slot = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counted = (
        values.join(scale, "column")
        .groupBy(F.col("column").alias("variable"), (F.least(slot, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    return edges.join(counted, ["variable", "bin"], "left").select(
        "variable", "bin", "lower", "upper", F.coalesce("rows", F.lit(0)).alias("rows")
    )
