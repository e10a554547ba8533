"""Global order without a single-partition window: range partitions plus per-partition offsets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import materialize

POSITION_BITS = 33  # fixed value: monotonically_increasing_id keeps the partition above bit 33


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partitioned, sorted and written, with (_part, _offset) fixed by the write."""
    position = F.monotonically_increasing_id()
    return materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", position)
        .withColumn("_part", F.shiftright("_position", POSITION_BITS))
        .withColumn("_offset", F.col("_position").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))
        .drop("_position")
    )


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Position 0..n-1 in the given total order."""
    placed = _placed(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so the ordered window below is small whatever the data size.
    starts = materialize(placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    ))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_offset"))
        .drop("_part", "_offset", "_start")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, amount: str, name: str
) -> DataFrame:
    """Inclusive running sum of `amount` by `order` within `keys`; a key may span many tasks.

    `order` must be unique within the keys (pre-aggregate equal values first).
    """
    return running_totals(df, keys, order, {amount: name})


def running_totals(df: DataFrame, keys: Sequence[str], order: str, amounts: Mapping[str, str]) -> DataFrame:
    """The same for several amounts, each with the name of its sum, in one order."""
    placed = _placed(df, [*map(F.col, keys), F.col(order)])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        placed.groupBy(*keys, "_part")
        .agg(*[F.sum(a).alias(f"_amount_{n}") for a, n in amounts.items()])
        .select(*keys, "_part", *[F.coalesce(F.sum(f"_amount_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in amounts.values()])
    )
    inside = (
        Window.partitionBy(*keys, "_part")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.join(starts, [*keys, "_part"])
        .withColumns({n: F.col(f"_start_{n}") + F.sum(a).over(inside) for a, n in amounts.items()})
        .drop("_part", "_offset", *[f"_start_{n}" for n in amounts.values()])
    )
