"""Exact linear-interpolated quantiles of many columns, in total or by group.

Small inputs use `percentile`, whose buffer holds every distinct value of a group. Larger ones are
narrowed first: sketches of the raw rows, merged from all tasks, bracket each wanted rank, and only the values in
the brackets move, as (value, count). What is still large is split by approximate cuts until each group is small.
Both give the same rows: one for every group, null keys included, and a null value where a group has none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import col
from ..scratch import materialize

DIRECT_VALUES = 4_000_000
SLOTS = 64
CUT_ACCURACY = 1_000


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    direct_values: int = DIRECT_VALUES,
    rows: int | None = None,
) -> DataFrame:
    """One row per group, column and prob with the exact `value`, null if there is none; nulls are skipped."""
    rows = df.count() if rows is None else rows
    values = df.select(*map(col, by), *[col(c).cast("double").alias(c) for c in columns])
    if rows * len(columns) <= direct_values:
        return _direct(values, columns, probs, by)
    return _narrowed(values, columns, probs, by, max(direct_values // 4, 2 * SLOTS))


def column_quantiles(df, columns, probs, **options) -> dict[str, dict[float, float | None]]:
    """The same without groups, on the driver: len(columns) x len(probs) numbers."""
    result = {c: dict.fromkeys(probs) for c in columns}
    if columns:
        for row in quantile_table(df, columns, probs, **options).collect():
            result[row["column"]][row["prob"]] = row["value"]
    return result


def column_medians(df, columns, **options) -> dict[str, float | None]:
    return {c: q[0.5] for c, q in column_quantiles(df, columns, [0.5], **options).items()}


def _direct(values, columns, probs, by):
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    wide = values.groupBy(*map(col, by)).agg(
        *[F.percentile(col(c), wanted).alias(f"q{i}") for i, c in enumerate(columns)]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(p)).alias("prob"),
            F.get(F.col(f"q{i}"), j).alias("value"),
        )
        for i, c in enumerate(columns)
        for j, p in enumerate(probs)
    ]
    return wide.select(*map(col, by), F.inline(F.array(*cells)))


def _narrowed(values, columns, probs, by, limit):
    # Groups are one struct: its equality takes null keys as equal, in grouping and in joins.
    group = F.struct(*map(col, by)) if by else F.struct(F.lit(0).alias("_all"))
    plain = values.select(group.alias("g"), *[col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    keys = ["g", "i"] if by else ["i"]
    targets = materialize(_targets(plain, columns, probs, keys))
    wanted = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob")) for c in columns for p in probs])
    seen = targets.select("g").distinct() if by else values.sparkSession.range(1).select(group.alias("g"))
    asked = seen.select("g", F.inline(wanted))
    group = ["g", "column", "prob"]
    band = materialize(_bracketed(plain, targets, len(columns), keys))
    while (band.groupBy(*group).agg(F.count("*").alias("d")).agg(F.max("d")).first()[0] or 0) > limit:
        band = _slots_of_the_ranks(band, group)
    running = Window.partitionBy(*group).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = band.withColumn("upto", F.col("below") + F.sum("c").over(running)).withColumn(
        "start", F.col("upto") - F.col("c")
    )
    low = F.max(F.expr("case when start <= first and first < upto then v end"))
    high = F.max(F.expr("case when start <= last and last < upto then v end"))
    share = F.max(F.col("rank") - F.col("first"))
    found = ranked.groupBy(*group).agg(
        F.when(share > 0, (F.lit(1.0) - share) * low + share * high).otherwise(low).alias("value"))
    return asked.join(found, group, "left").select(*(["g.*"] if by else []), "column", "prob", "value")


def _long(plain, width):
    """A row (g, i, v) for each value: what follows has few expressions however many the columns."""
    names = [f"v{i}" for i in range(width)]
    values = plain.unpivot(["g"], names, "name", "v").where(F.col("v").isNotNull())
    return values.select("g", F.substring("name", 2, 9).cast("int").alias("i"), "v")


def _targets(plain, columns, probs, keys=("g", "i")):
    """A row for each group, column and prob: count, wanted ranks, and bounds `lo`, `hi` of the values there.

    A sketch that tasks merge gives the bounds, at twice its error to both sides; a pass of counters checks them against
    the ranks. Bounds that miss a rank, and those of groups no larger than the sketch, are null: all values count.
    """
    margin = 2.0 / CUT_ACCURACY
    marks = F.array(*[F.lit(min(1.0, max(0.0, p + side))) for p in probs for side in (-margin, margin)])
    sketches = [
        F.percentile_approx(F.nanvl(f"v{i}", F.lit(float("inf"))), marks, F.lit(CUT_ACCURACY)).alias(f"m{i}")
        for i in range(len(columns))
    ]
    sketched = plain.groupBy("g").agg(*sketches, *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))])
    by_column = [F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m")) for i in range(len(columns))]

    def bound(j, side):
        within = probs[j] + margin < 1 if side else probs[j] > margin
        return F.when((F.col("n") > CUT_ACCURACY) & F.lit(within), F.get("m", F.lit(2 * j + side)))

    bounds = [bound(j, side).alias(f"{name}{j}") for j in range(len(probs)) for side, name in enumerate(("lo", "hi"))]
    edges = materialize(sketched.select("g", F.inline(F.array(*by_column))).select("g", "i", "n", *bounds))
    counters = []
    for j in range(len(probs)):
        value, low, high = F.col("v"), F.col(f"lo{j}"), F.col(f"hi{j}")
        counters += [F.count_if(value < low).alias(f"b{j}"), F.count_if(_inside(value, low, high)).alias(f"k{j}")]
    met = _long(plain, len(columns)).join(edges if "g" in keys else edges.drop("g"), list(keys))
    counted = edges.join(met.groupBy(*keys).agg(*counters), list(keys), "left")
    cells = [
        F.struct(F.lit(float(p)).alias("prob"), *[F.col(f"{x}{j}").alias(x) for x in ("lo", "hi", "b", "k")])
        for j, p in enumerate(probs)
    ]
    rank = F.col("prob") * (F.col("n") - 1)
    names = F.get(F.array(*map(F.lit, columns)), F.col("i")).alias("column")
    ranked = counted.select("g", "i", names, "n", F.inline(F.array(*cells))).select(
        "*", rank.alias("rank"), F.floor(rank).alias("first"), F.ceil(rank).alias("last"))
    held = (F.col("b") <= F.col("first")) & (F.col("b") + F.col("k") > F.col("last"))
    return ranked.select(
        "g", "i", "column", "prob", "rank", "first", "last",
        F.when(held, F.col("lo")).alias("lo"), F.when(held, F.col("hi")).alias("hi"),
        F.when(held, F.col("b")).otherwise(0).alias("below"),
    )


def _inside(value, low, high):
    return value.isNotNull() & F.coalesce(value >= low, F.lit(True)) & F.coalesce(value <= high, F.lit(True))


def _bracketed(plain, targets, width, keys=("g", "i")):
    """(value, count) of what lies between the bounds of a target: nothing else is moved."""
    asked = targets.select(*keys, "prob", "lo", "hi")
    near = _long(plain, width).join(asked, list(keys)).where(_inside(F.col("v"), F.col("lo"), F.col("hi")))
    collapsed = near.groupBy(*keys, "prob", "v").agg(F.count("*").alias("c"))
    return collapsed.join(targets.drop("lo", "hi"), [*keys, "prob"]).drop("i")


def _slots_of_the_ranks(band, group):
    """Only the values of the slots, between approximate cuts, that hold a wanted rank."""
    steps = F.array(*[F.lit(i / SLOTS) for i in range(1, SLOTS)])
    cuts = materialize(
        band.groupBy(*group).agg(F.percentile_approx("v", steps, F.lit(CUT_ACCURACY)).alias("cuts"))
    )
    slot = F.size(F.filter("cuts", lambda cut: cut < F.col("v")))
    tagged = band.join(cuts, group).withColumn("slot", slot).drop("cuts")
    running = Window.partitionBy(*group).orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    kept = materialize(
        tagged.groupBy(*group, "first", "last", "below", "slot")
        .agg(F.sum("c").alias("c"))
        .withColumn("upto", F.col("below") + F.sum("c").over(running))
        .withColumn("start", F.col("upto") - F.col("c"))
        .where("upto > first and start <= last")
        .groupBy(*group)
        .agg(
            F.min("slot").alias("from_slot"),
            F.max("slot").alias("to_slot"),
            F.min("start").alias("new_below"),
        )
    )
    return materialize(
        tagged.join(kept, group)
        .where("slot between from_slot and to_slot")
        .select(*group, "v", "c", "rank", "first", "last", F.col("new_below").alias("below"))
    )
