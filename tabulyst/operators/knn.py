"""Exact k-nearest comparable rows and their inverse-distance mean price.

Distance: standardised size, quality and age plus a one-hot group, so two known groups are 2 apart
in squared distance and a group without training rows is 1 apart from every row.

Equal points collapse to one point with its k first ids. Points are sorted along a bit-interleaved
curve and cut into cells of a fixed number of points, whatever the density; cells carry their bounds,
and 32 cells share a node of the next level. A query first measures the cell at its own place on the
curve, which bounds its k-th distance; query cells then descend the bounds. At every level the far
corners of the nearest nodes that hold k rows tighten the reach, and a node stays only if it can still
hold a nearer row, so an outlying query keeps few cells too. The bounds use the same monotone
floating-point steps as the distance, so nothing that belongs to the answer is left out.

Rows are first searched inside their group. Only a query whose k-th distance reaches the gap between
groups is also searched over all groups, with cells sorted without regard to the group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import as_number, clean_category, col
from ..roles import PEER_PRICE, Roles
from ..scratch import materialize
from .ordering import POSITION_BITS, _placed
from .quantile import quantile_table

NEIGHBOURS = 5
CELL_BITS = 5
FANOUT_BITS = 5
ROOT_NODES = 64
CURVE_BITS = 12
CURVE_REACH = 16.0
GROUP_GAP = 2.0
NEW_GROUP_GAP = 1.0
AXES = ("x0", "x1", "x2")
POINT = ("model", "g", *AXES)
BOX = tuple(f"{a}_{e}" for a in AXES for e in ("min", "max"))
QUERY = ("model", "q_g", *[f"q_{a}_min" for a in AXES])
QUERY_CELL = ("model", "zone", "q_cell")
QUERY_BOX = tuple(f"q_{b}" for b in BOX)


def peer_inputs(df: DataFrame, roles: Roles) -> dict[str, Column]:
    """Raw axes (the size is null if any part is) and the cleaned group."""
    first, *rest = [as_number(df, c) for c in roles.size_parts]
    return {
        "x0": sum(rest, first),
        "x1": as_number(df, roles.quality),
        "x2": as_number(df, roles.sold) - as_number(df, roles.built),
        "g": clean_category(col(roles.group)),
    }


class Axes:
    """Per model: medians for nulls, population deviations as scales, spreads for the curve."""

    def __init__(self, medians, scales, spreads):
        self.medians, self.scales, self.spreads = medians, scales, spreads

    @staticmethod
    def pick(values: list[list[float]], axis: int) -> Column:
        return F.get(F.array(*[F.lit(float(v[axis])) for v in values]), F.col("model"))

    def fill(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {a: F.coalesce(a, self.pick(self.medians, i)) for i, a in enumerate(AXES)}
        )

    def squared(self, gap: list[Column]) -> Column:
        steps = [g / self.pick(self.scales, i) for i, g in enumerate(gap)]
        return sum([s * s for s in steps[1:]], steps[0] * steps[0])

    def curve(self, axes=AXES) -> Column:
        """Bit-interleaved place; it steers locality only, never the answer."""
        top = (1 << CURVE_BITS) - 1
        parts = []
        for i, axis in enumerate(axes):
            centred = (F.col(axis) - self.pick(self.medians, i)) / self.pick(self.spreads, i)
            unit = (F.asinh(centred) / CURVE_REACH + 1.0) / 2.0
            step = F.greatest(F.lit(0), F.least(F.lit(top), F.floor(unit * top))).cast("bigint")
            for bit in range(CURVE_BITS):
                one = F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("bigint"))
                parts.append(F.shiftleft(one, 3 * bit + i))
        return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _cut(df: DataFrame, zone: Column, order: tuple[str, ...], cell_bits: int) -> DataFrame:
    """Add (zone, cell): runs of 2^cell_bits rows of a zone along the curve; written."""
    zoned = df.withColumn("zone", zone)
    placed = _placed(zoned, [F.col(c) for c in ("model", "zone", "curve", *order)])
    place = F.shiftleft(F.col("_part"), POSITION_BITS).bitwiseOR(F.col("_offset"))
    return placed.withColumn("cell", F.shiftright(place, cell_bits)).drop("_part", "_offset")


class CellTree:
    """Cells over points (model, g, axes, curve, entries) of each zone, with bounds per level."""

    def __init__(self, points: DataFrame, zone: Column, axes: Axes, k: int, cell_bits: int):
        self.axes, self.k, self.cell_bits, self.zone = axes, k, cell_bits, zone
        self.points = _cut(points, zone, ("g", *AXES), cell_bits)
        leaves = self.points.groupBy("model", "zone", "cell").agg(
            F.sum(F.size("entries")).alias("n"),
            F.min(F.struct("zone", "curve")).alias("start"),
            F.max(F.struct("zone", "curve")).alias("end"),
            *[F.min(a).alias(f"{a}_min") for a in AXES],
            *[F.max(a).alias(f"{a}_max") for a in AXES],
        )
        self.levels = [materialize(leaves.withColumn("up", F.shiftright("cell", FANOUT_BITS)))]
        while True:
            level = self.levels[-1].groupBy("model", F.col("up").alias("node")).agg(
                F.sum("n").alias("n"),
                F.min("start").alias("start"),
                F.max("end").alias("end"),
                *[F.min(f"{a}_min").alias(f"{a}_min") for a in AXES],
                *[F.max(f"{a}_max").alias(f"{a}_max") for a in AXES],
            )
            level = materialize(level.withColumn("up", F.shiftright("node", FANOUT_BITS)))
            self.levels.append(level)
            widest = level.groupBy("model").count().agg(F.max("count")).first()[0] or 0
            if widest <= ROOT_NODES:
                break

    def nearest(self, queries: DataFrame) -> DataFrame:
        """(query, known, d2, g, id, price): the k first rows of the query's zone by (d2, id)."""
        zones = self.levels[0].groupBy("model", "zone").agg(F.min("start.curve").alias("_first"))
        named = queries.select("model", F.col("g").alias("q_g"), "known", *AXES, "curve", "g")
        placed = _cut(named, self.zone, ("g", *AXES), self.cell_bits).join(zones, ["model", "zone"])
        asked = placed.select(
            "model", "q_g", "known", "zone", F.col("cell").alias("q_cell"),
            F.struct("zone", F.greatest("curve", "_first").alias("curve")).alias("place"),
            *[F.col(a).alias(f"q_{a}_{e}") for a in AXES for e in ("min", "max")],
        )
        asked = materialize(self._reached(materialize(asked)))
        cells = asked.groupBy(*QUERY_CELL).agg(
            *[F.min(f"q_{a}_min").alias(f"q_{a}_min") for a in AXES],
            *[F.max(f"q_{a}_max").alias(f"q_{a}_max") for a in AXES],
            F.max("reach").alias("reach"),
        )
        # The top level has at most ROOT_NODES rows per model.
        front = self._near(cells.join(F.broadcast(self.levels[-1]), "model"), QUERY_CELL)
        for level in self.levels[-2::-1]:
            kept = front.select(*QUERY_CELL, *QUERY_BOX, "reach", F.col("node").alias("up"))
            front = self._near(kept.join(level.drop("zone"), ["model", "up"]), QUERY_CELL)
            front = front.withColumnRenamed("cell", "node") if level is self.levels[0] else front
        leaves = front.select(*QUERY_CELL, F.col("node").alias("cell"), "n", "start", "end", *BOX)
        near = self._near(asked.join(leaves, list(QUERY_CELL)), (*QUERY, "known", "zone"))
        first = Window.partitionBy(*QUERY).orderBy("d2", "id")
        return (
            self._measured(near.select(*QUERY, "known", "reach", "zone", "cell"))
            .where(F.col("d2") <= F.col("reach"))
            .select(*QUERY, "known", "d2", "g", F.inline("entries"))
            .withColumn("_rank", F.row_number().over(first))
            .where(F.col("_rank") <= self.k)
            .drop("_rank")
        )

    def _reached(self, asked: DataFrame) -> DataFrame:
        """Add `reach`: the k-th distance inside the cell at the query cell's place on the curve."""
        spot = asked.groupBy(*QUERY_CELL).agg(F.min("place").alias("place"))
        seed = spot.join(F.broadcast(self.levels[-1]), "model")
        for level in self.levels[-2::-1]:
            seed = self._at_place(seed, "node", 2).withColumnRenamed("node", "up")
            seed = seed.join(level.drop("zone"), ["model", "up"])
        seed = self._at_place(seed, "cell", 1).drop("place")
        measured = self._measured(asked.join(seed, list(QUERY_CELL)).drop("place"))
        repeated = F.flatten(F.collect_list(F.array_repeat("d2", F.size("entries"))))
        kth = F.get(F.sort_array(repeated), self.k - 1)
        keys = [*QUERY, "known", "zone", "q_cell", *[f"q_{a}_max" for a in AXES]]
        return measured.groupBy(*keys).agg(F.coalesce(kth, F.lit(float("inf"))).alias("reach"))

    def _at_place(self, seed: DataFrame, target: str, keep: int) -> DataFrame:
        """The child at the place and, for a short one at a zone's end, its neighbour in the zone."""
        start = F.col("start")
        overlap = F.col("zone").between(F.col("start.zone"), F.col("end.zone"))
        before = start <= F.col("place")
        order = [before.desc(), F.when(before, start).desc(), start.asc()]
        if target == "cell":
            order.insert(0, (F.col("n") >= self.k).desc())
        rank = F.row_number().over(Window.partitionBy(*QUERY_CELL).orderBy(overlap.desc(), *order))
        ranked = seed.withColumn("_rank", rank).where(F.col("_rank") <= keep)
        return ranked.select(*QUERY_CELL, "place", target)

    def _measured(self, asked: DataFrame) -> DataFrame:
        """Join query points with the points of a cell: at most 2^cell_bits rows per match."""
        # A query row meets many points, so its bytes say little about its work: keep all tasks. Cells
        # of one query go to different ones.
        tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = asked.repartition(tasks, *QUERY, "cell")
        pairs = spread.join(self.points.drop("curve"), ["model", "zone", "cell"])
        gap = [F.col(a) - F.col(f"q_{a}_min") for a in AXES]
        return pairs.withColumn("d2", self.axes.squared(gap))

    def _near(self, front: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """Nodes that can hold a row within the reach, which the nodes of each key tighten first."""
        gap, widest = [], []
        for a in AXES:
            p_min, p_max, q_min, q_max = map(F.col, (f"{a}_min", f"{a}_max", f"q_{a}_min", f"q_{a}_max"))
            gap.append(F.greatest(F.lit(0.0), p_min - q_max, q_min - p_max))
            widest.append(F.greatest(p_max - q_min, q_max - p_min))
        within = front.where(F.col("zone").between(F.col("start.zone"), F.col("end.zone")))
        within = within.withColumns({"_close": self.axes.squared(gap), "_far": self.axes.squared(widest)})
        within = within.where(F.col("_close") <= F.col("reach"))
        # Rows of a node that lies in the zone as a whole are all no farther than its far corner.
        own = F.when((F.col("start.zone") == F.col("zone")) & (F.col("end.zone") == F.col("zone")), F.col("n"))
        held = F.sum(own).over(Window.partitionBy(*keys).orderBy("_far"))
        sure = F.min(F.when(F.col("_held") >= self.k, F.col("_far"))).over(Window.partitionBy(*keys))
        tight = within.withColumn("_held", held).withColumn("reach", F.least("reach", sure))
        return tight.where(F.col("_close") <= F.col("reach")).drop("_close", "_far", "_held")


class PeerComparables:
    """One fitted neighbour index, or several (`model` 0..m-1) that share every job."""

    def __init__(self, roles: Roles, neighbours: int = NEIGHBOURS, cell_bits: int = CELL_BITS):
        self.roles = roles
        self.neighbours = neighbours
        self.cell_bits = cell_bits

    def fit(self, df: DataFrame, price: str, rows: int | None = None) -> "PeerComparables":
        """One model over all rows."""
        return self._fit(self._training(df, price).withColumn("model", F.lit(0)), 1, rows)

    def fit_folds(self, df, price: str, fold: str, folds: int, rows=None) -> "PeerComparables":
        """Model f sees the rows outside fold f."""
        others = F.filter(F.array(*map(F.lit, range(folds))), lambda f: f != F.col("_fold"))
        training = (
            self._training(df, price, col(fold).alias("_fold"))
            .withColumn("model", F.explode(others))
            .drop("_fold")
        )
        return self._fit(training, folds, rows)

    def _training(self, df, price, *kept):
        axes = [c.alias(n) for n, c in peer_inputs(df, self.roles).items()]
        row_id, value = col(self.roles.id).alias("id"), col(price).alias("price")
        return df.select(row_id, value, *axes, *kept)

    def _fit(self, training: DataFrame, models: int, rows: int | None) -> "PeerComparables":
        training = materialize(training)
        medians = [[0.0] * len(AXES) for _ in range(models)]
        for r in quantile_table(training, AXES, [0.5], ["model"], rows=rows).where("value is not null").collect():
            medians[r["model"]][AXES.index(r["column"])] = r["value"]
        filled = Axes(medians, None, None).fill(training)
        stats = filled.groupBy("model").agg(
            *[F.stddev_pop(a).alias(f"s_{a}") for a in AXES],
            *[F.percentile_approx(a, [0.25, 0.75], 1000).alias(f"q_{a}") for a in AXES],
        )
        by_model = {r["model"]: r for r in stats.collect()}
        scales, spreads = [], []
        for row in (by_model[m] for m in range(models)):
            scales.append([row[f"s_{a}"] or 1.0 for a in AXES])
            wide = [row[f"q_{a}"][1] - row[f"q_{a}"][0] for a in AXES]
            spreads.append([w or s for w, s in zip(wide, scales[-1])])
        self.axes = Axes(medians, scales, spreads)
        first_ids = Window.partitionBy(*POINT).orderBy("id")
        points = (
            filled.withColumn("_rank", F.row_number().over(first_ids))
            .where(F.col("_rank") <= self.neighbours)
            .groupBy(*POINT)
            .agg(F.collect_list(F.struct("id", "price")).alias("entries"))
            .withColumn("curve", self.axes.curve())
        )
        self.adopt(points)
        return self

    def adopt(self, points: DataFrame) -> None:
        self.grouped = CellTree(points, F.col("g"), self.axes, self.neighbours, self.cell_bits)
        self.points = self.grouped.points.drop("zone", "cell")
        self._everywhere = None

    @property
    def everywhere(self) -> CellTree:
        if self._everywhere is None:
            self._everywhere = CellTree(
                self.points, F.lit(""), self.axes, self.neighbours, self.cell_bits
            )
        return self._everywhere

    def transform(self, df: DataFrame, out: str = PEER_PRICE, fold: str | None = None) -> DataFrame:
        """Add the peer price; with `fold`, each row asks the model that never saw its fold."""
        model = col(fold).cast("int") if fold else F.lit(0)
        axes = {f"_{n}": c for n, c in peer_inputs(df, self.roles).items()}
        asked = df.withColumns(axes | {"_model": model})
        for i, a in enumerate(AXES):
            median = F.get(F.array(*[F.lit(m[i]) for m in self.axes.medians]), F.col("_model"))
            asked = asked.withColumn(f"_{a}", F.coalesce(F.col(f"_{a}"), median))
        answers = self.search(asked.select(*[F.col(f"_{c}").alias(c) for c in POINT]).distinct())
        right = answers.select(*[F.col(c).alias(f"_{c}") for c in POINT], F.col("value").alias(out))
        keys = [f"_{c}" for c in POINT]
        return asked.join(right, keys, "left").drop(*keys)

    def search(self, queries: DataFrame) -> DataFrame:
        """(model, g, x0, x1, x2, value) for distinct, filled query points."""
        known = self.grouped.levels[0].select("model", F.col("zone").alias("g"))
        asked = materialize(
            queries.join(known.distinct().withColumn("known", F.lit(True)), ["model", "g"], "left")
            .withColumn("known", F.coalesce("known", F.lit(False)))
            .withColumn("curve", self.axes.curve())
        )
        inside = materialize(self.grouped.nearest(asked.where("known")))
        settled = inside.groupBy(*QUERY).agg(
            F.count("*").alias("_n"), F.max("d2").alias("_far")
        ).where((F.col("_n") == self.neighbours) & (F.col("_far") < GROUP_GAP))
        done = settled.select("model", F.col("q_g").alias("g"), *[F.col(f"q_{a}_min").alias(a) for a in AXES])
        open_points = materialize(asked.join(done, list(POINT), "left_anti"))
        best = inside
        if not open_points.isEmpty():
            other = F.when(F.col("known"), F.lit(GROUP_GAP)).otherwise(F.lit(NEW_GROUP_GAP))
            outside = (
                self.everywhere.nearest(open_points)
                .where(~F.col("known") | (F.col("g") != F.col("q_g")))
                .withColumn("d2", F.col("d2") + other)
            )
            first = Window.partitionBy(*QUERY).orderBy("d2", "id")
            best = (
                inside.unionByName(outside)
                .withColumn("_rank", F.row_number().over(first))
                .where(F.col("_rank") <= self.neighbours)
            )
        weight = F.when(F.col("d2") > 0, 1.0 / F.sqrt("d2"))
        exact = F.avg(F.when(F.col("d2") == 0, F.col("price")))
        mean = F.sum(weight * F.col("price")) / F.sum(weight)
        return best.groupBy(*QUERY).agg(F.coalesce(exact, mean).alias("value")).select(
            "model", F.col("q_g").alias("g"), *[F.col(f"q_{a}_min").alias(a) for a in AXES], "value"
        )
