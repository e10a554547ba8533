"""Synthetic listings whose values depend on the row number, the column and the seed only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import normal, uniform
from ..functions.text import col
from ..roles import LISTING
from ..scratch import path_exists
from .sinks import write_csv

# Effects of the groups, value ranges, null shares.
GROUP_EFFECTS = {"CollgCr": 10000.0, "OldTown": -15000.0, "NAmes": 0.0, "NridgHt": 25000.0}
GRADES = ("TA", "Gd", "Ex")
ZONES = ("RL", "RM")
INTEGERS = {
    "OverallQual": (3, 10), "OverallCond": (3, 9), "YearBuilt": (1940, 2006), "YrSold": (2006, 2011),
    "FullBath": (1, 4), "HalfBath": (0, 2), "BsmtFullBath": (0, 2), "BsmtHalfBath": (0, 2),
    "GarageCars": (0, 4),
}
RANGES = {"GrLivArea": (700.0, 3200.0), "TotalBsmtSF": (0.0, 1500.0), "LotArea": (3000.0, 18000.0)}
NULL_SHARES = {"LotFrontage": 0.12, "GarageYrBlt": 0.12, "MasVnrArea": 0.12, "Alley": 0.15}
NOISE, LEAST_PRICE = 12000.0, 15000.0


def make_listings(spark: SparkSession, rows: int = 240, seed: int = 42) -> DataFrame:
    if rows < 1:
        raise ValueError("A listing has one row at least")
    number = F.col("_n")

    def u(name: str) -> Column:
        return uniform(number, f"{name}:{seed}")

    def choice(name: str, values) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.floor(u(name) * len(values)).cast("int"))

    columns: dict[str, Column] = {}
    for c in LISTING.numeric:
        low, high = RANGES.get(c, (0.0, 10.0))
        columns[c] = F.lit(low) + u(c) * F.lit(high - low)
    for c, (low, high) in INTEGERS.items():
        columns[c] = (F.lit(low) + F.floor(u(c) * (high - low))).cast("double")
    for c in LISTING.categorical:
        columns[c] = choice(c, GRADES)
    columns["Neighborhood"] = choice("Neighborhood", tuple(GROUP_EFFECTS))
    columns["MSZoning"] = choice("MSZoning", ZONES)
    frame = spark.range(1, rows + 1).withColumnRenamed("id", "_n").withColumns(columns)
    frame = frame.withColumns(
        {
            "1stFlrSF": F.col("GrLivArea") * 0.7,
            "2ndFlrSF": F.col("GrLivArea") * 0.3,
            "YearRemodAdd": F.greatest(F.col("YearBuilt"), F.lit(1980.0)),
            "GarageYrBlt": F.col("YearBuilt"),
        }
    )
    effect = F.lit(0.0)
    for group, amount in GROUP_EFFECTS.items():
        effect = effect + F.when(F.col("Neighborhood") == group, amount).otherwise(0.0)
    price = (
        F.lit(35000.0) + 22000.0 * F.col("OverallQual") + 50.0 * F.col("GrLivArea")
        + 20.0 * F.col("TotalBsmtSF") - 600.0 * (F.col("YrSold") - F.col("YearBuilt"))
        + effect + NOISE * normal(number, f"noise:{seed}")
    )
    frame = frame.withColumn("SalePrice", F.greatest(price, F.lit(LEAST_PRICE)))
    gone = {
        c: F.when(u(f"null:{c}") >= share, col(c)) for c, share in NULL_SHARES.items()
    }
    return frame.withColumns(gone).select(
        F.format_string("%06d", number).alias("Id"), *map(col, LISTING.features), "SalePrice"
    )


def write_listings(spark: SparkSession, path: str, rows: int = 240, seed: int = 42) -> str:
    if path_exists(spark, path):
        raise FileExistsError(f"{path} is there already")
    write_csv(make_listings(spark, rows, seed), path)
    return path
