"""Cleaning, imputation, derived columns and group statistics learned from the training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.lookup import Lookup
from ..functions.text import absent, as_number, clean_category, col
from ..roles import (
    AGE, PEER_PRICE, QUALITY_SIZE, RELATIVE_SIZE, TOTAL_BATH, TOTAL_SIZE, Roles,
)
from .quantile import column_medians, quantile_table

FEATURE_SETS = ("original", "engineered", "extended", "peer")
MISSING_POLICIES = ("impute", "drop")


def require_columns(df: DataFrame, columns) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required raw columns: {missing}")


def clean(df: DataFrame, roles: Roles) -> DataFrame:
    """Numeric columns as finite doubles or null, categories stripped with "Missing" for nothing."""
    require_columns(df, roles.features)
    return df.withColumns(
        {c: as_number(df, c) for c in roles.numeric}
        | {c: clean_category(col(c)) for c in roles.categorical}
    )


def total_size(roles: Roles):
    first, *rest = map(col, roles.size_parts)
    return sum(rest, first)


class RoleFeatures:
    """Fitted state: medians, active columns, group size medians and their global fallback."""

    def __init__(self, roles: Roles, feature_set: str = "engineered", missing_policy: str = "impute"):
        if feature_set not in FEATURE_SETS or missing_policy not in MISSING_POLICIES:
            raise ValueError("Unknown feature set or missing policy")
        self.roles = roles
        self.feature_set = feature_set
        self.missing_policy = missing_policy

    @property
    def uses_groups(self) -> bool:
        return self.feature_set in ("extended", "peer")

    def fit(self, df: DataFrame, rows: int | None = None, complete=None) -> "RoleFeatures":
        """`complete` lists the columns without a raw null, if `df` is cleaned already."""
        roles = self.roles
        cleaned = clean(df, roles)
        found = column_medians(cleaned, roles.numeric, rows=rows)
        self.medians = {c: 0.0 if m is None else m for c, m in found.items()}
        self.active = list(roles.features)
        if self.missing_policy == "drop":
            self.active = complete_columns(df, roles.features) if complete is None else list(complete)
        self.groups, self.global_size = None, None
        if self.uses_groups:
            sized = self._filled(cleaned).select(col(roles.group).alias("key"), total_size(roles).alias("size"))
            self.global_size = column_medians(sized, ["size"], rows=rows)["size"]
            medians = quantile_table(sized, ["size"], [0.5], ["key"], rows=rows)
            self.groups = Lookup.build(medians.select("key", "value"))
        return self

    def _filled(self, cleaned: DataFrame) -> DataFrame:
        return cleaned.withColumns(
            {c: F.coalesce(col(c), F.lit(float(m))) for c, m in self.medians.items()}
        )

    def derived(self) -> list[str]:
        names = []
        if self.feature_set != "original":
            names += [TOTAL_SIZE, TOTAL_BATH, AGE]
        if self.uses_groups:
            names += [RELATIVE_SIZE, QUALITY_SIZE]
        if self.feature_set == "peer":
            names += [PEER_PRICE]
        return names

    def numeric_columns(self) -> list[str]:
        return [c for c in self.active if c in self.roles.numeric] + self.derived()

    def categorical_columns(self) -> list[str]:
        return [c for c in self.active if c in self.roles.categorical]

    def transform(self, df: DataFrame) -> DataFrame:
        """Keep every non-feature column (id, label, fold) and add the prepared features."""
        roles = self.roles
        out = self._filled(clean(df, roles))
        if self.feature_set != "original":
            first, *rest = [col(c) * F.lit(w) for c, w in roles.bath_parts]
            out = out.withColumns(
                {
                    TOTAL_SIZE: total_size(roles),
                    TOTAL_BATH: sum(rest, first),
                    AGE: col(roles.sold) - col(roles.built),
                }
            )
        if self.uses_groups:
            fallback = F.lit(self.global_size).cast("double")
            out = self.groups.attach(out, roles.group, "_size", lambda v: F.coalesce(v, fallback))
            out = out.withColumns(
                {
                    RELATIVE_SIZE: F.when(F.col("_size") > 0, F.col(TOTAL_SIZE) / F.col("_size")),
                    QUALITY_SIZE: col(roles.quality) * F.col(TOTAL_SIZE),
                }
            ).drop("_size")
        dropped = [c for c in roles.features if c not in self.active]
        return out.drop(*dropped)


def complete_columns(df: DataFrame, columns) -> list[str]:
    """Columns without an absent raw value (null or NaN), in the given order; decided by one aggregate."""
    counts = df.agg(*[F.count_if(absent(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if counts[f"n{i}"] == 0]
