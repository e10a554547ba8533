"""Descriptive job: tables about the raw rows; nothing here selects features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import as_number, col
from ..operators.profile import (
    category_counts, histogram, missing_profile, numeric_summary, pearson_matrix, spearman_target,
)
from ..roles import LISTING, Roles
from ..scratch import materialize
from ..sources.csv import POSITION, read_csv, training_rows
from ..sources.sinks import require_new_directory, row_dict, write_json, write_table


def profile(
    spark: SparkSession, data, output: str, roles: Roles = LISTING, min_rows: int = 80
) -> dict[str, DataFrame]:
    """Write and return the EDA tables of a CSV path or DataFrame."""
    require_new_directory(spark, output)
    raw = materialize(read_csv(spark, data, position=True) if isinstance(data, str) else data)
    frame, summary = training_rows(raw, roles, min_rows)
    numeric = materialize(
        frame.select(col(roles.label), *[as_number(frame, c).alias(c) for c in roles.numeric])
    )
    label = numeric.select(col(roles.label).alias("label"))
    tables = {
        "missing_values": missing_profile(raw.drop(POSITION)),
        "numeric_summary": numeric_summary(numeric, roles.numeric),
        "numeric_correlations": pearson_matrix(numeric, roles.numeric),
        "category_counts": category_counts(frame, roles.categorical),
        "target_associations": spearman_target(numeric, roles.numeric, roles.label),
        "target_distribution": histogram(
            label.withColumn("log1p_label", F.log1p("label")), ["label", "log1p_label"]
        ),
    }
    # A column's most frequent categories come first.
    orders = {"category_counts": ("feature", F.desc("rows"), "category")}
    for name, table in tables.items():
        write_table(table, output, name, orders.get(name, ()))
    target = row_dict(numeric_summary(label, ["label"]).drop("column"))
    write_json(spark, {**summary, "target": roles.label, "target_summary": target}, f"{output}/summary.json")
    return {name: spark.read.parquet(f"{output}/{name}") for name in tables}
