"""Lookup of a learned value by text key.

Up to MAP_KEYS keys the table is a folded map literal, so the lookup stays inside the projection.
Beyond it the lookup is a left join with the written table; Catalyst broadcasts it by its real size.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from ..scratch import materialize
from .text import col

MAP_KEYS = 256


class Lookup:
    def __init__(self, table: DataFrame, value_type: str, mapping: dict | None):
        self.table = table
        self.value_type = value_type
        self.mapping = mapping

    @classmethod
    def build(cls, table: DataFrame, map_keys: int = MAP_KEYS) -> "Lookup":
        """From a table with unique `key` and a `value`; written once."""
        return cls.over(materialize(table.select("key", "value")), map_keys)

    @classmethod
    def over(cls, stored: DataFrame, map_keys: int = MAP_KEYS) -> "Lookup":
        head = stored.limit(map_keys + 1).collect()
        mapping = {row["key"]: row["value"] for row in head} if len(head) <= map_keys else None
        return cls(stored, stored.schema["value"].dataType.simpleString(), mapping)

    def literal(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.mapping)), f"map<string,{self.value_type}>")

    def attach(self, df: DataFrame, key: str, out: str, pick=lambda value: value) -> DataFrame:
        """Add `out` = pick(value of df[key]), null where the key is unknown."""
        if self.mapping is not None:
            found = F.try_element_at(self.literal(), col(key))
            return df.withColumn(out, pick(found))
        table = self.table.select(F.col("key").alias("_key"), F.col("value").alias("_found"))
        joined = df.join(table, col(key) == F.col("_key"), "left")
        return joined.withColumn(out, pick(F.col("_found"))).drop("_key", "_found")
