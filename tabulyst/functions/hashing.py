"""Row hashes that depend on the id and a salt only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 32


def row_hash(row_id: Column, salt: str) -> Column:
    """First 32 bits of md5(id:salt) as a bigint."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_fold(row_id: Column, folds: int, salt: str) -> Column:
    """Near-balanced fold 0..folds-1 without a pass over the data."""
    return (row_hash(row_id, salt) % folds).cast("int")


def uniform(row_id: Column, salt: str) -> Column:
    """Deterministic uniform in (0, 1) with 52 bits."""
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f":{salt}")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def normal(row_id: Column, salt: str) -> Column:
    """Standard normal by the Box-Muller transform of two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(row_id, salt + ":r")))
    return radius * F.cos(F.lit(2.0) * F.pi() * uniform(row_id, salt + ":a"))
