"""Tables written between stages.

A written table cuts lineage, survives the loss of an executor, keeps column pruning, and tells
Catalyst its true size, so a join against it is broadcast only when it is small.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the session; a temporary one only for a local master that names none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="tabulyst-")
    return _LOCAL_ROOT[app]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) pair of the JVM for a path on any configured file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = hadoop_path(spark, path)
    return system.exists(jvm_path)


def is_absent_or_empty(spark: SparkSession, path: str) -> bool:
    system, jvm_path = hadoop_path(spark, path)
    return not system.exists(jvm_path) or len(system.listStatus(jvm_path)) == 0


def same_path(spark: SparkSession, left: str, right: str) -> bool:
    first, second = hadoop_path(spark, left), hadoop_path(spark, right)
    return first[0].makeQualified(first[1]).equals(second[0].makeQualified(second[1]))


def materialize(df: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """Write a stage to the shared folder and read it back; dropped when the session ends, or by discard().

    `group_bytes` bounds the row groups of long records, as a reader holds many of them.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tabulyst-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    system, jvm_path = hadoop_path(spark, path)
    system.deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialized stage, once nothing reads it any more."""
    system, jvm_path = hadoop_path(df.sparkSession, df.written_to)
    system.delete(jvm_path, True)
