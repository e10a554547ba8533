"""The listing frame: one priced row per order, derived from the order and line item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("nation", "customer", "orders", "lineitem")


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def listing(spark: SparkSession, directory: str) -> DataFrame:
    quantity, flag, status = F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus")

    def of_flag(code):
        return F.sum(F.when(flag == code, quantity))

    def of_status(code):
        return F.sum(F.when(status == code, 1).otherwise(0)).cast("double")

    lines = read(spark, directory, "lineitem").groupBy("l_orderkey").agg(
        of_flag("A").alias("size_a"),
        of_flag("N").alias("size_b"),
        of_flag("R").alias("size_c"),
        of_status("O").alias("full_cnt"),
        of_status("F").alias("half_cnt"),
        F.min(F.year("l_shipdate")).cast("double").alias("year_built"),
    )
    orders = read(spark, directory, "orders")
    customer = read(spark, directory, "customer")
    nation = read(spark, directory, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_totalprice").alias("label"),
            F.substring("o_orderpriority", 1, 1).cast("double").alias("quality"),
            F.year("o_orderdate").cast("double").alias("year_sold"),
            "size_a", "size_b", "size_c", "full_cnt", "half_cnt", "year_built",
            F.col("c_acctbal").alias("acctbal"),
            F.col("n_name").alias("grp"),
            F.col("c_mktsegment").alias("segment"),
            F.col("o_orderstatus").alias("status"),
        )
    )
