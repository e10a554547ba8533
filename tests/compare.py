"""Run registered queries and their SQL side by side: python tests/compare.py DIR [names...]."""

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "0.0" if value == 0 else repr(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, sql, directory):
    """None if both engines agree, else a short text."""
    found = query(spark, directory)
    ours = rows_of(found.columns, [tuple(r) for r in found.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    database = connect(folder)
    for name, sql in entry.oracle_sql().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            result = difference(session, database, entry.queries()[name], sql, folder) or "ok"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {result}", flush=True)
