"""Run registered queries beside their SQL twins: ``python tests/oracle.py SF_DIR [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from feedloom.queries.raw_feed import TABLES  # noqa: E402


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([normal(row[i]) for i in order]) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def compare(spark, connection, sf_dir, query, sql):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    mine = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = as_rows(names, result.fetchall())
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    spark_types = {f.name: kinds.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    sql_types = {d[0]: str(d[1]) for d in result.description}
    if spark_types != sql_types:
        differing = {n: (spark_types.get(n), sql_types.get(n)) for n in spark_types if spark_types[n] != sql_types.get(n)}
        print(f"    types: {differing}")
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if mine[1] != theirs[1]:
        left, right = set(mine[1]), set(theirs[1])
        return (
            f"rows {len(mine[1])} / {len(theirs[1])}; only here {sorted(left - right)[:3]}; only there {sorted(right - left)[:3]}"
        )
    return None if mine[1] else "no rows"


def main():
    from pyspark.sql import SparkSession

    from feedloom.queries import catalog

    sf_dir, chosen = sys.argv[1], sys.argv[2:] or list(catalog.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for query in chosen:
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, catalog.QUERIES[query], catalog.ORACLE[query])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{query:24s} {time.time() - started:6.1f}s  {'ok' if problem is None else problem}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
