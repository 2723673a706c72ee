"""Run queries beside their SQL twins and compare rows, columns and types.

    python -m verification.compare [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification import oracle, registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("quotelens-check")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def compare(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """A description of the first difference, or None."""
    rows = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(rows.columns)
    ours = Counter(tuple(r[c] for c in columns) for r in rows.collect())
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        return None if sum(ours.values()) else "no rows"
    cursor = connection.execute(sql)
    twin_columns = [d[0] for d in cursor.description]
    if sorted(twin_columns) != columns:
        return f"columns {columns} vs {sorted(twin_columns)}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    for field in rows.schema.fields:
        kind = field.dataType.simpleString()
        if SAME_TYPE.get(kind, kind) != types[field.name]:
            return f"type of {field.name}: {kind} vs {types[field.name]}"
    position = [twin_columns.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in position) for r in cursor.fetchall())
    if ours != theirs:
        extra, lacking = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return (f"{sum(ours.values())} vs {sum(theirs.values())} rows, {sum((ours - theirs).values())} differ;"
                f" columns {columns}; ours {extra}; twin {lacking}")
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, connection = session(args.cpus), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    for name in args.names or registry.QUERIES:
        started = time.time()
        difference = compare(spark, connection, name, sf_dir)
        failures += difference is not None
        print(f"{name:32s} {time.time() - started:6.1f}s  {difference or 'ok'}", flush=True)
    print(f"{failures} differences")
    return int(failures > 0)


if __name__ == "__main__":
    raise SystemExit(main())
