"""Run queries in Spark and DuckDB and compare the results, row order aside.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import atexit
import math
import shutil
import tempfile
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            con.sql(f"create view {name} as select * from '{path}'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 9) + 0.0
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> list[tuple]:
    return rows_of(df.columns, df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    result = con.sql(sql)
    return rows_of(result.columns, result.fetchall())


def difference(con, spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """None when equal, else a short description."""
    df = registry.QUERIES[name](spark, sf_dir)
    relation = con.sql(registry.SQL[name]())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    got, want = spark_rows(df), rows_of(relation.columns, relation.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> None:
    from colloquy.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]",
        {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8",
         "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="colloquy-compare-")},
    )
    atexit.register(shutil.rmtree, spark.conf.get("spark.checkpoint.dir"), ignore_errors=True)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    for name in args.names or registry.QUERIES:
        start = time.time()
        if name in registry.SQL:
            try:
                result = difference(con, spark, args.sf, name) or "ok"
            except Exception as error:  # report and go on with the next query
                result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        else:
            rows = registry.QUERIES[name](spark, args.sf).collect()
            result = f"{len(rows)} rows (no SQL) {str(rows[:3])[:300]}"
        print(f"{name:36s} {time.time() - start:6.1f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
