"""Run queries next to their SQL counterparts and compare all rows.

    python -m checks.compare SF_DIR [query …]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import all_sql


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA:
        return None
    return value.item() if hasattr(value, "item") else value


def _rows(columns: list[str], records) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in records)


def compare(spark: SparkSession, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    frame = query(spark, sf_dir)
    got = _rows(frame.columns, frame.collect())
    spark_seconds = time.time() - started
    started = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = _rows(columns, result.fetchall())
    note = f"{len(got)} rows, spark {spark_seconds:.1f}s, sql {time.time() - started:.1f}s"
    if sorted(frame.columns) != sorted(columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        show = "\n".join(f"   {side} {row[:300]}" for side, rows in (("spark", extra), ("sql  ", missing)) for row in rows[:3])
        return False, f"{note}; {len(got)} vs {len(want)}; differ {len(extra)}/{len(missing)}\n{show}"
    return True, note


def main() -> int:
    from colloquy.plans.catalog import all_queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), all_sql(), []
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        try:
            ok, note = compare(spark, con, name, query, sql[name], sf_dir) if name in sql else (True, f"{query(spark, sf_dir).count()} rows, no SQL")
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
