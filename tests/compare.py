"""Run registered queries next to their DuckDB oracles and compare values."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def difference(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty if both give the same rows, else a short account."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    names, rows = oracle_rows(con, sql)
    want = rows_of(names, rows)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return ""
    missing, extra = want - got, got - want
    return (
        f"rows {sum(got.values())}/{sum(want.values())}, {sum(missing.values())} missing, e.g. "
        f"{list(missing)[:2]}; {sum(extra.values())} extra, e.g. {list(extra)[:2]}"
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1]
    chosen = sys.argv[2:] or list(entry.queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for key in chosen:
        begin = time.time()
        try:
            told = difference(session, con, sf, entry.queries()[key], entry.oracle_sql()[key])
        except Exception as error:
            told = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not told else 'FAIL'} {key} {time.time() - begin:.1f}s {told[:900]}", flush=True)
