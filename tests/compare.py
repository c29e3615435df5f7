"""Run registered queries next to their SQL and report differences.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """Comparable form of a cell."""
    if isinstance(value, (float, Decimal)):
        return round(float(value), 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, con) -> tuple[str, float]:
    """A verdict and the seconds Spark took."""
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    taken = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows={len(got)} cols={df.columns}", taken
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}", taken
    mine, theirs = rows_of(df.columns, got), rows_of(names, result.fetchall())
    if mine == theirs:
        return f"ok {len(got)}", taken
    extra, missing = mine - theirs, theirs - mine
    return (
        f"DIFF spark={len(got)} sql={sum(theirs.values())} extra={str(list(extra)[:2])[:300]} "
        f"missing={str(list(missing)[:2])[:300]}", taken,
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("corpusloom")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), connect(sf_dir)
    for name in names:
        try:
            verdict, taken = compare(spark, sf_dir, name, con)
        except Exception as error:  # noqa: BLE001 - the report names every failing query
            verdict, taken = f"ERROR {type(error).__name__} {str(error)[:600]}", 0.0
        print(f"{name:28s} {taken:6.1f}s {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
