"""Run queries and their SQL counterparts side by side: python -m checks.compare SF_DIR [KEY ...]"""

from __future__ import annotations

import decimal
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, query, sql, sf_dir) -> str | None:
    """None when both sides agree on columns and rows, else what differs."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]).upper() for d in result.description}
    odd = [(c, t, types[c]) for c, t in df.dtypes if TYPES.get(t) != types[c]]
    if odd:
        return f"types differ: {odd}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first: {str(wrong[0])[:600]}" if wrong else None


def main(sf_dir: str, keys: list[str]) -> int:
    from pyspark.sql import SparkSession

    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from speechloom.workspace import clear

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_views(sf_dir)
    failed = 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, QUERIES[key], ORACLE[key], sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{key:32s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    clear(spark)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
