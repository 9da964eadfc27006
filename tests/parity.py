"""Value comparison of a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, name, query, sql, sf_dir) -> tuple[int, str]:
    """Row count and the first difference, empty when there is none."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    if sql is None:
        return len(mine), ""
    columns, rows = oracle(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return len(mine), f"columns {sorted(df.columns)} vs {sorted(columns)}"
    theirs = rows_of(columns, rows)
    if len(mine) != len(theirs):
        extra = [m for m in mine if m not in set(theirs)][:1]
        lacking = [t for t in theirs if t not in set(mine)][:1]
        return len(mine), f"{len(mine)} rows vs {len(theirs)}; only mine {extra}; only theirs {lacking}"
    for a, b in zip(mine, theirs):
        if a != b:
            return len(mine), f"{str(a)[:1200]}\n   !=  {str(b)[:1200]}"
    return len(mine), ""


if __name__ == "__main__":
    from corpusops.plans.catalog import QUERIES
    from corpusops.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in wanted:
        query, sql = QUERIES[name]
        began = time.time()
        try:
            count, difference = compare(spark, name, query, sql, sf_dir)
        except Exception as problem:  # noqa: BLE001
            count, difference = -1, f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += bool(difference)
        kind = "rows" if sql is None else "SQL"
        print(f"{'DIFF' if difference else 'ok':4} {name:32} {kind:4} {count:7} rows {time.time() - began:6.2f}s {difference}", flush=True)
    print("differences:", bad)
