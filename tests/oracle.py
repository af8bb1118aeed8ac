"""Runs registered queries next to their check SQL and compares the rows.

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} / {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        if TYPES.get(kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    ours = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    order = [rel.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} / {sum(theirs.values())}; {names}\n"
        f"  only ours {list(extra)[:3]}\n  only theirs {list(missing)[:3]}"
    )


def main() -> int:
    from pagetide.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                note = "ok" if problem is None else "DIFFERS " + problem
            else:
                problem, note = None, f"rows only {df.count()}"
        except Exception as error:  # report and go on to the next query
            problem = note = "FAILED " + str(error)[:1500]
        bad += problem is not None
        print(f"{name:45s} {time.time() - start:6.2f}s {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
