"""Run the queries and their comparison SQL side by side; as a script: check_oracles.py FOLDER [NAME...]."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return None if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, build, sql, folder):
    started = time.time()
    frame = build(spark, folder)
    left = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - started
    if sql is None:
        return sum(left.values()), None, took, []
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    right = rows_of(columns, result.fetchall())
    problems = []
    if sorted(columns) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} {sorted(columns)}")
    if left != right:
        problems.append(f"only here {list((left - right).items())[:3]} only there {list((right - left).items())[:3]}")
    return sum(left.values()), sum(right.values()), took, problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from viewloom import build_session

    session = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(folder)
    for name in sys.argv[2:] or queries:
        try:
            here, there, took, problems = compare(session, con, name, queries[name], oracles.get(name), folder)
            print("OK " if not problems else "BAD", name, here, there, f"{took:.2f}s", *problems, flush=True)
        except Exception as error:  # noqa: BLE001
            print("ERR", name, str(error)[:600], flush=True)
