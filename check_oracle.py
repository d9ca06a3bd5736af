"""Compare registered queries with their SQL in DuckDB.

    python check_oracle.py [folder] [key or group ...]
"""

import math
import sys
import time
import warnings
from importlib import import_module

import duckdb

from kinomill.catalog import GROUPS
from kinomill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return f"f{value + 0.0!r}"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, int):
        return f"i{value}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def compare(df, con, sql):
    """None if equal, else a message."""
    got = df.collect()
    if sql is None:
        return f"rows only ({len(got)})"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"DIFFERENT columns {sorted(df.columns)} / {sorted(names)}"
    left, right = rows_of(df.columns, got), rows_of(names, result.fetchall())
    if left == right:
        return None
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return f"DIFFERENT {len(left)} / {len(right)} rows; {only_left} / {only_right}"


def main():
    warnings.simplefilter("ignore")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark, con, bad = local_session(), connect(folder), 0
    for group in GROUPS:
        module = import_module(f"kinomill.catalog.{group}")
        for key, query in module.QUERIES.items():
            if wanted and not wanted & {key, group}:
                continue
            start = time.time()
            try:
                message = compare(query(spark, folder), con, module.ORACLE.get(key))
            except Exception as error:  # report and go on with the next key
                message = f"DIFFERENT: {type(error).__name__}: {str(error)[:1500]}"
            bad += bool(message and message.startswith("DIFFERENT"))
            print(f"{key:28s}{time.time() - start:7.2f}s  {message or 'equal'}", flush=True)
    print(f"{bad} different")


if __name__ == "__main__":
    main()
