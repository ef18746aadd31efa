"""Compare registered queries with their SQL twins. Also a script: ``python tests/twins.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SF_DIR = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def same(a: tuple, b: tuple, tolerance: float) -> bool:
    return a == b or all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= tolerance)
                         for x, y in zip(a, b))


def compare(df, sql: str, con, tolerance: float = 0.0) -> tuple[int, list[str]]:
    """Row count and differences, after sorting columns by name and rows by value."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    right = [tuple(normal(row[i]) for i in order) for row in cursor.fetchall()]
    if sorted(names) != sorted(df.columns):
        return 0, [f"columns differ: spark {sorted(set(df.columns) - set(names))} sql {sorted(set(names) - set(df.columns))}"]
    wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN"}
    problems = [f"type of {c}: spark {t} sql {kinds[c]}" for c, t in df.dtypes if wanted.get(t) != kinds[c]]
    left = [tuple(normal(v) for v in row) for row in df.select(*sorted(names)).collect()]
    if len(left) != len(right):
        return len(left), problems + [f"rows: spark {len(left)} sql {len(right)}"]
    left.sort(key=key)
    right.sort(key=key)
    different = [(a, b) for a, b in zip(left, right) if not same(a, b, tolerance)]
    if different:
        problems.append(f"{len(different)} rows differ, e.g.\n   spark {different[0][0]}\n   sql   {different[0][1]}")
    return len(left), problems


def main(names: list[str]) -> int:
    from demandspark.catalog import QUERIES, SQL_TWINS
    from demandspark.session import local_session
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    con = connect()
    bad = []
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, SF_DIR)
            if name in SQL_TWINS:
                n, problems = compare(df, SQL_TWINS[name], con)
            else:
                n, problems = len(df.collect()), []
                if n == 0:
                    problems = ["no rows"]
        except Exception as error:
            n, problems = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        mark = "ok  " if not problems else "FAIL"
        print(f"{mark} {name:30s} {n:7d} rows {time.time() - start:6.2f}s {'' if name in SQL_TWINS else '(rows only)'}", flush=True)
        for problem in problems:
            print("     " + problem, flush=True)
        if problems:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
