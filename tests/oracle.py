"""Compare registered queries with their SQL counterparts in DuckDB.

usage: python -m tests.oracle [--dir FOLDER] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((v is None, str(v)) for v in t)
    )


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def compare(df, con, sql: str) -> str:
    """Empty string when equal, else what differs."""
    rel = con.sql(sql)
    want_cols, want = list(rel.columns), rel.fetchall()
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = df.collect()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    for c, t in df.dtypes:
        if KINDS.get(t, t) != types[c]:
            return f"type of {c}: {t} vs {types[c]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _rows(df.columns, [tuple(r) for r in got]), _rows(want_cols, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else ""


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tasteloom-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    if argv[:1] == ["--dir"]:
        folder, argv = argv[1], argv[2:]
    spark, con = session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else f"rows={df.count()} (no sql)"
            ok = name not in oracles or not problem
        except Exception as error:  # report and go on with the next query
            ok, problem = False, f"{type(error).__name__}: {str(error)[:600]}"
            if argv:
                traceback.print_exc()
        failed += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
