"""Runs registered queries next to their SQL twins and compares the rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, folder) -> tuple[str, str]:
    df = query(spark, folder)
    got = df.collect()
    if sql is None:
        return ("rows", f"{len(got)} rows")
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return ("FAIL", f"columns {sorted(df.columns)} != {sorted(columns)}")
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a != b:
        return ("FAIL", f"{len(got)} vs {len(want)} rows; columns {sorted(columns)}; only spark {list((a - b).items())[:3]}; "
                        f"only sql {list((b - a).items())[:3]}")
    return ("ok" if got else "EMPTY", f"{len(got)} rows")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from lakeloom.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    twins, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.perf_counter()
        try:
            status, note = compare(spark, con, name, query, twins.get(name), folder)
        except Exception as error:  # report and go on
            status, note = "ERROR", f"{type(error).__name__}: {str(error)[:900]}"
        bad += status in ("FAIL", "ERROR", "EMPTY")
        print(f"{status:6} {time.perf_counter() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
