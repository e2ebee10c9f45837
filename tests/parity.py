"""Compares every query with its SQL on one folder of tables, as the driver does.

python tests/parity.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v: object) -> str:
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows(columns: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = found.fetchall()
    a, b = rows(df.columns, [tuple(r) for r in got]), rows(names, want)
    if a != b:
        off = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{len(a)} vs {len(b)} rows; first differences {off}"
    return True, f"{len(a)} rows, {took:.2f} s"


def main() -> int:
    import __spark_entry__ as entry

    from payscope.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in sql:
            continue
        try:
            ok, note = compare(spark, con, sf_dir, name, query, sql[name])
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
