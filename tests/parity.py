"""Compare the registered queries with DuckDB: python tests/parity.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roomtide.runtime import build_session  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(con, spark, build, sql, sf_dir):
    """None if both sides agree, else what differs."""
    df = build(spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(names)}: {a} against {b}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as contract

    spark = build_session("parity", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), contract.oracle_sql()
    failed = 0
    for name, build in sorted(contract.queries().items()):
        if only and name not in only:
            continue
        began = time.time()
        try:
            problem = compare(con, spark, build, sql[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28} {time.time() - began:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
