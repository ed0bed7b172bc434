"""Compare every registered query with its SQL.

python tests/oracle.py [--sf DIR] [name prefix ...]
"""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.sources import SCHEMAS  # noqa: E402


def database(directory):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.17g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Empty string if equal, else what differs."""
    got = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    want = rows_of([c[0] for c in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(want[1])} differ, e.g. spark {bad[0][0]} sql {bad[0][1]}" if bad else ""


def main():
    from millrace.plans import all_queries
    from millrace.session import local_session

    args = sys.argv[1:]
    directory = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        directory, args = args[1], args[2:]
    spark, con = local_session(), database(directory)
    failed = []
    for name, q in all_queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if q.sql:
                note = compare(q.build(spark, directory), con, q.sql)
                n = "sql"
            else:
                n, note = len(q.build(spark, directory).collect()), ""
        except Exception as e:  # noqa: BLE001
            n, note = "-", f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{'FAIL' if note else 'ok  '} {name:32s} {time.time() - start:6.2f}s {n} {note}", flush=True)
        if note:
            failed.append(name)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
