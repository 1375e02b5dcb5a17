"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, int):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr))


def compare(spark, con, sf: str, run, sql: str | None):
    started = time.time()
    df = run(spark, sf)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL", seconds
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} vs {want[0]}", seconds
    if got[1] != want[1]:
        only_got = [r for r in got[1] if r not in set(want[1])][:3]
        only_want = [r for r in want[1] if r not in set(got[1])][:3]
        return False, (f"{len(got[1])} vs {len(want[1])} rows {got[0]}\n    spark {only_got}"
                       f"\n    sql   {only_want}"), seconds
    return True, f"{len(got[1])} rows", seconds


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from contactloom.session import local_session

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    spark, con = local_session("8"), connect(sf)
    wanted = sys.argv[1:]
    sqls = entry.oracle_sql()
    bad = []
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, note, seconds = compare(spark, con, sf, run, sqls.get(name))
        except Exception as e:  # report and go on with the next query
            ok, note, seconds = False, f"{type(e).__name__}: {str(e)[:500]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:38} {seconds:6.2f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(len(bad), "failed", bad)


if __name__ == "__main__":
    main()
