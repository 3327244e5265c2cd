"""Run registered queries against their SQL twins: python tests/compare.py [key-prefix ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
import traceback
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.tables import TABLES  # noqa: E402

TEST_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, normal(v)) for k, v in value.items()))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def difference(df, con, sql: str) -> str | None:
    rows = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = [names.index(c) for c in df.columns]
    for side, data in (("spark", rows), ("sql", expected)):
        for row in data:
            for v in row:
                if isinstance(v, (decimal.Decimal, dt.date)) and not isinstance(v, dt.datetime):
                    return f"{side} returns {type(v).__name__}; cast it"
    a = Counter(tuple((type(v).__name__, normal(v)) for v in r) for r in rows)
    b = Counter(tuple((type(r[i]).__name__, normal(r[i])) for i in order) for r in expected)
    if a != b:
        return f"rows {len(rows)} != {len(expected)}; only spark {str(list((a - b).items())[:2])[:700]}; only sql {str(list((b - a).items())[:2])[:700]}"
    return None if rows else "empty on both sides"


def main(prefixes: list[str]) -> None:
    from tributary.plans import QUERIES
    from tributary.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    con = connect(sf_dir)
    bad = 0
    for key, q in QUERIES.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = q(spark, sf_dir)
            if q.oracle:
                message = difference(df, con, q.oracle)
                state = "ok"
            else:
                n = len(df.collect())
                message, state = (None if n else "no rows"), f"rows-only {n}"
        except Exception as error:  # report and go on with the next query
            message = f"{type(error).__name__}: {str(error)[:int(os.environ.get("ERR", "300"))]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += message is not None
        print(f"{key:45s} {time.time() - start:6.2f}s {'FAIL ' + message if message else state}", flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
