"""Compare a registered query with its oracle in DuckDB, the rows of both sorted by value."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    return str(x) if type(x).__name__ == "Decimal" else x


def same(frame, con, sql: str) -> None:
    names = sorted(frame.columns)
    got = sorted(([_plain(r[c]) for c in names] for r in frame.collect()), key=repr)
    rows = con.execute(sql)
    told = [d[0] for d in rows.description]
    assert sorted(told) == names, (sorted(told), names)
    at = [told.index(c) for c in names]
    expected = sorted(([_plain(r[i]) for i in at] for r in rows.fetchall()), key=repr)
    assert len(got) == len(expected), (len(got), len(expected))
    for a, b in zip(got, expected):
        assert a == b, (a, b)
