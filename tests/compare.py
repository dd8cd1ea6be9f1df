"""Rows of a Spark query against rows of its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_FAMILY = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean", "DOUBLE": "double",
}


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value if value is None or isinstance(value, (str, bool)) else f"{type(value).__name__}:{value!r}"


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    got_names = spark_df.columns
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    kinds = {d[0]: _FAMILY.get(str(d[1]).split("(")[0], str(d[1])) for d in cursor.description}
    got_kinds = {n: _FAMILY.get(k.split("(")[0], k) for n, k in spark_df.dtypes}
    if kinds != got_kinds:
        return f"types {[(n, kinds[n], got_kinds[n]) for n in names if kinds[n] != got_kinds[n]]}"
    order = sorted(names)
    want = Counter(tuple(_plain(r[names.index(n)]) for n in order) for r in want_rows)
    got_rows = spark_df.collect()
    got = Counter(tuple(_plain(r[got_names.index(n)]) for n in order) for r in got_rows)
    if want == got:
        return None
    missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
    return f"{len(got_rows)} rows, {len(want_rows)} wanted; columns {order}\n  missing {missing}\n  extra {extra}"
