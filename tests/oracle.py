"""Compare a Spark result with the same question asked in DuckDB."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb

DATA = os.environ.get("RISKLOOM_DATA", "/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for path in sorted(glob.glob(os.path.join(DATA, sf, "*.parquet"))):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if x is None:
        return (0, "")
    if isinstance(x, float):
        return (0, "") if math.isnan(x) else (1, repr(x + 0.0))
    return (1, str(x))


def difference(spark_df, con, sql: str, clock: list | None = None) -> str | None:
    """None if both results hold the same rows, else what differs."""
    types = {f.name: f.dataType.typeName() for f in spark_df.schema}
    left_names = sorted(spark_df.columns)
    left = [tuple(r[c] for c in left_names) for r in spark_df.collect()]
    if clock is not None:
        clock.append(time.time())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    rows = cur.fetchall()
    if sorted(names) != left_names:
        return f"columns {left_names} != {sorted(names)}"
    at = [names.index(c) for c in left_names]
    right = [tuple(r[i] for i in at) for r in rows]
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    groups = {"integer": "i", "long": "i", "INTEGER": "i", "BIGINT": "i", "string": "s", "VARCHAR": "s", "double": "f",
              "DOUBLE": "f", "boolean": "b", "BOOLEAN": "b"}
    for c in left_names:
        a, b = groups.get(types[c], types[c]), groups.get(kinds[c], kinds[c])
        if a != b:
            return f"type of {c}: {types[c]} != {kinds[c]}"
        if a == "i" and {types[c], kinds[c]} in ({"integer", "BIGINT"}, {"long", "INTEGER"}):
            return f"width of {c}: {types[c]} != {kinds[c]}"
    a = sorted(tuple(map(_cell, r)) for r in left)
    b = sorted(tuple(map(_cell, r)) for r in right)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {left_names} {bad[0]}"
    return None
