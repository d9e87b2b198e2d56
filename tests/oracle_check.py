"""Compare a registered query with its oracle: columns, types, rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between the query and the oracle; empty if nothing does."""
    names = sorted(df.columns)
    want = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in want.description}
    found = []
    if names != sorted(want_types):
        return [f"columns {names} against {sorted(want_types)}"]
    types = dict(df.dtypes)
    for n in names:
        if DUCK_TYPES.get(types[n], types[n]) != want_types[n]:
            found.append(f"type of {n}: {types[n]} against {want_types[n]}")
    order = [d[0] for d in want.description]
    theirs = Counter(tuple(_plain(r[order.index(n)]) for n in names) for r in want.fetchall())
    ours = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if ours != theirs:
        found.append(
            f"rows {sum(ours.values())} against {sum(theirs.values())};"
            f" only ours {list((ours - theirs).items())[:3]};"
            f" only oracle {list((theirs - ours).items())[:3]}"
        )
    if not ours:
        found.append("no rows")
    return found
