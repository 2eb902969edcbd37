"""Compare a Spark result with a DuckDB result, row multiset by row multiset."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value)
    if isinstance(value, datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


# DuckDB type name per Spark type name.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs in names, types or rows; empty if nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} vs {types[name]}")
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    theirs = _bag(names, result.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        found.append(
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; {sum(extra.values())} extra e.g. "
            f"{list(extra)[:2]}; {sum(missing.values())} missing e.g. {list(missing)[:2]}"
        )
    return found
