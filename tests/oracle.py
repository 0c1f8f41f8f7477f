"""Compare a query with its reference SQL, run by DuckDB on the same Parquet files."""

from __future__ import annotations

import duckdb

from workload.standins import DRIVER_TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


# Spark type names as DuckDB spells them
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if names, types and rows agree, else what does not."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    mine = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if mine != kinds:
        return f"schema: {sorted(set(mine.items()) ^ set(kinds.items()))}"
    got, want = _sorted(map(tuple, df.collect()), df.columns), _sorted(expected, names)
    if got == want:
        return None
    left, right = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows, expected {len(want)}; extra {sorted(left)[:2]}; absent {sorted(right)[:2]}"
