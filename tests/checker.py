"""Comparison of a query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _sortable(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL's result; empty when they agree."""
    ours_rows, names = [tuple(r) for r in df.collect()], df.columns
    cursor = con.execute(sql)
    their_names = [d[0] for d in cursor.description]
    theirs_rows = cursor.fetchall()
    if sorted(names) != sorted(their_names):
        return [f"columns {sorted(names)} / {sorted(their_names)}"]
    ours_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    alias = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    found = [
        f"type of {n}: {ours_types[n]} / {theirs_types[n]}"
        for n in names if alias.get(ours_types[n]) != theirs_types[n]
    ]
    order = sorted(names)

    def arrange(rows, given):
        at = [given.index(n) for n in order]
        return _sortable([tuple(row[i] for i in at) for row in rows])

    ours, theirs = arrange(ours_rows, names), arrange(theirs_rows, their_names)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found
