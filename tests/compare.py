"""Order-insensitive comparison of a Spark result with its SQL counterpart, and runs of days."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted_rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = list(zip(*columns)) if columns else []
    return names, sorted(rows, key=lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row))


def differences(spark_df, connection, sql: str, limit: int = 3) -> list[str]:
    """Empty when names, types, row count and all values agree exactly."""
    ours = spark_df.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    found = []
    our_types = {f.name: str(f.type) for f in ours.schema}
    their_types = {f.name: str(f.type) for f in theirs.schema}
    if our_types != their_types:
        odd = {k: (our_types.get(k), their_types.get(k)) for k in our_types.keys() | their_types.keys()
               if our_types.get(k) != their_types.get(k)}
        found.append(f"types {odd}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    our_names, our_rows = _sorted_rows(ours)
    their_names, their_rows = _sorted_rows(theirs)
    if our_names == their_names:
        unequal = [(a, b) for a, b in zip(our_rows, their_rows) if a != b]
        found += [f"{a} != {b}" for a, b in unequal[:limit]]
        if unequal:
            found.append(f"{len(unequal)} unequal rows")
    return found


def days(start: str, count: int) -> list[date]:
    first = date.fromisoformat(start)
    return [first + timedelta(days=i) for i in range(count)]
