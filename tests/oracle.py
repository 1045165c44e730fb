"""Run a query on Spark and its SQL on DuckDB, and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(table) -> tuple[dict[str, str], Counter]:
    names = sorted(table.column_names)
    types = {name: str(table.schema.field(name).type).replace("large_", "") for name in names}
    columns = [table.column(name).to_pylist() for name in names]
    return types, Counter(zip(*columns))


def differences(spark_rows, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides have the same columns, types and rows."""
    got_types, got = _rows(spark_rows.toArrow())
    want_types, want = _rows(connection.execute(sql).to_arrow_table())
    if got_types != want_types:
        return f"types: {got_types} != {want_types}"
    extra, missing = got - want, want - got
    if extra or missing:
        return (
            f"{sum(extra.values())} extra, {sum(missing.values())} missing of "
            f"{sum(want.values())}: {list(extra)[:3]} != {list(missing)[:3]}"
        )
    return ""
