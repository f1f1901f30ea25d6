"""Order-free comparison of a Spark result with a SQL result."""

from __future__ import annotations

from collections import Counter

import duckdb
import pyarrow as pa

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _kind(t: pa.DataType) -> str:
    for kind, test in (("int", pa.types.is_integer), ("float", pa.types.is_floating), ("bool", pa.types.is_boolean),
                       ("time", pa.types.is_timestamp), ("text", lambda x: pa.types.is_string(x) or pa.types.is_large_string(x))):
        if test(t):
            return kind
    return str(t)


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = []
    for n in names:
        values = table.column(n).to_pylist()
        if _kind(table.schema.field(n).type) == "time":
            values = [None if v is None else v.replace(tzinfo=None) for v in values]
        columns.append(values)
    return Counter(zip(*columns))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """None where both hold the same rows, else what differs."""
    kinds = [{f.name: _kind(f.type) for f in t.schema} for t in (spark_table, sql_table)]
    if kinds[0] != kinds[1]:
        return f"columns {kinds[0]} and {kinds[1]}"
    a, b = _rows(spark_table), _rows(sql_table)
    if a == b:
        return None
    return (f"{spark_table.num_rows} and {sql_table.num_rows} rows; only in Spark {list((a - b).items())[:3]}; "
            f"only in SQL {list((b - a).items())[:3]}")
