"""Compare a Spark result with DuckDB's over the same Parquet tables."""

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table):
    columns = sorted(table.column_names)
    lists = [table.column(c).to_pylist() for c in columns]
    return columns, sorted(zip(*lists), key=repr)


def _kind(data_type):
    return pa.string() if pa.types.is_large_string(data_type) else data_type


def compare(df, con, sql):
    """None when equal, else what differs."""
    spark_table = df.toArrow()
    duck_table = con.sql(sql).to_arrow_table()
    got_columns, got = _rows(spark_table)
    want_columns, want = _rows(duck_table)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    types = [
        (c, str(_kind(spark_table.schema.field(c).type)), str(_kind(duck_table.schema.field(c).type)))
        for c in got_columns
    ]
    different = [t for t in types if t[1] != t[2]]
    if different:
        return f"types {different}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None
