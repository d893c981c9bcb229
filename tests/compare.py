"""Side-by-side runs in Spark and DuckDB."""

import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        path = os.path.join(sf_dir, name)
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{source}'")
    return connection


def cell(value) -> str:
    if pd.isna(value):
        return ""
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else repr(value)
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v) for v in r) for r in frame.itertuples(index=False))
