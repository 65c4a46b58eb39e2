"""Compares a query with its SQL text in DuckDB, row order ignored."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

from scenetext.plans.oracle import ORACLE
from scenetext.plans.registry import QUERIES


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> int:
    """Number of rows, after asserting that both sides agree on columns and values."""
    df = QUERIES[name](spark, sf_dir)
    found = [tuple(r) for r in df.collect()]
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(found) == len(wanted)
    a, b = _rows(df.columns, found), _rows(columns, wanted)
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not different, (len(different), different[:3])
    return len(found)
