"""User functions over rows, for what no expression can say.

Functions get plain Python values, one column of an Arrow batch at a time, and
NULL as None; all other columns stay with Spark, so no value changes its type. A
batch is the most a task holds in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

# Distinct keys a task holds while it combines before the shuffle.
COMBINE_KEYS = 200_000

# Keys per output batch of the reduction.
OUTPUT_KEYS = 10_000


def _schema(df: DataFrame, keep: list[str], name: str, type_: str) -> StructType:
    """Columns ``keep`` as they are, and one more."""
    return StructType([df.schema[c] for c in keep] + StructType.fromDDL(f"`{name}` {type_}").fields)


def map_rows(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """``fn`` over batches of rows; it may keep, drop or multiply rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def map_column(
    df: DataFrame, column: str, fn: Callable[[Any], Any], name: str, type_: str
) -> DataFrame:
    """New column ``name`` = ``fn`` of every value of ``column``.

    An expression of the projection: only ``column`` passes through Python,
    and Spark still leaves out columns that no one asks for.
    """
    return df.select(*(c for c in df.columns if c != name), _expression(fn, type_)(column).alias(name))


def _expression(fn: Callable[[Any], Any], type_: str) -> Callable:
    kind = to_arrow_type(_parse(type_))

    def apply(values: pa.Array) -> pa.Array:
        return pa.array([fn(v) for v in values.to_pylist()], kind)

    return F.arrow_udf(apply, type_)


def _parse(type_: str) -> DataType:
    return StructType.fromDDL(f"x {type_}")["x"].dataType


def filter_rows(df: DataFrame, column: str, predicate: Callable[[Any], bool]) -> DataFrame:
    """Rows for whose ``column`` the predicate holds; only ``column`` passes through Python."""
    return df.where(_expression(lambda v: bool(predicate(v)), "boolean")(column))


def flat_map(
    df: DataFrame, column: str, fn: Callable[[Any], list], name: str, type_: str
) -> DataFrame:
    """One row per element of ``fn(value)``; the other columns are kept."""
    keep = [c for c in df.columns if c not in (column, name)]
    return df.select(*keep, F.explode(_expression(fn, f"array<{type_}>")(column)).alias(name))


def reduce_rows(
    df: DataFrame, key: str, value: str, fn: Callable[[Any, Any], Any], type_: str
) -> DataFrame:
    """Values of every key folded with a commutative, associative ``fn(a, b)``.

    NULL is a key like any other; NULL values are left out, as in a sum, and a
    key without any other value gets NULL.

    A task first folds its own rows, so that a hot key leaves it as one row
    (one per ``COMBINE_KEYS`` other keys at most). After the shuffle the rows
    of a key follow each other and are folded as they stream by; no group is
    held in memory.
    """
    schema = _schema(df, [key], value, type_)

    def folding(most: int, out: StructType) -> Callable:
        kinds = [to_arrow_type(f.dataType) for f in out.fields]

        def table(folded: dict) -> pa.RecordBatch:
            arrays = [pa.array(list(x), k) for x, k in zip((folded.keys(), folded.values()), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [key, value])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            folded: dict = {}
            for batch in batches:
                pairs = zip(batch.column(key).to_pylist(), batch.column(value).to_pylist(), strict=True)
                for k, v in pairs:
                    if k not in folded and len(folded) >= most:
                        yield table(folded)
                        folded = {}
                    old = folded.get(k)
                    folded[k] = v if old is None else old if v is None else fn(old, v)
            yield table(folded)

        return run

    partial = df.select(key, value).mapInArrow(folding(COMBINE_KEYS, schema), schema)
    # at most OUTPUT_KEYS finished keys wait for output, besides the open one
    return partial.repartition(key).sortWithinPartitions(key).mapInArrow(folding(OUTPUT_KEYS, schema), schema)
