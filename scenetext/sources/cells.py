"""Between Arrow list columns and numpy arrays of cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Stands for NoData while cells are in numpy; outside the range of any cell.
NODATA = np.iinfo(np.int32).min

# Cells of a batch that are worked on at a time; a row is never cut.
SLICE_CELLS = 1 << 18


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch(schema: pa.Schema, **values) -> pa.RecordBatch:
    """One row; a value may be a scalar or a one-row array, and is NULL if not given."""
    columns = [
        v if isinstance(v, pa.Array) else pa.array([v], field.type)
        for field in schema
        for v in [values.get(field.name)]
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def cell_values(column: pa.Array) -> np.ndarray:
    """All cells of a list column in one flat array, NoData as ``NODATA``."""
    return column.flatten().cast(pa.int32()).fill_null(int(NODATA)).to_numpy(zero_copy_only=False)


def cell_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """Cells of every row of a list column."""
    flat, at = cell_values(column), 0
    for n in column.value_lengths().fill_null(0).to_pylist():
        yield flat[at : at + n]
        at += n


def slices(batches: Iterator[pa.RecordBatch], *columns: str, most: int = SLICE_CELLS) -> Iterator[pa.RecordBatch]:
    """The rows of batches, with about ``most`` cells of the list columns at a time: Spark fills a
    batch by rows, however large they are, and what is made of them at a time should not grow with it."""
    for rows in batches:
        n = sum(rows.column(c).value_lengths().fill_null(0).to_numpy().astype(np.int64) for c in columns)
        part = (np.cumsum(n) - n) // most
        at = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), rows.num_rows]
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield rows.slice(a, b - a)


def cell_lists(
    arrays: Sequence[np.ndarray], kind: pa.DataType, blank: int | None = int(NODATA)
) -> pa.ListArray:
    """List column with one row per array; cells equal to ``blank`` become NULL."""
    flat = np.concatenate([a.reshape(-1) for a in arrays]) if arrays else np.zeros(0, np.int32)
    mask = flat == blank if blank is not None else None
    offsets = np.cumsum([0] + [a.size for a in arrays]).astype(np.int32)
    # Masked cells may hold NODATA, which a narrower type can't: zero them first.
    values = flat if mask is None else np.where(mask, 0, flat)
    values = pa.array(values.astype(kind.to_pandas_dtype()), kind, mask=mask)
    return pa.ListArray.from_arrays(offsets, values, type=pa.list_(kind))


def map_cells(column: pa.Array, fn, kind: pa.DataType) -> pa.ListArray:
    """``fn`` over all cells of a batch at once; NoData is left alone."""
    values = cell_values(column)
    result = np.where(values == NODATA, NODATA, fn(values))
    offsets = np.cumsum([0] + column.value_lengths().fill_null(0).to_pylist())
    return cell_lists([result[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], kind)
