"""Raster files as tables: listing, headers, tiles and pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.functions import paths as P
from scenetext.sources.cells import arrow_schema, batch, cell_lists
from scenetext.sources.stores import open_store
from scenetext.sources.tiff import DAMAGED, read_band, read_header, read_header_at

HEADER_SCHEMA = (
    "path STRING, format STRING, cols INT, rows INT, bands INT, "
    "xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE, crs STRING, error STRING"
)
TILE_SCHEMA = (
    "path STRING, sample INT, cols INT, rows INT, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE, "
    "crs STRING, cells ARRAY<INT>, error STRING"
)

# Side of the windows a file is cut into: a row stays near 1 MB however large the file.
WINDOW = 512


def raster_files(spark: SparkSession, root: str, bands: Sequence[str] = P.BANDS) -> DataFrame:
    """Band files below ``root`` with their content.

    The name pattern is a reader option, so other files are never opened, and a
    plan that does not use ``content`` only lists.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", P.band_glob(bands))
        .load(root)
    )


def scene_catalog(files: DataFrame, bands: Sequence[str] = P.BANDS) -> DataFrame:
    """Scene, band and channel number of every band file; any other file is dropped."""
    path = F.col("path")
    return (
        files.where(P.has_band(path, bands))
        .withColumns({"scene_id": P.scene_id(path), "band": P.band_name(path)})
        .withColumn("band_index", P.band_index(F.col("band"), bands))
    )


def scene_band_counts(catalog: DataFrame, bands: Sequence[str] = P.BANDS) -> DataFrame:
    """Files per scene and whether every band is there."""
    present = [F.max((F.col("band") == b).cast("int")) for b in bands]
    found = sum(present[1:], present[0])
    return catalog.groupBy("scene_id").agg(
        F.count("*").alias("files"), (found == len(bands)).alias("complete")
    )


def scene_index(lines: DataFrame, line: str = "line") -> DataFrame:
    """Product fields of index lines ``root,scene path,file name``."""
    fields = P.product_fields(F.col(line))
    return lines.select(*(c.alias(name) for name, c in fields.items()))


def _header_row(path: str, read: Callable[[], dict]) -> dict:
    try:
        head = read()
    except DAMAGED as e:
        return {"path": path, "error": str(e)}
    plain = {k: head[k] for k in ("cols", "rows", "bands", "crs")}
    return {"path": path, "format": "GTiff", **head["extent"], **plain}


def decode_headers(files: DataFrame) -> DataFrame:
    """Format, size and extent of every file (``path, content``); a file that
    can't be read gets ``error``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            pairs = zip(files.column(0).to_pylist(), files.column(1).to_pylist(), strict=True)
            rows = [_header_row(p, lambda data=data: read_header(data)) for p, data in pairs]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = arrow_schema(HEADER_SCHEMA)
    return files.select("path", "content").mapInArrow(decode, HEADER_SCHEMA)


def probe_headers(files: DataFrame) -> DataFrame:
    """As ``decode_headers``, but the tasks open the files (``path``) themselves
    and read a few kilobytes of each. A file that can't be opened at all fails
    the job, as it would for Spark's own reader."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            rows = []
            for path in files.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    rows.append(_header_row(path, lambda f=f: read_header_at(ranged(f))))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = arrow_schema(HEADER_SCHEMA)
    return files.select("path").mapInArrow(probe, HEADER_SCHEMA)


def ranged(file: pa.NativeFile) -> Callable[[int, int], bytes]:
    """Reading of a part of a file; behind its end there is nothing."""

    def read(start: int, n: int) -> bytes:
        return file.read_at(n, start) if start <= file.size() else b""

    return read


def decode_rasters(
    files: DataFrame, samples: Sequence[int] = (0,), window: int = WINDOW
) -> DataFrame:
    """Files (``path, content``) as tiles: one row per window and sample of a file.

    A file no larger than ``window`` is one row; ``samples`` picks from the
    bands inside a file. NoData cells are NULL. A file that can't be decoded is
    one row with ``error`` and no cells. Scene and band come from the path.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for path, content in zip(*files.columns, strict=True):
                data = content.as_buffer().to_pybytes()
                name = {"path": path.as_py()}
                try:
                    head = read_header(data)
                    images = [(k, read_band(data, head, k)) for k in samples]
                except DAMAGED as e:
                    yield batch(schema, **name, error=str(e))
                    continue
                for sample, image in images:
                    for tile in _windows(image, head, window):
                        yield batch(schema, **name, sample=sample, crs=head["crs"], **tile)

    schema = arrow_schema(TILE_SCHEMA)
    tiles = files.select("path", "content").mapInArrow(decode, TILE_SCHEMA)
    return tiles.withColumns(
        {"scene_id": P.scene_id(F.col("path")), "band": P.band_name(F.col("path"))}
    )


def _windows(image: np.ndarray, head: dict, window: int) -> Iterator[dict]:
    xmin, ymin, xmax, ymax = head["extent"].values()
    rows, cols = image.shape
    sx, sy = (xmax - xmin) / cols, (ymax - ymin) / rows
    for top in range(0, rows, window):
        for left in range(0, cols, window):
            part = image[top : top + window, left : left + window].astype(np.int32)
            yield {
                "cols": part.shape[1],
                "rows": part.shape[0],
                "xmin": xmin + left * sx,
                "ymin": ymax - (top + part.shape[0]) * sy,
                "xmax": xmin + (left + part.shape[1]) * sx,
                "ymax": ymax - top * sy,
                "cells": cell_lists([part], pa.int32(), blank=head["nodata"]),
            }


def raster_info(
    spark: SparkSession, root: str, bands: Sequence[str] = P.BANDS, ranged: bool = False
) -> DataFrame:
    """Headers of all band files below ``root``.

    ``ranged`` reads only the headers instead of whole files; the executors'
    Python must be able to reach the file system (local or shared disk, or one
    that pyarrow opens).
    """
    files = raster_files(spark, root, bands)
    return probe_headers(files) if ranged else decode_headers(files)


def scan_rasters(
    spark: SparkSession,
    root: str,
    bands: Sequence[str] = P.BANDS,
    samples: Sequence[int] = (0,),
    window: int = WINDOW,
) -> DataFrame:
    """All band files below ``root`` as tiles."""
    return decode_rasters(raster_files(spark, root, bands), samples, window)


def raster_pixels(tiles: DataFrame) -> DataFrame:
    """Tiles as pixel form: one row per cell, ``x, y`` inside the tile, row 0 on top."""
    keep = [c for c in tiles.columns if c not in ("cells", "cols", "rows")]
    pixels = tiles.select(*keep, "cols", F.posexplode("cells").alias("px", "dn"))
    y = F.floor(F.col("px") / F.col("cols")).cast("int")
    return pixels.select(*keep, (F.col("px") % F.col("cols")).alias("x"), y.alias("y"), "dn")
