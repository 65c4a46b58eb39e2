"""Composites as partitioned tables and as image files."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from scenetext.operators.raster import CHANNELS
from scenetext.sources.cells import cell_arrays, slices
from scenetext.sources.stores import open_store, qualified
from scenetext.sources.tiff import write_image


def write_scenes(scenes: DataFrame, path: str) -> None:
    """One folder per scene below ``path``; scenes written again replace their folder.

    The rebalance hint brings a scene's rows together and lets adaptive
    execution split a scene that is too large for one task, so a huge scene
    becomes several files and small ones don't become many.
    """
    (
        scenes.hint("rebalance", "scene_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("scene_id")
        .parquet(path)
    )


def encode_png(rgb: np.ndarray) -> bytes:
    """PNG of an array ``[row, col, 3]`` of bytes."""
    rows, cols, _ = rgb.shape

    def chunk(kind: bytes, body: bytes) -> bytes:
        crc = zlib.crc32(kind + body)
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", crc)

    # Every line starts with a filter byte, 0 for none.
    lines = np.zeros((rows, 1 + 3 * cols), np.uint8)
    lines[:, 1:] = rgb.reshape(rows, 3 * cols)
    head = struct.pack(">IIBBBBB", cols, rows, 8, 2, 0, 0, 0)
    body = chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")
    return b"\x89PNG\r\n\x1a\n" + body


def encode_tiff(rgb: np.ndarray) -> bytes:
    """Byte image with three bands."""
    return write_image(np.moveaxis(rgb, -1, 0))


ENCODERS = {"png": encode_png, "tif": encode_tiff}


def render_tiles(
    tiles: DataFrame, image: str = "png", channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """Composite tiles as images: ``image BINARY`` in place of the channel arrays.

    One image per grid cell, so its size does not grow with the scene. Missing
    channels are 0. No shuffle: every task renders the tiles it holds.
    """
    encode = ENCODERS[image]
    keep = [c for c in tiles.columns if c not in channels]
    schema = StructType([tiles.schema[c] for c in keep]).add("image", "binary")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, *channels):
            shapes = zip(rows.column("rows").to_pylist(), rows.column("cols").to_pylist(), strict=True)
            bands = zip(*(cell_arrays(rows.column(c)) for c in channels), strict=True)
            images = [
                encode(np.clip(np.stack(b, -1), 0, 255).astype(np.uint8).reshape(*shape, len(b)))
                for shape, b in zip(shapes, bands, strict=True)
            ]
            columns = [*(rows.column(c) for c in keep), pa.array(images, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "image"])

    return tiles.mapInArrow(render, schema)


def pixels_to_tiles(rgb: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Composite pixels with their grid position (see ``tile_layout``) as tiles.

    A group is one grid cell: at most one row per cell of the tile.
    """
    keys = ["scene_id", "layout_col", "layout_row", "tile_cols", "tile_rows"]
    names = ["scene_id", "layout_col", "layout_row", "cols", "rows"]
    types = [rgb.schema[k].dataType.simpleString() for k in keys]
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True))
    schema += "".join(f", `{c}` ARRAY<INT>" for c in channels)

    def gather(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        wide, tall = int(key[3]), int(key[4])
        at = cells["tile_y"].to_numpy() * wide + cells["tile_x"].to_numpy()
        row = dict(zip(names, key, strict=True))
        for c in channels:
            row[c] = np.zeros(wide * tall, np.int32)
            row[c][at] = cells[c].fillna(0).to_numpy(np.int32)
        return pd.DataFrame([row])

    wanted = rgb.select(*keys, "tile_x", "tile_y", *channels)
    return wanted.groupBy(*keys).applyInPandas(gather, schema)


def encode_files(tiles: DataFrame, nodata: int | None = None, tile: int | None = None) -> DataFrame:
    """Tiles (``path``, extent, ``cells``) as 16-bit single-band files ``path, content``, in one
    block or in blocks with sides of ``tile``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "cells"):
            shapes = zip(*(rows.column(c).to_pylist() for c in ("rows", "cols")), strict=True)
            corners = ("xmin", "ymin", "xmax", "ymax")
            extents = zip(*(rows.column(c).to_pylist() for c in corners), strict=True)
            cells = cell_arrays(rows.column("cells"))
            files = [
                write_image(np.maximum(c, 0).astype(np.uint16).reshape(1, *shape), extent, nodata=nodata, tile=tile)
                for c, shape, extent in zip(cells, shapes, extents, strict=True)
            ]
            columns = [rows.column("path"), pa.array(files, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "content"])

    return tiles.mapInArrow(encode, "path STRING, content BINARY")


STAGING = "_staging"
MANIFEST = "_manifest"
RENAMES = 16  # threads that publish


@dataclass
class _Drafts(WriterCommitMessage):
    """What one task wrote: the folder of its drafts and the names, in order."""

    folder: str
    names: list[str]


class ImageWriter(DataSourceWriter):
    """Writes ``name, image`` rows as files, in two phases.

    A task writes drafts into a folder of its own below ``_staging`` and only
    reports their names, so nothing of a failed or repeated task is seen. When
    all tasks are done, the driver publishes: it moves the drafts to their
    names, removes files that an earlier run left in the same scene folders,
    and writes the list of files of every folder as its ``_manifest``. The
    driver holds the names (some 50 bytes a file), never an image.
    """

    def __init__(self, folder: str):
        self.folder = folder
        self.job = uuid.uuid4().hex

    def _staging(self, root: str) -> str:
        return f"{root}/{STAGING}/{self.job}"

    def write(self, iterator) -> _Drafts:
        store, root = open_store(self.folder)
        drafts = f"{self._staging(root)}/{uuid.uuid4().hex}"
        store.create_dir(drafts, recursive=True)
        names = []
        for row in iterator:
            with store.open_output_stream(f"{drafts}/{len(names)}") as out:
                out.write(row.image)
            names.append(row.name)
        return _Drafts(drafts, names)

    def commit(self, messages) -> None:
        store, root = open_store(self.folder)
        found: dict[str, dict[str, str]] = {}  # by scene folder: name and draft
        for message in messages:
            for k, name in enumerate(message.names):
                scene, _, file = name.rpartition("/")
                found.setdefault(scene, {})[file] = f"{message.folder}/{k}"
        with ThreadPoolExecutor(RENAMES) as pool:
            for _ in pool.map(lambda item: _publish(store, f"{root}/{item[0]}".rstrip("/"), item[1]), found.items()):
                pass
        self._clean(store, root)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages) -> None:
        """Published files stay as they were; the drafts go."""
        self._clean(*open_store(self.folder))

    def _clean(self, store: fs.FileSystem, root: str) -> None:
        store.create_dir(root, recursive=True)
        if store.get_file_info(self._staging(root)).type == fs.FileType.Directory:
            store.delete_dir(self._staging(root))
        above = f"{root}/{STAGING}"
        if store.get_file_info(above).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(above)):
            store.delete_dir(above)


def _replace(store: fs.FileSystem, source: str, target: str) -> None:
    try:
        store.move(source, target)
    except OSError:
        # some stores do not move onto a file that is there
        store.delete_file(target)
        store.move(source, target)


def _publish(store: fs.FileSystem, folder: str, drafts: dict[str, str]) -> None:
    """The files of one scene folder: new ones in, files of its old manifest that are not among them
    out. A run that ends in between leaves whole files, and the next one finds them in the manifest,
    which names old and new ones until the end."""
    store.create_dir(folder, recursive=True)
    manifest = f"{folder}/{MANIFEST}"
    old = set()
    if store.get_file_info(manifest).type == fs.FileType.File:
        with store.open_input_file(manifest) as f:
            old = set(f.read().decode().splitlines())

    def write(names: set[str]) -> None:
        with store.open_output_stream(f"{manifest}.new") as out:
            out.write("\n".join(sorted(names)).encode())
        _replace(store, f"{manifest}.new", manifest)

    write(old | set(drafts))
    for name, draft in drafts.items():
        _replace(store, draft, f"{folder}/{name}")
    for name in old - set(drafts):
        if store.get_file_info(f"{folder}/{name}").type == fs.FileType.File:
            store.delete_file(f"{folder}/{name}")
    write(set(drafts))


class SceneImages(DataSource):
    """``df.write.format("scene_images").option("path", folder)`` for ``name, image`` rows."""

    @classmethod
    def name(cls) -> str:
        return "scene_images"

    def schema(self) -> str:
        return "name STRING, image BINARY"

    def writer(self, schema, overwrite: bool) -> ImageWriter:
        return ImageWriter(self.options["path"])


def write_files(files: DataFrame, folder: str) -> None:
    """Rows ``name, image`` as files below ``folder``, written by the executors: all or nothing.
    ``folder`` must be one that all of them reach; without a scheme it lies in Spark's default file system."""
    spark = files.sparkSession
    spark.dataSource.register(SceneImages)
    files.write.format("scene_images").mode("append").option("path", qualified(spark, folder)).save()


def write_images(images: DataFrame, folder: str, extension: str = "png") -> None:
    """Image files ``<scene>/<row>_<col>.<extension>`` below ``folder``; a scene written again has
    the new files only. Where the images have a column ``crs``, it begins their name, as every
    reference system of a scene is a grid of its own."""
    zone = [F.regexp_replace(F.coalesce("crs", F.lit("unknown")), "[^A-Za-z0-9]+", "-")] if "crs" in images.columns else []
    cell = F.concat_ws("_", *zone, "layout_row", "layout_col")
    name = F.concat(F.col("scene_id").cast("string"), F.lit("/"), cell, F.lit(f".{extension}"))
    write_files(images.select(name.alias("name"), "image"), folder)
