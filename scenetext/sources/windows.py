"""Raster files as a data source whose partitions are ranges of block rows.

``spark.read.format("raster_windows").load(root)``: a large file is read by
several tasks, small ones share a task. Filters on ``band`` and ``scene_id`` are
answered while listing, so other files are not opened.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scenetext.functions.paths import BANDS
from scenetext.sources.cells import batch, cell_lists
from scenetext.sources.rasters import WINDOW, ranged
from scenetext.sources.stores import open_store, qualified
from scenetext.sources.tiff import DAMAGED, block_height, n_block_rows, read_block_rows, read_header_at

SCHEMA = (
    "path STRING, scene_id STRING, band STRING, sample INT, top INT, left INT, cols INT, rows INT, xmin DOUBLE, ymin DOUBLE, "
    "xmax DOUBLE, ymax DOUBLE, crs STRING, cells ARRAY<INT>, error STRING"
)
SPLIT_BYTES = 32 * 1024 * 1024
TASKS_PER_CORE = 64  # beyond it tasks take several shares
SUFFIX = ".TIF"


@dataclass
class _Part:
    """Share ``number`` of ``of`` of the block rows of a file."""

    path: str
    number: int
    of: int


@dataclass
class _Parts(InputPartition):
    parts: list[_Part] = field(default_factory=list)


def _names(path: str) -> tuple[str | None, str | None]:
    """Scene and band of a path, by the rule of ``functions.paths``."""
    steps = path.split("/")
    scene = steps[-2] if len(steps) > 1 else None
    name, _, band = steps[-1].rpartition("_")
    known = name and band.endswith(SUFFIX) and band[0] == "B" and band[1 : -len(SUFFIX)].isalnum()
    return scene, band.removesuffix(SUFFIX) if known else None


class WindowReader(DataSourceReader):
    def __init__(
        self, schema: StructType, root: str, split_bytes: int, window: int, samples: Sequence[int], tasks: int | None = None
    ) -> None:
        self.columns = schema
        self.root, self.split_bytes, self.window, self.samples, self.tasks = root, split_bytes, window, samples, tasks
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality on scene and band picks files; Spark keeps every other filter."""
        for f in filters:
            known = isinstance(f, (EqualTo, In)) and f.attribute in (("band",), ("scene_id",))
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if known else set()
            if not known or None in values:
                yield f
                continue
            name = f.attribute[0]
            self.wanted[name] = self.wanted.get(name, values) & values

    def _files(self) -> Iterator[tuple[str, int]]:
        store, root = open_store(self.root)
        scheme = self.root[: len(self.root) - len(root)] if self.root.endswith(root) else ""
        for info in store.get_file_info(fs.FileSelector(root, recursive=True)):
            names = dict(zip(("scene_id", "band"), _names(info.path), strict=True))
            if info.type == fs.FileType.File and names["band"] and not info.base_name.startswith(("_", ".")):
                if all(names[k] in v for k, v in self.wanted.items()):
                    yield scheme + info.path, info.size or 0

    def partitions(self) -> list[_Parts]:
        """Only the listing counts: a share of a file is made of whole block rows by the task that
        reads it, so no file is opened here. Files are cut by ``split_bytes`` alone; where that makes
        more than about ``tasks`` tasks, one reads several shares, one after the other."""
        out, held, files = [], 0, sorted(self._files())
        most = self.split_bytes
        if self.tasks:
            most = max(most, -(-sum(size for _, size in files) // self.tasks))
        for path, size in files:
            of = max(1, -(-size // self.split_bytes))
            for number in range(of):
                if not out or held + size // of > most:
                    out.append(_Parts())
                    held = 0
                out[-1].parts.append(_Part(path, number, of))
                held += size // of
        return out

    def read(self, partition: _Parts) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.columns)
        for part in partition.parts:
            scene, band = _names(part.path)
            name = {"path": part.path, "scene_id": scene, "band": band}
            store, inner = open_store(part.path)
            with store.open_input_file(inner) as f:
                read = ranged(f)
                try:
                    head = read_header_at(read)
                    down = n_block_rows(head)
                except DAMAGED as e:
                    if part.number == 0:  # the other shares would only say so again
                        yield batch(schema, **name, error=str(e))
                    continue
                try:
                    first, end = down * part.number // part.of, down * (part.number + 1) // part.of
                    for sample in self.samples:
                        for tile in self._tiles(read, head, sample, first, end):
                            yield batch(schema, **name, sample=sample, crs=head["crs"], **tile)
                except DAMAGED as e:
                    yield batch(schema, **name, error=str(e))

    def _tiles(self, read, head: dict, sample: int, first: int, end: int) -> Iterator[dict]:
        """Windows of block rows ``first`` to ``end``; as many rows of blocks at a time as fit a window."""
        tall, edge = block_height(head), head["extent"]
        sx = (edge["xmax"] - edge["xmin"]) / head["cols"]
        sy = (edge["ymax"] - edge["ymin"]) / head["rows"]
        step = max(1, self.window // tall)
        for k in range(first, end, step):
            image = read_block_rows(read, head, sample, k, min(k + step, end))
            for top in range(0, image.shape[0], self.window):
                for left in range(0, head["cols"], self.window):
                    cells = image[top : top + self.window, left : left + self.window]
                    y = k * tall + top
                    yield {
                        "top": y,
                        "left": left,
                        "cols": cells.shape[1],
                        "rows": cells.shape[0],
                        "xmin": edge["xmin"] + left * sx,
                        "ymin": edge["ymax"] - (y + cells.shape[0]) * sy,
                        "xmax": edge["xmin"] + (left + cells.shape[1]) * sx,
                        "ymax": edge["ymax"] - y * sy,
                        "cells": cell_lists([cells.astype("int32")], pa.int32(), blank=head["nodata"]),
                    }


class RasterWindows(DataSource):
    """Options: ``path``; ``splitBytes`` of a task; ``window``, the side of a tile; ``samples``, comma-separated;
    ``tasks``, about how many at most."""

    @classmethod
    def name(cls) -> str:
        return "raster_windows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WindowReader:
        split = int(self.options.get("splitBytes", SPLIT_BYTES))
        window = int(self.options.get("window", WINDOW))
        samples = [int(s) for s in self.options.get("samples", "0").split(",")]
        tasks = int(self.options.get("tasks", 0)) or None
        return WindowReader(schema, self.options["path"], split, window, samples, tasks)


def scan_windows(
    spark: SparkSession, root: str, bands: Sequence[str] = BANDS, split_bytes: int = SPLIT_BYTES, window: int = WINDOW,
    samples: Sequence[int] = (0,),
) -> DataFrame:
    """All band files below ``root`` as tiles, large files by several tasks. The executors' Python
    must reach the file system. Turns on the session's pushdown of filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RasterWindows)
    read = spark.read.format("raster_windows").option("splitBytes", split_bytes).option("window", window)
    read = read.option("tasks", TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    tiles = read.option("samples", ",".join(map(str, samples))).load(qualified(spark, root))
    return tiles.where(tiles["band"].isin(*bands))
