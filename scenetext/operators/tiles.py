"""Raster operators on tile form: one row per tile, its cells in one array.

``scene_id, band, source, xmin, ymin, xmax, ymax, cols, rows, cells``, cells row
by row from the top. ``source`` is any column that ranks overlapping tiles.
Same rules as on pixel form, with numpy on Arrow batches inside the tasks: for
files, where one row per cell would be far too many rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenetext.functions import cells as C
from scenetext.functions.paths import BANDS, band_index
from scenetext.operators.raster import CHANNELS, TILE, histogram_bounds
from scenetext.plans.sizing import (
    BROADCAST_BYTES,
    Sized,
    attach,
    measured_bytes,
    null_safe_join,
    sized,
)
from scenetext.sources.cells import (
    NODATA,
    arrow_schema,
    batch,
    cell_arrays,
    cell_lists,
    map_cells,
    slices,
)

# Pieces of a grid cell that one group takes before the cell is split.
MAX_PIECES = 256

# Cell sizes that differ by less than this share of them count as equal.
CELL_TOLERANCE = 1e-6

HEADER = ("scene_id", "crs", "band", "source", "xmin", "ymin", "xmax", "ymax", "cols", "rows")
CELL_KEYS = ("scene_id", "crs", "layout_col", "layout_row")


def _ddl(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _map_tiles(tiles: DataFrame, fn, drop: Sequence[str] = ()) -> DataFrame:
    """Replace ``cells`` by ``fn(record batch)``, a list column of the same rows."""
    keep = [c for c in tiles.columns if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            columns = [fn(rows) if c == "cells" else rows.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(columns, names=keep)

    return tiles.mapInArrow(run, T.StructType([tiles.schema[c] for c in keep]))


def _normalized(values: np.ndarray, lo: int, hi: int) -> np.ndarray:
    clamped = np.clip(values.astype(np.int64), lo, hi)
    return (clamped - lo) * C.OUT_MAX // (hi - lo)


def clamp_normalize(tiles: DataFrame, lo: int = C.DN_MIN, hi: int = C.DN_MAX) -> DataFrame:
    """Clamp and normalize every cell, as on pixel form."""

    def scale(rows: pa.RecordBatch) -> pa.ListArray:
        return map_cells(rows.column("cells"), lambda v: _normalized(v, lo, hi), pa.int32())

    return _map_tiles(tiles, scale)


def tone_adjust(tiles: DataFrame, table: list[int] | None = None) -> DataFrame:
    """Tone chain on cells 0..255, as on pixel form."""
    lookup = np.array(table or C.tone_table())

    def adjust(rows: pa.RecordBatch) -> pa.ListArray:
        return map_cells(rows.column("cells"), lambda v: lookup[np.maximum(v, 0)], pa.int32())

    return _map_tiles(tiles, adjust)


def value_histogram(tiles: DataFrame, keys: Sequence[str] = ("scene_id", "band")) -> DataFrame:
    """Cells ``n`` per value, NoData under NULL. Every task counts its own tiles;
    cells never leave it."""
    keys = list(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            at = rows.schema.get_field_index("cells")
            for i, values in enumerate(cell_arrays(rows.column(at))):
                value, n = np.unique(values, return_counts=True)
                same = [pa.repeat(rows.column(k)[i], len(value)) for k in keys]
                dn = pa.array(value.astype(np.int32), mask=value == NODATA)
                yield pa.RecordBatch.from_arrays(
                    [*same, dn, pa.array(n.astype(np.int64))], names=[*keys, "dn", "n"]
                )

    counted = tiles.select(*keys, "cells").mapInArrow(count, f"{_ddl(tiles, *keys)}, dn INT, n BIGINT")
    return counted.groupBy(*keys, "dn").agg(F.sum("n").alias("n"))


def percentile_bounds(
    tiles: DataFrame, percent: float = 2, keys: Sequence[str] = ("scene_id", "band")
) -> DataFrame:
    return histogram_bounds(value_histogram(tiles, keys), percent, keys)


def percentile_stretch(
    tiles: DataFrame,
    percent: float = 2,
    keys: Sequence[str] = ("scene_id", "band"),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Contrast stretch, as on pixel form. Reads the tiles twice: counts, then cells."""

    def apply(rows: pa.RecordBatch) -> pa.ListArray:
        low, high = (rows.column(c).to_pylist() for c in ("p_low", "p_high"))
        out = []
        for values, lo, hi in zip(cell_arrays(rows.column("cells")), low, high, strict=True):
            result = np.full(values.shape, NODATA, np.int64)
            seen = values > 0
            if lo is not None and seen.any():
                span = hi - lo
                share = (values[seen] - lo) / span if span else np.zeros(seen.sum())
                result[seen] = np.clip(np.floor(share * C.OUT_MAX), C.OUT_MIN, C.OUT_MAX)
            out.append(result)
        return cell_lists(out, pa.int32())

    bounds = sized(percentile_bounds(tiles, percent, keys))
    joined = attach(tiles, bounds, keys, ["source"], limit)
    return _map_tiles(joined, apply, drop=("p_low", "p_high"))


def _layers(headers: DataFrame, tile: int) -> DataFrame:
    """``layer_metadata`` with ``mixed_cells``: whether its tiles differ in cell size."""
    width = (F.col("xmax") - F.col("xmin")) / F.col("cols")
    height = (F.col("ymax") - F.col("ymin")) / F.col("rows")
    mixed = [F.max(c) - F.min(c) > F.lit(CELL_TOLERANCE) * F.min(c) for c in (width, height)]
    bounds = headers.groupBy(*_layer_keys(headers)).agg(
        F.min("xmin").alias("layer_xmin"),
        F.min("ymin").alias("layer_ymin"),
        F.max("xmax").alias("layer_xmax"),
        F.max("ymax").alias("layer_ymax"),
        F.min(width).alias("cell_width"),
        F.min(height).alias("cell_height"),
        F.count("*").alias("n"),
        (mixed[0] | mixed[1]).alias("mixed_cells"),
    )
    across = (F.col("layer_xmax") - F.col("layer_xmin")) / F.col("cell_width")
    down = (F.col("layer_ymax") - F.col("layer_ymin")) / F.col("cell_height")
    sized = bounds.withColumns(
        {"layer_cols": F.round(across).cast("int"), "layer_rows": F.round(down).cast("int")}
    )
    return sized.withColumns(
        {
            "layout_cols": F.ceil(F.col("layer_cols") / tile).cast("int"),
            "layout_rows": F.ceil(F.col("layer_rows") / tile).cast("int"),
        }
    )


def layer_metadata(headers: DataFrame, tile: int = TILE) -> DataFrame:
    """Bounds, cell size and grid size of every scene, from tile headers alone;
    if there is a ``crs`` column, of every reference system of a scene."""
    return _layers(headers, tile).drop("mixed_cells")


def mixed_layers(headers: DataFrame) -> DataFrame:
    """``scene_id`` (and ``crs``) of the layers whose tiles differ in cell size.
    Nothing is resampled, so ``composite`` leaves them out."""
    return _layers(headers, TILE).where("mixed_cells").select(*_layer_keys(headers))


def _layer_keys(df: DataFrame) -> list[str]:
    return ["scene_id", "crs"] if "crs" in df.columns else ["scene_id"]


def _with_crs(df: DataFrame) -> DataFrame:
    return df if "crs" in df.columns else df.withColumn("crs", F.lit(None).cast("string"))


def _placed(tiles: DataFrame, layer: Sized, limit: int) -> DataFrame:
    """Cell offsets ``dx, dy`` of every tile from the upper left corner of its scene."""
    dx = (F.col("xmin") - F.col("layer_xmin")) / F.col("cell_width")
    dy = (F.col("layer_ymax") - F.col("ymax")) / F.col("cell_height")
    return attach(tiles, layer, ["scene_id", "crs"], ["source"], limit).withColumns(
        {"dx": F.round(dx).cast("int"), "dy": F.round(dy).cast("int")}
    )


def _grid_cells(placed: DataFrame, tile: int) -> DataFrame:
    """One row per tile header and grid cell it touches."""

    def span(start: str, size: str):
        last = F.floor((F.col(start) + F.col(size) - 1) / tile)
        return F.explode(F.sequence(F.floor(F.col(start) / tile), last))

    spread = placed.withColumn("layout_col", span("dx", "cols"))
    return spread.withColumn("layout_row", span("dy", "rows"))


def _cut(placed: DataFrame, tile: int, lo: int, hi: int) -> DataFrame:
    """Tiles cut into the grid cells they touch, values already normalized.

    Two bytes per cell, so the shuffle that follows moves half of what the
    tiles hold.
    """
    meta = ("scene_id", "crs", "source", "channel", "layer_cols", "layer_rows")
    schema = (
        f"{_ddl(placed, *meta)}, layout_col INT, layout_row INT, off_x INT, off_y INT, "
        "cols INT, rows INT, cells ARRAY<SMALLINT>"
    )
    names = [*meta, "layout_col", "layout_row", "off_x", "off_y", "cols", "rows", "cells"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "cells"):
            shape = [rows.column(c).to_pylist() for c in ("dx", "dy", "cols", "rows")]
            origin, places, parts = [], [], []
            for i, values in enumerate(cell_arrays(rows.column("cells"))):
                dx, dy, cols, tall = (s[i] for s in shape)
                data = np.where(values == NODATA, NODATA, _normalized(values, lo, hi))
                data = data.reshape(tall, cols)
                for row in range(dy // tile, (dy + tall - 1) // tile + 1):
                    for col in range(dx // tile, (dx + cols - 1) // tile + 1):
                        top, left = max(row * tile, dy), max(col * tile, dx)
                        bottom, right = (row + 1) * tile - dy, (col + 1) * tile - dx
                        part = data[top - dy : bottom, left - dx : right]
                        at = [col, row, left - col * tile, top - row * tile]
                        origin.append(i)
                        places.append([*at, part.shape[1], part.shape[0]])
                        parts.append(part)
            if parts:
                kept = rows.select(meta).take(pa.array(origin)).columns
                numbers = [pa.array(v, pa.int32()) for v in zip(*places, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *numbers, cell_lists(parts, pa.int16())], names=names
                )

    return placed.select(*meta, "dx", "dy", "cols", "rows", "cells").mapInArrow(cut, schema)


class _Mosaic:
    """One grid cell while its pieces arrive, in any order.

    Keeps per channel and cell the value and the rank of the source it came
    from, so memory is the same for ten pieces or ten million.
    """

    def __init__(self, channels: int, tall: int, wide: int):
        self.value = np.full((channels, tall, wide), NODATA, np.int32)
        self.winner = np.zeros((channels, tall, wide), np.int32)
        self.sources: list = [None]

    def add(self, channel: int, top: int, left: int, value, winner, sources: list) -> None:
        """Put a piece in; ``winner`` indexes ``sources`` for every cell of it."""
        base = len(self.sources)
        self.sources += sources
        place = np.s_[channel, top : top + value.shape[0], left : left + value.shape[1]]
        order = sorted(range(1, len(self.sources)), key=self.sources.__getitem__)
        rank = np.zeros(len(self.sources), np.int64)
        rank[order] = np.arange(len(order))
        held, old = self.value[place], self.winner[place]
        take = (value != NODATA) & ((held == NODATA) | (rank[winner + base] < rank[old]))
        held[take] = value[take]
        old[take] = (winner + base)[take]
        if len(self.sources) > MAX_PIECES:
            self.compact()

    def compact(self) -> None:
        """Forget sources that no cell shows any more."""
        used, index = np.unique(self.winner, return_inverse=True)
        used_list = used.tolist()
        shift = 0 if used_list[0] == 0 else 1
        self.sources = [None] + [self.sources[i] for i in used_list if i]
        self.winner = (index + shift).reshape(self.winner.shape).astype(np.int32)


def _merged(pieces: DataFrame, part: Column, tile: int, channels: int) -> DataFrame:
    """First round for crowded cells: each part of a cell becomes one piece per
    channel that remembers which source every value came from."""
    keys = list(CELL_KEYS)
    source = pieces.schema["source"].dataType.simpleString()
    schema = (
        f"{_ddl(pieces, *keys, 'channel', 'layer_cols', 'layer_rows')}, off_x INT, off_y INT, "
        f"cols INT, rows INT, cells ARRAY<SMALLINT>, winner ARRAY<INT>, sources ARRAY<{source}>"
    )
    arrow = arrow_schema(schema)

    def merge(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        mosaic, layer = _collect(batches, key[2].as_py(), key[3].as_py(), tile, channels)
        mosaic.compact()
        for channel in range(channels):
            yield batch(
                arrow,
                **dict(zip(keys, [k.as_py() for k in key[:4]], strict=True)),
                **layer,
                channel=channel,
                off_x=0,
                off_y=0,
                cols=mosaic.value.shape[2],
                rows=mosaic.value.shape[1],
                cells=cell_lists([mosaic.value[channel]], pa.int16()),
                winner=cell_lists([mosaic.winner[channel]], pa.int32()),
                sources=mosaic.sources,
            )

    return pieces.withColumn("part", part).groupBy(*keys, "part").applyInArrow(merge, schema)


def _collect(
    batches: Iterator[pa.RecordBatch], col: int, row: int, tile: int, channels: int
) -> tuple[_Mosaic, dict]:
    mosaic, layer = None, {}
    for rows in batches:
        columns = {name: rows.column(name) for name in rows.schema.names}
        numbers = {
            c: columns[c].to_pylist()
            for c in ("channel", "off_x", "off_y", "cols", "rows", "layer_cols", "layer_rows")
        }
        if mosaic is None:
            layer = {k: numbers[k][0] for k in ("layer_cols", "layer_rows")}
            wide = min(tile, layer["layer_cols"] - col * tile)
            tall = min(tile, layer["layer_rows"] - row * tile)
            mosaic = _Mosaic(channels, tall, wide)
        winners = cell_arrays(columns["winner"]) if "winner" in columns else None
        for i, values in enumerate(cell_arrays(columns["cells"])):
            shape = numbers["rows"][i], numbers["cols"][i]
            value = values.reshape(shape)
            if winners is None:
                winner, sources = np.zeros(shape, np.int32), [columns["source"][i].as_py()]
            else:
                # Index 0 of a merged piece means "no source"; those cells are NoData.
                winner = np.maximum(next(winners).reshape(shape) - 1, 0)
                sources = columns["sources"][i].as_py()[1:] or [None]
            if (value != NODATA).any():
                mosaic.add(
                    numbers["channel"][i], numbers["off_y"][i], numbers["off_x"][i],
                    value, winner, sources,
                )
    return mosaic, layer


def _stacked(pieces: DataFrame, tile: int, channels: Sequence[str]) -> DataFrame:
    """Last round: one row per grid cell with one array per channel."""
    keys = list(CELL_KEYS)
    lists =", ".join(f"`{c}` ARRAY<INT>" for c in channels)
    schema = f"{_ddl(pieces, *keys)}, cols INT, rows INT, {lists}"
    arrow = arrow_schema(schema)

    def stack(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        mosaic, _ = _collect(batches, key[2].as_py(), key[3].as_py(), tile, len(channels))
        yield batch(
            arrow,
            **dict(zip(keys, [k.as_py() for k in key], strict=True)),
            cols=mosaic.value.shape[2],
            rows=mosaic.value.shape[1],
            **{
                name: cell_lists([mosaic.value[i]], pa.int32())
                for i, name in enumerate(channels)
            },
        )

    return pieces.groupBy(*keys).applyInArrow(stack, schema)


def composite(
    tiles: DataFrame,
    headers: DataFrame | None = None,
    bands: Sequence[str] = BANDS,
    lo: int = C.DN_MIN,
    hi: int = C.DN_MAX,
    tile: int = TILE,
    channels: Sequence[str] = CHANNELS,
    limit: int = BROADCAST_BYTES,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Colour composite of every scene on its own grid of ``tile`` x ``tile`` cells.

    Clamp, normalize and cut inside the tasks that hold the tiles, then one
    shuffle by grid cell that merges overlaps and stacks bands. A channel is
    NULL where no source has data. ``headers`` is ``tiles`` without cells where
    that is cheaper to get (a header pass over files); it gives the bounds of
    the scenes and shows which cells are covered so often that their pieces
    must be split over several groups first.

    With a ``crs`` column, every reference system of a scene is a grid of its
    own. Unreadable files and layers of mixed cell sizes are left out;
    ``plans.archive.archive_errors`` lists them.
    """
    wanted = F.col("band").isin(*bands)
    # Told by a header column, so that a pass over headers never touches cells.
    wanted &= F.col("cols").isNotNull()
    has_crs = "crs" in tiles.columns
    headers = _with_crs(tiles if headers is None else headers).where(wanted).select(*HEADER)
    tiles = _with_crs(tiles).where(wanted)
    unused = ("mixed_cells", "layer_ymin", "layer_xmax", "layout_cols", "layout_rows")
    layer = sized(_layers(headers, tile).where(~F.col("mixed_cells")).drop(*unused))
    placed = _placed(tiles, layer, limit).withColumn("channel", band_index(F.col("band"), bands))
    pieces = _cut(placed, tile, lo, hi)
    crowded = (
        _grid_cells(_placed(headers, layer, limit), tile)
        .groupBy(*CELL_KEYS)
        .agg(F.count("*").alias("pieces"))
        .where(F.col("pieces") > max_pieces)
        .select(*CELL_KEYS, F.ceil(F.sqrt("pieces")).cast("int").alias("parts"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    size, cells = measured_bytes(crowded)
    if cells:
        part = F.pmod(F.xxhash64("source"), F.col("parts"))
        if size <= limit:
            pieces = null_safe_join(pieces, F.broadcast(crowded), CELL_KEYS, "left")
        else:
            most = crowded.agg(F.max("parts")).first()[0]
            pieces = pieces.withColumn("parts", F.lit(most))
        pieces = _merged(pieces, F.coalesce(part, F.lit(0)), tile, len(channels))
    stacked = _stacked(pieces, tile, channels)
    return stacked if has_crs else stacked.drop("crs")


def to_pixels(tiles: DataFrame, tile: int = TILE, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Composite tiles as pixel form; cells without data in any channel are left out."""
    cell = F.posexplode(F.arrays_zip(*channels)).alias("i", "v")
    x = F.col("layout_col") * tile + F.col("i") % F.col("cols")
    y = F.col("layout_row") * tile + F.floor(F.col("i") / F.col("cols")).cast("int")
    return (
        tiles.select("scene_id", "layout_col", "layout_row", "cols", cell)
        .select("scene_id", x.alias("x"), y.alias("y"), *(f"v.{c}" for c in channels))
        .dropna("all", subset=list(channels))
    )
