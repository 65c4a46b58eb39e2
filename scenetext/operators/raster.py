"""Raster operators on pixel form: one row per cell of one band.

``scene_id, band, x, y, dn`` plus the columns that order overlapping sources.
Row 0 is the top row. All operators work on every scene at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenetext.functions import cells
from scenetext.functions.paths import BANDS
from scenetext.plans.sizing import BROADCAST_BYTES, attach, measured_bytes, null_safe_join, sized

CHANNELS = ("r", "g", "b")
TILE = 512


def _source_order(order: Sequence[str]) -> Column:
    """Key that ranks the sources of a cell.

    A single number keeps the merge a hash aggregate. Several columns need a
    struct, whose variable width makes Spark sort instead; the result is the same.
    """
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _first_present(value: Column, order: Column, wanted: Column | None = None) -> Column:
    """Value of the lowest-ranked source that has data."""
    present = value.isNotNull() if wanted is None else value.isNotNull() & wanted
    return F.min_by(value, F.when(present, order))


def clamp(px: DataFrame, lo: int = cells.DN_MIN, hi: int = cells.DN_MAX) -> DataFrame:
    return px.withColumn("dn", cells.clamp(F.col("dn"), lo, hi))


def clamp_normalize(px: DataFrame, lo: int = cells.DN_MIN, hi: int = cells.DN_MAX) -> DataFrame:
    return px.withColumn("dn", cells.clamp_normalize(F.col("dn"), lo, hi))


def band_union(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, duplicates kept; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def merge_overlaps(
    px: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = ("scene_id", "band", "x", "y"),
) -> DataFrame:
    """One row per cell: the first source with data wins; NULL if none has any.

    ``order`` must rank the sources of a cell uniquely; give one BIGINT column
    where possible. The aggregate combines before the shuffle, so a cell
    covered by very many sources stays cheap.
    """
    return px.groupBy(*keys).agg(_first_present(F.col("dn"), _source_order(order)).alias("dn"))


def band_stack(
    px: DataFrame,
    order: Sequence[str],
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = ("scene_id", "x", "y"),
    channels: Sequence[str] = CHANNELS,
    complete_only: bool = False,
) -> DataFrame:
    """Bands side by side, overlaps merged, in one aggregate and one shuffle.

    A missing band is NULL; ``complete_only`` keeps cells that have every band.
    """
    rank = _source_order(order)
    stacked = (
        px.where(F.col("band").isin(*bands))
        .groupBy(*keys)
        .agg(
            *(
                _first_present(F.col("dn"), rank, F.col("band") == band).alias(channel)
                for band, channel in zip(bands, channels, strict=True)
            )
        )
    )
    return stacked.dropna(subset=list(channels)) if complete_only else stacked


def rgb_composite(
    px: DataFrame,
    order: Sequence[str],
    bands: Sequence[str] = BANDS,
    lo: int = cells.DN_MIN,
    hi: int = cells.DN_MAX,
) -> DataFrame:
    """Colour composite of every scene: clamp, normalize, merge, stack; missing channel = 0."""
    return band_stack(clamp_normalize(px, lo, hi), order, bands).fillna(0, list(CHANNELS))


def rgb_packed(rgb: DataFrame) -> DataFrame:
    """``rgba``: the composite's channels as one colour value."""
    return rgb.withColumn("rgba", cells.pack_rgb(F.col("r"), F.col("g"), F.col("b")))


def tone_adjust(rgb: DataFrame, table: list[int] | None = None) -> DataFrame:
    """Brightness, gamma and contrast on every channel; NULL stays NULL."""
    table = table or cells.tone_table()
    return rgb.withColumns({c: cells.tone_adjust(F.col(c), table) for c in CHANNELS})


def layer_metadata(px: DataFrame, tile: int = TILE) -> DataFrame:
    """Bounds of every scene, its number of input cells ``n`` and the size of
    its grid of ``tile`` x ``tile`` cells."""
    bounds = px.groupBy("scene_id").agg(
        F.min("x").alias("xmin"),
        F.min("y").alias("ymin"),
        F.max("x").alias("xmax"),
        F.max("y").alias("ymax"),
        F.count("*").alias("n"),
    )
    cols, rows = F.col("xmax") - F.col("xmin") + 1, F.col("ymax") - F.col("ymin") + 1
    return bounds.withColumns(
        {
            "cols": cols,
            "rows": rows,
            "layout_cols": F.ceil(cols / tile).cast("int"),
            "layout_rows": F.ceil(rows / tile).cast("int"),
        }
    )


def tile_layout(
    px: DataFrame,
    tile: int = TILE,
    layer: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Grid key, in-tile position and tile size of every cell, the grid anchored
    at the scene's own bounds; tiles at its far edges end with the scene.

    ``layer`` is the ``layer_metadata`` of the scenes, where it can be had from
    something cheaper than ``px``, such as the cells before they were merged.
    """
    layer = layer_metadata(px, tile) if layer is None else layer
    anchors = layer.select("scene_id", "xmin", "ymin", "cols", "rows", "n")
    placed = attach(px, sized(anchors), ["scene_id"], ["x", "y"], limit)
    dx, dy = F.col("x") - F.col("xmin"), F.col("y") - F.col("ymin")
    col, row = F.floor(dx / tile).cast("int"), F.floor(dy / tile).cast("int")
    return placed.withColumns(
        {
            "layout_col": col,
            "layout_row": row,
            "tile_x": F.pmod(dx, F.lit(tile)),
            "tile_y": F.pmod(dy, F.lit(tile)),
            "tile_cols": F.least(F.lit(tile), F.col("cols") - col * tile),
            "tile_rows": F.least(F.lit(tile), F.col("rows") - row * tile),
        }
    ).drop("xmin", "ymin", "cols", "rows")


def stitch_lines(
    merged: DataFrame,
    segment: int = TILE,
    layer: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Merged cells laid out as scan lines, in segments of at most ``segment`` cells.

    ``cells`` is dense: gaps are NULL. Segments in order of ``segment`` make up
    the line, so no row grows with the width of the scene. ``layer`` as in
    ``tile_layout``.
    """
    layer = layer_metadata(merged, segment) if layer is None else layer
    extent = layer.select("scene_id", "xmin", "xmax", "n")
    placed = attach(merged, sized(extent), ["scene_id"], ["x", "y"], limit)
    lines = (
        placed.withColumn("segment", F.floor((F.col("x") - F.col("xmin")) / segment).cast("int"))
        .groupBy("scene_id", "band", "y", "segment", "xmin", "xmax")
        .agg(F.array_sort(F.collect_list(F.struct("x", F.col("dn").alias("v")))).alias("e"))
        .withColumn("x_from", F.col("xmin") + F.col("segment") * segment)
        .withColumn("x_to", F.least(F.col("x_from") + segment - 1, F.col("xmax")))
    )
    gap = F.lit(None).cast("int")
    # x of the cell to the left of each one; the segment's edge stands before the first.
    left = F.slice(F.concat(F.array(F.col("x_from") - 1), F.col("e.x")), F.lit(1), F.size("e"))
    filled = F.flatten(
        F.zip_with(
            "e", left, lambda c, x: F.concat(F.array_repeat(gap, c["x"] - x - 1), F.array(c["v"]))
        )
    )
    tail = F.array_repeat(gap, F.col("x_to") - F.element_at("e.x", -1))
    dense = F.concat(filled, tail).alias("cells")
    return lines.select("scene_id", "band", "y", "segment", "x_from", dense)


def value_histogram(px: DataFrame, keys: Sequence[str] = ("scene_id", "band")) -> DataFrame:
    """Cells ``n`` per value, NoData under NULL.

    Only counts cross the network: at most one row per key, value and task.
    """
    return px.groupBy(*keys, "dn").agg(F.count("*").alias("n"))


def histogram_bounds(
    histogram: DataFrame, percent: float = 2, keys: Sequence[str] = ("scene_id", "band")
) -> DataFrame:
    """Exact lower and upper percentile of the positive values, linearly
    interpolated; NULL where nothing is positive. ``n`` counts all cells.

    For a whole ``percent`` the exact result has two decimals. Rounding takes
    off what floating point adds to it, which could tip a stretched value.
    """
    at = F.array(F.lit(percent / 100), F.lit(1 - percent / 100))
    positive = F.when(F.col("dn") > 0, F.col("dn"))
    low, high = (F.round(F.col("p")[i], 6) for i in (0, 1))
    return (
        histogram.groupBy(*keys)
        .agg(F.percentile(positive, at, F.col("n")).alias("p"), F.sum("n").alias("n"))
        .select(*keys, low.alias("p_low"), high.alias("p_high"), "n")
    )


def percentile_bounds(
    px: DataFrame, percent: float = 2, keys: Sequence[str] = ("scene_id", "band")
) -> DataFrame:
    return histogram_bounds(value_histogram(px, keys), percent, keys)


def percentile_stretch(
    px: DataFrame,
    percent: float = 2,
    keys: Sequence[str] = ("scene_id", "band"),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Contrast stretch of every band of every scene between its own percentiles.

    ``dn`` is replaced by the stretched value; NoData and cells <= 0 become NULL.
    """
    bounds = sized(percentile_bounds(px, percent, keys))
    joined = attach(px, bounds, keys, ["x", "y"], limit)
    stretched = cells.stretch(F.col("dn"), F.col("p_low"), F.col("p_high"))
    return joined.withColumn("dn", stretched).drop("p_low", "p_high")


def stretch_stack(
    px: DataFrame,
    order: Sequence[str],
    bands: Sequence[str] = ("B2", "B3", "B4"),
    percent: float = 2,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Stretched bands side by side: the byte image with three bands."""
    wanted = px.where(F.col("band").isin(*bands))
    return band_stack(percentile_stretch(wanted, percent, limit=limit), order, bands)


def stack_by_center(
    px: DataFrame, order: Sequence[str], bands: Sequence[str] = BANDS, scale: int = 5
) -> DataFrame:
    """Band stack for extents that differ by floating-point noise: cells meet on
    their centre (``cx``, ``cy``), rounded half up to ``scale`` decimals.

    Noise may lie on both sides of a rounding border. So rounded coordinates
    that follow one another without a gap are one, the least of them. Only the
    distinct coordinates of an axis are compared, and only those that move are
    joined back, as a rule none.
    """
    rounded = px.withColumns({c: F.round(c, scale) for c in ("cx", "cy")})
    for axis in ("cx", "cy"):
        moved = _moved(rounded, axis, scale)
        n_bytes, _ = measured_bytes(moved)
        moved = F.broadcast(moved) if n_bytes <= BROADCAST_BYTES else moved
        joined = null_safe_join(rounded, moved, ["scene_id", axis], "left")
        rounded = joined.withColumn(axis, F.coalesce("_to", axis)).drop("_to")
    return band_stack(rounded, order, bands, keys=("scene_id", "cx", "cy"))


def _moved(px: DataFrame, axis: str, scale: int) -> DataFrame:
    """``scene_id``, coordinate and ``_to``: where the coordinates right behind another one belong."""
    step = (F.col(axis) * 10**scale).cast("decimal(38,0)")
    seen = px.where(F.col(axis).isNotNull()).select("scene_id", axis).distinct().withColumn("_step", step)
    along = Window.partitionBy("scene_id").orderBy("_step")
    begins = F.coalesce(F.col("_step") - F.lag("_step").over(along) > 1, F.lit(True))
    first = F.last(F.when(F.col("_begins"), F.col(axis)), ignorenulls=True)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = seen.withColumn("_begins", begins).withColumn("_to", first.over(upto))
    return groups.where(~F.col("_begins")).select("scene_id", axis, "_to").persist(StorageLevel.MEMORY_AND_DISK)


def quantile_breaks(
    px: DataFrame, classes: int = 256, keys: Sequence[str] = ("scene_id", "band")
) -> DataFrame:
    """Class of every value so that the classes hold equally many cells.

    The class of ``v`` is the number of breaks <= v, a break lying at every
    1/``classes`` of the cumulated count. The window runs over value counts,
    whose number the value range bounds, and never over cells.
    """
    return _classes(px, classes, keys).where(F.col("dn").isNotNull())


def _classes(px: DataFrame, classes: int, keys: Sequence[str]) -> DataFrame:
    """Value counts with ``class_id``, NULL for the count of NoData."""
    data = F.when(F.col("dn").isNotNull(), F.col("n"))
    w = Window.partitionBy(*keys)
    upto = w.orderBy("dn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.call_function("div", F.sum(data).over(upto) * classes, F.sum(data).over(w))
    class_id = F.least(F.lit(classes - 1), share).cast("int")
    return value_histogram(px, keys).withColumn(
        "class_id", F.when(F.col("dn").isNotNull(), class_id)
    )


def colour_ramp(class_id: Column, classes: int = 256) -> Column:
    """RGBA of a class on the straight line from red (class 0) to blue (last class)."""
    blue = F.call_function("div", class_id.cast("bigint") * 255, F.lit(classes - 1))
    return (F.lit(255) - blue) * 16777216 + blue * 256 + 255


def class_steps(
    px: DataFrame, classes: int = 256, keys: Sequence[str] = ("scene_id", "band")
) -> DataFrame:
    """One row per key: ``starts``, the least value of each class that occurs, ascending, ``ids``,
    those classes (both at most ``classes`` long), and ``n``, the number of cells."""
    first = _classes(px, classes, keys).groupBy(*keys, "class_id").agg(F.min("dn").alias("start"), F.sum("n").alias("n"))
    step = F.when(F.col("class_id").isNotNull(), F.struct("start", "class_id"))
    listed = first.groupBy(*keys).agg(F.sort_array(F.collect_list(step)).alias("s"), F.sum("n").alias("n"))
    return listed.select(*keys, F.col("s.start").alias("starts"), F.col("s.class_id").alias("ids"), "n")


def with_class(px: DataFrame, classes: int = 256) -> DataFrame:
    """Column ``class_id`` in place of ``starts`` and ``ids``, by binary search: one probe for each
    bit of the number of classes, whatever the range of values."""
    px = px.withColumn("_at", F.lit(0))
    for k in reversed(range((classes - 1).bit_length())):
        ahead = F.col("_at") + (1 << k)
        px = px.withColumn("_at", F.when(F.get("starts", ahead) <= F.col("dn"), ahead).otherwise(F.col("_at")))
    class_id = F.when(F.col("dn").isNotNull(), F.get("ids", F.col("_at")))
    return px.withColumn("class_id", class_id).drop("starts", "ids", "_at")


def quantile_colours(
    px: DataFrame,
    classes: int = 256,
    keys: Sequence[str] = ("scene_id", "band"),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rgba`` of every cell by the class of its value; NoData is white."""
    joined = attach(px, sized(class_steps(px, classes, keys)), keys, ["x", "y"], limit)
    rgba = F.coalesce(colour_ramp(F.col("class_id"), classes), F.lit(cells.NODATA_COLOUR))
    return with_class(joined, classes).withColumn("rgba", rgba).drop("class_id")


# Size of a quantile sketch. A quantile from it has the rank asked for within SKETCH_ERROR of all values (with 99 %
# confidence), however many there are and however they were merged.
SKETCH_K = 2000
SKETCH_ERROR = 0.0015


def percentile_sketches(
    px: DataFrame, keys: Sequence[str] = ("scene_id", "band"), value: str = "dn", k: int = SKETCH_K
) -> DataFrame:
    """``sketch BINARY`` of the positive values of every key, and their number ``n``.

    For values of any kind, as reflectances in floating point, of which a
    histogram would have as many rows as there are cells. Some 30 KB for a key
    and task cross the network. Stored sketches of parts can be merged later.
    """
    positive = F.when(F.col(value) > 0, F.col(value).cast("double"))
    return px.groupBy(*keys).agg(F.kll_sketch_agg_double(positive, k).alias("sketch"), F.count(positive).alias("n"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ("scene_id", "band")) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def sketch_bounds(sketches: DataFrame, percent: float = 2) -> DataFrame:
    """``p_low, p_high`` of every sketch in place of it; NULL where nothing was positive."""
    at = (percent / 100, 1 - percent / 100)
    low, high = (F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for p in at)
    return sketches.withColumns({"p_low": low, "p_high": high}).drop("sketch")
