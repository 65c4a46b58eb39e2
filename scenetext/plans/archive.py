"""The whole flow over an archive of band files: scan, compose, report, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scenetext.functions import cells as C
from scenetext.functions.paths import BANDS
from scenetext.operators import tiles as T
from scenetext.operators.raster import TILE
from scenetext.sinks import scenes as K
from scenetext.sinks.folders import shared_folder
from scenetext.sources import rasters as S


def archive_headers(
    spark: SparkSession, root: str, bands: Sequence[str] = BANDS, ranged: bool = True
) -> DataFrame:
    """Headers of all band files below ``root`` with scene and band, written once
    to the shared folder: bounds, crowded cells and the report all use this small table."""
    headers = S.scene_catalog(S.raster_info(spark, root, bands, ranged), bands)
    folder = shared_folder(spark, "headers")
    headers.write.parquet(folder)
    return spark.read.schema(headers.schema).parquet(folder)


def archive_errors(files: DataFrame, bands: Sequence[str] = BANDS) -> DataFrame:
    """``path, scene_id, band, error``: everything that a composite has to do without.

    ``files`` are headers or decoded tiles. A file that can't be read is a row
    with its path; a band of a scene without any readable file and a layer of
    mixed cell sizes are rows without one. Every scene that misses something
    has a row, so an empty table means that nothing was left out.
    """
    readable = F.col("error").isNull()
    nothing = F.lit(None).cast("string")
    unread = files.where(~readable).select("path", "scene_id", "band", "error")
    # at most one name per band and scene
    found = files.groupBy("scene_id").agg(F.collect_set(F.when(readable, F.col("band"))).alias("found"))
    missing = F.explode(F.array_except(F.array(*map(F.lit, bands)), "found"))
    gaps = found.select(
        nothing.alias("path"), "scene_id", missing.alias("band"), F.lit("no readable file").alias("error")
    )
    crs = F.coalesce("crs", F.lit("unknown reference system"))
    mixed = T.mixed_layers(files.where(readable)).select(
        nothing.alias("path"),
        "scene_id",
        nothing.alias("band"),
        F.concat(F.lit("cell sizes differ in "), crs).alias("error"),
    )
    return unread.union(gaps).union(mixed)


def compose_archive(
    spark: SparkSession,
    root: str,
    bands: Sequence[str] = BANDS,
    stretch: bool = False,
    ranged: bool = True,
    tile: int = TILE,
    headers: DataFrame | None = None,
    damaged: Observation | None = None,
) -> DataFrame:
    """Composite tiles of every scene below ``root``, all scenes in one job.

    Sources overlap in order of their path. ``stretch`` scales every band
    between its own percentiles instead of the fixed sensor range. ``headers``
    are those of ``archive_headers``, where the caller has them. Files are read
    once (twice with ``stretch``). ``damaged`` gets the number ``files`` of
    those that can't be decoded, counted while the composite is computed.
    """
    headers = archive_headers(spark, root, bands, ranged) if headers is None else headers
    headers = headers.withColumn("source", F.col("path"))
    tiles = S.scan_rasters(spark, root, bands).withColumn("source", F.col("path"))
    if damaged is not None:
        tiles = tiles.observe(damaged, F.count_if(F.col("error").isNotNull()).alias("files"))
    if stretch:
        readable = tiles.where(F.col("cells").isNotNull())
        stretched = T.percentile_stretch(readable)
        return T.composite(stretched, headers, bands, C.OUT_MIN, C.OUT_MAX, tile)
    return T.composite(tiles, headers, bands, tile=tile)


def write_archive(composite: DataFrame, out: str, image: str | None = None) -> None:
    """The composite as a table by scene, or as image files."""
    if image is None:
        K.write_scenes(composite, out)
    else:
        K.write_images(K.render_tiles(composite, image), out, image)
