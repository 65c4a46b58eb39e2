"""Test inputs: the driver's tables, and views of them in the shapes the operators take.

The same views exist as DuckDB text in ``scenetext.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.functions.paths import BANDS

# Column that ranks the overlapping sources of a pixel in ``pixels``.
PIXEL_ORDER = ("src",)

# Tile side used on ``pixels``, whose scenes are 64 cells wide.
PIXEL_TILE = 16

# Side of the tiles made from the 64 numbers of an embedding, and tiles per grid row.
TILE_SIDE, TILES_ACROSS = 8, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores if the reader plans fewer tasks than that.

    One small file is one task, too slow for rows that need much work (long
    texts, Python). A large table has splits enough, however few its files are,
    and is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel form with overlaps and NoData, from ``lineitem``.

    A source is an order line; ``src`` ends in the value, so lines that occur
    twice are ranked too. One number, so that merging stays a hash aggregate.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_suppkey % 4 AS INT) AS scene_id",
        "CASE l_linenumber % 3 WHEN 0 THEN 'B2' WHEN 1 THEN 'B3' ELSE 'B5' END AS band",
        "CAST(l_partkey % 64 AS INT) AS x",
        "CAST(l_orderkey % 64 AS INT) AS y",
        "CASE WHEN l_discount = 0.0 THEN NULL ELSE CAST(floor(l_extendedprice / 5) AS INT) END AS dn",
        "(l_orderkey * 8 + l_linenumber) * 1048576 + CAST(floor(l_extendedprice / 5) AS BIGINT) AS src",
    )


def centred_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pixels`` with cell centres that carry floating-point noise."""
    noise = (F.col("src") % 8 - 4) * 1e-7
    return pixels(spark, sf_dir).withColumns(
        {"cx": F.col("x") * 30 + 15.25 + noise, "cy": F.col("y") * 30 + 15.75 - noise}
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile form from ``embeddings``: 8 x 8 cells, overlapping by half a tile in x."""
    tile_no = "CAST(floor(vec_id / 3) AS INT)"
    place = f"CAST(floor({tile_no} / 5) AS INT)"
    names = ", ".join(f"'{b}'" for b in BANDS)
    return (
        spread(table(spark, sf_dir, "embeddings"))
        .selectExpr(
            f"CAST({tile_no} % 5 AS INT) AS scene_id",
            f"element_at(array({names}), CAST(vec_id % 3 + 1 AS INT)) AS band",
            f"{tile_no} AS tile_no",
            "vec_id AS source",
            f"CAST({place} % {TILES_ACROSS} * {TILE_SIDE // 2} AS INT) AS left",
            f"CAST(floor({place} / {TILES_ACROSS}) * {TILE_SIDE} AS INT) AS top",
            "transform(embedding, v -> CAST(floor(CAST(v AS DOUBLE) * 40000 + 9588) AS INT)) AS cells",
        )
        .selectExpr(
            "scene_id",
            "band",
            "tile_no",
            "source",
            "CAST(left AS DOUBLE) AS xmin",
            f"CAST(-top - {TILE_SIDE} AS DOUBLE) AS ymin",
            f"CAST(left + {TILE_SIDE} AS DOUBLE) AS xmax",
            "CAST(-top AS DOUBLE) AS ymax",
            f"{TILE_SIDE} AS cols",
            f"{TILE_SIDE} AS rows",
            "cells",
        )
    )


def asset_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of band files, from ``lineitem``."""
    scene = "concat('SC', CAST(l_suppkey AS STRING))"
    folder = "concat('/data/scenes/1985/', CAST(190 + l_suppkey % 10 AS STRING), '/026/')"
    name = f"concat({scene}, '/', {scene}, '_B', CAST(l_linenumber AS STRING), '.TIF')"
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber").distinct()
    return lines.selectExpr(f"concat({folder}, {name}) AS path")


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene index lines, from ``orders``."""
    product = "concat('LC08_L1GT_190026_', d, '_', d, '_01_RT')"
    return (
        spread(table(spark, sf_dir, "orders"))
        .selectExpr("o_orderkey AS k", "date_format(o_orderdate, 'yyyyMMdd') AS d")
        .selectExpr(
            f"concat('http://host.example/c1/L8,190/026/', {product}, ',', {product}, '_B', "
            "CAST(k % 11 + 1 AS STRING), '.TIF') AS line"
        )
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations"))


_MESSAGE = (
    "named_struct('lang', lang, 'text', text, "
    "'entities', named_struct('hashtags', array(named_struct('text', source))), "
    "'user', named_struct('name', concat('User ', CAST(doc_id AS STRING)), "
    "'screen_name', concat('u', CAST(doc_id AS STRING)), "
    "'followers_count', n_chars, 'description', source))"
)


def tweet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines from ``documents``, with an empty line per row of ``labels``."""
    records = documents(spark, sf_dir).selectExpr(f"to_json({_MESSAGE}) AS value")
    blank = table(spark, sf_dir, "labels").selectExpr("'' AS value")
    return records.union(blank)


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with fields that not all of them have, at several levels and in no order; some lines are cut off."""
    extra = (
        """concat(',"zzz":{"b":[1,2.5,{"y":true,"x":null}],"a":', doc_id, '}', """
        """CASE WHEN doc_id % 3 = 0 THEN ',"Place":{"k":[[],{}],"deep":[[["é",-7]]]}' ELSE '' END, ',"id":', doc_id, '}')"""
    )
    records = documents(spark, sf_dir).selectExpr("doc_id", f"to_json({_MESSAGE}) AS j")
    whole = records.selectExpr("doc_id", f"concat(left(j, length(j) - 1), {extra}) AS value")
    return whole.selectExpr("CASE WHEN doc_id % 37 = 5 THEN left(value, length(value) - 1) ELSE value END AS value")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by code with the key of their place, from ``supplier``."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS code", "s_nationkey AS value", "s_nationkey AS place"
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates by place, from ``nation``; places 20 and up have no second
    coordinate, so the loader rejects them."""
    coordinate = (
        "CASE WHEN n_nationkey < 20 "
        "THEN array(CAST(n_nationkey * 1.5 - 10 AS DOUBLE), CAST(45 + n_nationkey * 0.5 AS DOUBLE)) "
        "ELSE array(CAST(n_nationkey AS DOUBLE)) END AS coord"
    )
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS code", coordinate)
