"""Every operator as a named query over the tables of one scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.functions.paths import BANDS
from scenetext.functions.words import text_length
from scenetext.operators import places as PL
from scenetext.operators import raster as R
from scenetext.operators import rows as U
from scenetext.operators import sequences as Q
from scenetext.operators import text as X
from scenetext.operators import tiles as T
from scenetext.operators import tweets as TW
from scenetext.plans.archive import archive_errors
from scenetext.plans.sizing import BROADCAST_BYTES, attach, sized
from scenetext.sinks import scenes as K
from scenetext.sinks.folders import shared_folder
from scenetext.sources import rasters as S
from scenetext.sources import tables as V
from scenetext.sources import windows as SW

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Rasters, pixel form


@query
def clamp(spark, sf_dir):
    return R.clamp(V.pixels(spark, sf_dir))


@query
def clamp_normalize(spark, sf_dir):
    return R.clamp_normalize(V.pixels(spark, sf_dir))


@query
def raster_pixels(spark, sf_dir):
    pixels = S.raster_pixels(V.tiles(spark, sf_dir))
    return pixels.select("scene_id", "band", "tile_no", "x", "y", "dn")


@query
def band_union(spark, sf_dir):
    columns = ("scene_id", "band", "x", "y", "dn")
    tiles = S.raster_pixels(V.tiles(spark, sf_dir))
    return R.band_union(V.pixels(spark, sf_dir).select(*columns), tiles.select(*columns, "tile_no"))


@query
def merge_overlaps(spark, sf_dir):
    return R.merge_overlaps(V.pixels(spark, sf_dir), V.PIXEL_ORDER)


@query
def band_stack(spark, sf_dir):
    return R.band_stack(V.pixels(spark, sf_dir), V.PIXEL_ORDER)


@query
def complete_band_stack(spark, sf_dir):
    return R.band_stack(V.pixels(spark, sf_dir), V.PIXEL_ORDER, complete_only=True)


@query
def stack_by_center(spark, sf_dir):
    return R.stack_by_center(V.centred_pixels(spark, sf_dir), V.PIXEL_ORDER)


@query
def rgb_composite(spark, sf_dir):
    return R.rgb_composite(V.pixels(spark, sf_dir), V.PIXEL_ORDER)


@query
def rgb_packed(spark, sf_dir):
    return R.rgb_packed(rgb_composite(spark, sf_dir)).select("scene_id", "x", "y", "rgba")


@query
def tone_adjust(spark, sf_dir):
    return R.tone_adjust(rgb_composite(spark, sf_dir))


@query
def layer_metadata(spark, sf_dir):
    return R.layer_metadata(V.pixels(spark, sf_dir), V.PIXEL_TILE)


@query
def tile_layout(spark, sf_dir):
    merged = merge_overlaps(spark, sf_dir)
    return R.tile_layout(merged, V.PIXEL_TILE, layer_metadata(spark, sf_dir))


@query
def stitch_lines(spark, sf_dir):
    layer = layer_metadata(spark, sf_dir)
    lines = R.stitch_lines(merge_overlaps(spark, sf_dir), 24, layer)
    text = F.array_join(F.col("cells").cast("array<string>"), ",", "")
    return lines.withColumns({"n": F.size("cells"), "line": text}).drop("cells")


@query
def value_histogram(spark, sf_dir):
    return R.value_histogram(V.pixels(spark, sf_dir))


@query
def percentile_bounds(spark, sf_dir):
    return R.percentile_bounds(V.pixels(spark, sf_dir))


@query
def percentile_stretch(spark, sf_dir):
    return R.percentile_stretch(V.pixels(spark, sf_dir))


@query
def stretch_stack(spark, sf_dir):
    return R.stretch_stack(V.pixels(spark, sf_dir), V.PIXEL_ORDER, BANDS)


@query
def quantile_breaks(spark, sf_dir):
    return R.quantile_breaks(V.pixels(spark, sf_dir))


@query
def quantile_colours(spark, sf_dir):
    px = V.pixels(spark, sf_dir).select("scene_id", "band", "x", "y", "dn")
    return R.quantile_colours(px)


@query
def percentile_sketch(spark, sf_dir):
    """Percentiles of prices (no histogram) from sketches of two halves, and the rank they really have."""
    px = V.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_suppkey % 4 AS INT) AS scene_id", "CAST(l_linenumber % 3 AS INT) AS band", "l_extendedprice AS dn", "l_orderkey % 2 AS half"
    )
    bounds = R.sketch_bounds(R.merge_sketches(R.percentile_sketches(px, ("scene_id", "band", "half"))))
    joined = attach(px.drop("half"), sized(bounds), ["scene_id", "band"], ["dn"], BROADCAST_BYTES)
    at = {name: F.round(100 * F.avg((F.col("dn") <= F.col(p)).cast("int"))).cast("int") for name, p in (("low", "p_low"), ("high", "p_high"))}
    return joined.groupBy("scene_id", "band").agg(F.count("dn").alias("n"), *(c.alias(name) for name, c in at.items()))


# Rasters, tile form


@query
def tile_clamp_normalize(spark, sf_dir):
    pixels = S.raster_pixels(T.clamp_normalize(V.tiles(spark, sf_dir)))
    return pixels.select("scene_id", "band", "tile_no", "x", "y", "dn")


@query
def tile_percentile_stretch(spark, sf_dir):
    pixels = S.raster_pixels(T.percentile_stretch(V.tiles(spark, sf_dir)))
    return pixels.select("scene_id", "band", "tile_no", "x", "y", "dn")


@query
def tile_layer_metadata(spark, sf_dir):
    return T.layer_metadata(V.tiles(spark, sf_dir), V.PIXEL_TILE)


@query
def tile_layer_zones(spark, sf_dir):
    """Layers of scenes whose tiles lie in two reference systems."""
    crs = F.concat(F.lit("EPSG:3263"), (F.col("tile_no") % 2 + 1).cast("string"))
    return T.layer_metadata(V.tiles(spark, sf_dir).withColumn("crs", crs), V.PIXEL_TILE)


def _composite(spark, sf_dir):
    return T.composite(V.tiles(spark, sf_dir), tile=V.PIXEL_TILE)


@query
def tile_composite(spark, sf_dir):
    return T.to_pixels(_composite(spark, sf_dir), V.PIXEL_TILE)


# Raster files. The files are made from ``embeddings`` inside the query and go
# through the same decoding as files on disk.


def _band_files(spark, sf_dir, tile=None):
    """16-bit TIFF files in memory as ``path, content``; negative cells saved as NoData 0."""
    shifted = "transform(cells, v -> greatest(v, 0))"
    path = "concat('/data/SC', scene_id, '/', tile_no, '/SC', scene_id, '_', tile_no, '_', band, '.TIF')"
    tiles = V.tiles(spark, sf_dir).selectExpr(
        f"{path} AS path", "xmin", "ymin", "xmax", "ymax", "cols", "rows", f"{shifted} AS cells"
    )
    return K.encode_files(tiles, nodata=0, tile=tile)


@query
def scan_rasters(spark, sf_dir):
    tiles = S.decode_rasters(_band_files(spark, sf_dir))
    columns = ("path", "scene_id", "band", "xmin", "ymin", "xmax", "ymax", "crs", "error")
    return S.raster_pixels(tiles.select(*columns, "cols", "rows", "cells"))


@query
def raster_info(spark, sf_dir):
    return S.decode_headers(_band_files(spark, sf_dir))


def _written_files(spark, sf_dir):
    """Band files in the shared folder, written by the executors, each in four blocks; among them files of a band
    that no one asks for and files that are no rasters."""
    folder = shared_folder(spark, "rasters")
    files = _band_files(spark, sf_dir, tile=4).selectExpr("substring(path, 7) AS name", "content AS image")
    quality = files.where("name LIKE '%B2.TIF'").withColumn("name", F.expr("replace(name, '_B2.TIF', '_BQA.TIF')"))
    notes = quality.selectExpr("replace(name, '_BQA.TIF', '_MTL.txt') AS name", "X'00' AS image")
    K.write_files(files.union(quality).union(notes), folder)
    return folder


@query
def raster_listing(spark, sf_dir):
    """The band files below a folder, by listing alone."""
    files = S.raster_files(spark, _written_files(spark, sf_dir)).select("path")
    return S.scene_catalog(files).withColumn("path", F.substring_index("path", "/", -3))


@query
def split_scan(spark, sf_dir):
    """Two bands of those files, a file read by several tasks or several files by one."""
    tiles = SW.scan_windows(spark, _written_files(spark, sf_dir), ("B2", "B3"), split_bytes=400, window=4)
    tiles = tiles.withColumn("path", F.substring_index("path", "/", -3))
    pixels = S.raster_pixels(tiles.select("path", "scene_id", "band", "top", "left", "cols", "rows", "cells", "error"))
    return pixels.withColumns({"x": F.col("left") + F.col("x"), "y": F.col("top") + F.col("y")}).drop("top", "left")


@query
def image_files(spark, sf_dir):
    """Composite images as files; two scenes are written again with less, and all is read back."""
    folder = shared_folder(spark, "images")
    images = K.render_tiles(_composite(spark, sf_dir), "tif")
    K.write_images(images, folder, "tif")
    K.write_images(images.where("scene_id < 2 AND layout_row = 0"), folder, "tif")
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif")
    pixels = S.raster_pixels(S.decode_rasters(read.load(folder), samples=(0, 1, 2)))
    path = F.substring_index("path", "/", -2).alias("path")
    return pixels.select(path, F.col("sample").alias("channel"), "x", "y", "dn")


@query
def composite_errors(spark, sf_dir):
    """What a composite does without when the green files of every seventh scene are damaged."""
    hit = "path LIKE '%B3.TIF' AND CAST(regexp_extract(path, '_([0-9]+)_B', 1) AS INT) % 7 = 0"
    files = _band_files(spark, sf_dir).withColumn(
        "content", F.expr(f"CASE WHEN {hit} THEN substring(content, 1, 5) ELSE content END")
    )
    errors = archive_errors(S.decode_rasters(files))
    text = F.when(F.col("path").isNotNull(), "unreadable").otherwise(F.col("error"))
    return errors.withColumn("error", text)


@query
def render_tiles(spark, sf_dir):
    """Byte images with three bands, read back band by band."""
    images = K.render_tiles(_composite(spark, sf_dir), "tif")
    path = "concat(scene_id, '/', layout_col, '_', layout_row, '.tif')"
    files = images.selectExpr(f"{path} AS path", "image AS content")
    pixels = S.raster_pixels(S.decode_rasters(files, samples=(0, 1, 2)))
    return pixels.select("path", F.col("sample").alias("channel"), "x", "y", "dn")


@query
def render_png(spark, sf_dir):
    """PNG images of the pixel-form composite, one per grid cell."""
    layer = layer_metadata(spark, sf_dir)
    placed = R.tile_layout(rgb_composite(spark, sf_dir), V.PIXEL_TILE, layer)
    return K.render_tiles(K.pixels_to_tiles(placed))


@query
def write_scenes(spark, sf_dir):
    """The composite written by scene and read back."""
    folder = shared_folder(spark, "scenes")
    K.write_scenes(rgb_composite(spark, sf_dir), folder)
    return spark.read.schema("x INT, y INT, r INT, g INT, b INT, scene_id INT").parquet(folder)


# Catalog and places


@query
def scene_catalog(spark, sf_dir):
    return S.scene_catalog(V.asset_paths(spark, sf_dir))


@query
def scene_band_counts(spark, sf_dir):
    return S.scene_band_counts(scene_catalog(spark, sf_dir))


@query
def scene_index(spark, sf_dir):
    fields = S.scene_index(V.index_lines(spark, sf_dir))
    return fields.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("acquired", "processed")})


@query
def place_points(spark, sf_dir):
    places = PL.load_places(V.places(spark, sf_dir)).withColumnRenamed("code", "place")
    return PL.place_points(V.points(spark, sf_dir), places, on="place")


# Words


@query
def strip_punctuation(spark, sf_dir):
    return X.strip_punctuation(V.documents(spark, sf_dir).select("doc_id", "text"))


def _sentences(spark, sf_dir):
    return V.conversations(spark, sf_dir).select("conv_id", "turn", "text")


@query
def sentence_words(spark, sf_dir):
    split = X.sentence_words(_sentences(spark, sf_dir))
    return split.withColumns({"n": F.size("words"), "words": F.array_join("words", " ")})


@query
def words_flat(spark, sf_dir):
    return X.words_flat(_sentences(spark, sf_dir))


@query
def word_plural(spark, sf_dir):
    return X.plural(words_flat(spark, sf_dir))


@query
def word_lengths(spark, sf_dir):
    return X.with_length(words_flat(spark, sf_dir))


@query
def words_longer_than(spark, sf_dir):
    return X.longer_than(words_flat(spark, sf_dir), 3)


@query
def packed_turns(spark, sf_dir):
    """Sentences of a conversation packed into blocks of at most 40 words."""
    return Q.pack_sentences(_sentences(spark, sf_dir), "conv_id", "turn")


def _words(spark, sf_dir):
    return X.words(V.documents(spark, sf_dir))


@query
def word_total(spark, sf_dir):
    return X.total(_words(spark, sf_dir))


@query
def first_words(spark, sf_dir):
    return X.first_words(V.documents(spark, sf_dir), 5, "doc_id")


@query
def word_count(spark, sf_dir):
    return X.count_by_key(_words(spark, sf_dir), "w")


@query
def word_sum(spark, sf_dir):
    pairs = _words(spark, sf_dir).withColumn("n", F.lit(1))
    return X.reduce_by_key(pairs, "w")


@query
def top_words(spark, sf_dir):
    return X.top(word_count(spark, sf_dir), 10, "n", "w")


@query
def char_counts(spark, sf_dir):
    return X.count_by_key(X.characters(V.documents(spark, sf_dir)), "c")


# Messages


@query
def text_lines(spark, sf_dir):
    """Lines of text files without the empty ones; the files are written first."""
    folder = shared_folder(spark, "lines")
    V.tweet_lines(spark, sf_dir).write.text(folder)
    return X.nonempty_lines(spark.read.text(folder))


@query
def nonempty_lines(spark, sf_dir):
    return X.nonempty_lines(V.tweet_lines(spark, sf_dir))


@query
def tweet_fields(spark, sf_dir):
    fields = TW.tweet_fields(nonempty_lines(spark, sf_dir))
    return fields.withColumn("hashtags", F.array_join("hashtags.text", " "))


@query
def tweet_text(spark, sf_dir):
    return TW.tweet_text(nonempty_lines(spark, sf_dir))


@query
def tweet_to_json(spark, sf_dir):
    """Whole messages of varied shape, printed; ``broken`` has the lines that are none."""
    read = TW.documents(X.nonempty_lines(V.message_lines(spark, sf_dir)))
    return read.select(TW.pretty_json(F.col("doc")).alias("json"), "broken")


@query
def tweet_tokens(spark, sf_dir):
    return TW.tweet_tokens(tweet_text(spark, sf_dir))


@query
def page_tokens(spark, sf_dir):
    """Tokens of raw pages: tags, character references, addresses."""
    pages = V.spread(V.table(spark, sf_dir, "pages")).select("page_id", F.col("html").alias("text"))
    return TW.tweet_tokens(pages, ["page_id"])


@query
def first_tokens(spark, sf_dir):
    return TW.first_tokens(V.documents(spark, sf_dir), 10, "doc_id")


def _long_tokens(spark, sf_dir):
    return X.longer_than(tweet_tokens(spark, sf_dir), 2, "tok")


@query
def tokens_by_freq_top15(spark, sf_dir):
    return X.top(X.count_by_key(_long_tokens(spark, sf_dir), "tok"), 15, "n", "tok")


@query
def frequent_tokens(spark, sf_dir):
    """As ``tokens_by_freq_top15``, counting candidates only."""
    return X.frequent(_long_tokens(spark, sf_dir), "tok", 15)


@query
def tokens_by_length_top10(spark, sf_dir):
    sized = _long_tokens(spark, sf_dir).withColumn("n", text_length(F.col("tok")))
    return X.top(sized, 10, "n", "tok")


@query
def event_props(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", "props")
    return TW.json_numbers(events, "props", "k")


# User functions


@query
def user_map_plural(spark, sf_dir):
    return U.map_column(words_flat(spark, sf_dir), "w", lambda w: w + "s", "plural", "string")


@query
def user_filter_longer(spark, sf_dir):
    return U.filter_rows(words_flat(spark, sf_dir), "w", lambda w: len(w) > 3)


@query
def user_flat_map_words(spark, sf_dir):
    return U.flat_map(_sentences(spark, sf_dir), "text", str.split, "w", "string")


@query
def user_reduce_sum(spark, sf_dir):
    pairs = _words(spark, sf_dir).withColumn("n", F.lit(1).cast("bigint"))
    return U.reduce_rows(pairs, "w", "n", lambda a, b: a + b, "bigint")
