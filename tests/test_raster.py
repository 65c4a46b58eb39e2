import re

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scenetext.operators import raster as R
from scenetext.operators import tiles as T
from scenetext.sinks import scenes as K
from scenetext.sources import rasters as S
from scenetext.sources import tables as V

PX = "scene_id STRING, band STRING, x INT, y INT, dn INT, src BIGINT"

PIXELS = st.lists(
    st.tuples(
        st.sampled_from(["s", "t"]),
        st.sampled_from(["B2", "B3", "B5", "B9"]),
        st.integers(0, 3),
        st.integers(0, 3),
        st.one_of(st.none(), st.integers(1, 65535)),
    ),
    min_size=1,
    max_size=60,
)

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def merged_by_hand(pixels):
    found = {}
    for scene, band, x, y, dn, src in sorted(pixels, key=lambda p: p[-1]):
        key = (scene, band, x, y)
        if found.setdefault(key, dn) is None:
            found[key] = dn
    return found


def test_first_source_with_data_wins(spark, rows):
    px = spark.createDataFrame(
        [("s", "B2", 0, 0, 9000, 3), ("s", "B2", 0, 0, None, 1), ("s", "B2", 0, 0, 7000, 2),
         ("s", "B2", 1, 0, None, 4)], PX
    )
    want = [("s", "B2", 0, 0, 7000), ("s", "B2", 1, 0, None)]
    assert rows(R.merge_overlaps(px, ["src"])) == want
    assert rows(R.merge_overlaps(px, ["src", "dn"])) == want


def test_missing_band(spark, rows):
    px = spark.createDataFrame([("s", "B2", 0, 0, 4000, 1), ("s", "B5", 0, 0, 15176, 2)], PX)
    assert rows(R.band_stack(px, ["src"])) == [("s", 0, 0, 4000, None, 15176)]
    assert rows(R.band_stack(px, ["src"], complete_only=True)) == []
    assert rows(R.rgb_composite(px, ["src"])) == [("s", 0, 0, 0, 0, 255)]
    other = R.band_stack(px, ["src"], bands=("B5", "B2", "B4"))
    assert rows(other) == [("s", 0, 0, 15176, 4000, None)]


@few
@given(PIXELS)
def test_merge_equals_brute_force_in_any_partitioning(spark, pixels):
    pixels = [(*p, i) for i, p in enumerate(pixels)]
    want = merged_by_hand(pixels)
    random.Random(0).shuffle(pixels)
    for parts in (1, 5):
        px = spark.createDataFrame(pixels, PX).repartition(parts)
        got = {tuple(r)[:4]: r["dn"] for r in R.merge_overlaps(px, ["src"]).collect()}
        assert got == want


@few
@given(PIXELS)
def test_composite_is_bytes_and_whole(spark, pixels):
    px = spark.createDataFrame([(*p, i) for i, p in enumerate(pixels)], PX)
    got = R.rgb_composite(px, ["src"]).collect()
    assert len(got) == len({(p[0], p[2], p[3]) for p in pixels if p[1] != "B9"})
    assert all(0 <= v <= 255 for r in got for v in (r["r"], r["g"], r["b"]))


def test_layout_and_lines(spark, rows):
    px = spark.createDataFrame(
        [("s", "B2", x, y, 10 * x + y, 0) for x, y in ((10, 5), (12, 5), (15, 5), (10, 7))], PX
    ).drop("src")
    meta = R.layer_metadata(px, 4).first()
    assert (meta["cols"], meta["rows"], meta["layout_cols"], meta["layout_rows"], meta["n"]) == (6, 3, 2, 1, 4)
    placed = R.tile_layout(px, 4)
    got = rows(placed, "x", "layout_col", "layout_row", "tile_x", "tile_y", "tile_cols", "tile_rows")
    assert got == [(10, 0, 0, 0, 0, 4, 3), (10, 0, 0, 0, 2, 4, 3), (12, 0, 0, 2, 0, 4, 3), (15, 1, 0, 1, 0, 2, 3)]
    lines = [(r["y"], r["segment"], r["x_from"], r["cells"]) for r in R.stitch_lines(px, 4).collect()]
    assert sorted(lines) == [
        (5, 0, 10, [105, None, 125, None]), (5, 1, 14, [None, 155]), (7, 0, 10, [107, None, None, None])
    ]


@pytest.mark.parametrize("limit", [10**9, -1])
def test_results_do_not_depend_on_the_join(spark, sf_dir, rows, limit):
    px = V.pixels(spark, sf_dir)
    assert rows(R.percentile_stretch(px, limit=limit)) == rows(R.percentile_stretch(px))
    assert rows(R.quantile_colours(px, limit=limit)) == rows(R.quantile_colours(px))
    assert R.tile_layout(px, 16, limit=limit).exceptAll(R.tile_layout(px, 16)).count() == 0


def test_centres_meet_despite_noise(spark, rows):
    px = spark.createDataFrame(
        [("s", "B2", 1.0000001, 2.0, 5, 1), ("s", "B3", 0.9999999, 2.0000004, 6, 2), ("s", "B5", 1.1, 2.0, 7, 3)],
        "scene_id STRING, band STRING, cx DOUBLE, cy DOUBLE, dn INT, src BIGINT",
    )
    assert rows(R.stack_by_center(px, ["src"])) == [
        ("s", 1.0, 2.0, 5, 6, None), ("s", 1.1, 2.0, None, None, 7)
    ]


def test_centres_meet_across_a_rounding_border(spark, rows):
    """1.000005 lies on the border of five decimals: noise rounds it to either side."""
    px = spark.createDataFrame(
        [("s", "B2", 1.0000049, 2.0, 5, 1), ("s", "B3", 1.0000051, 2.0, 6, 2), ("s", "B5", 31.0000049, 2.0, 7, 3), ("t", "B2", 1.0000051, None, 8, 4)],
        "scene_id STRING, band STRING, cx DOUBLE, cy DOUBLE, dn INT, src BIGINT",
    )
    got = rows(R.stack_by_center(px, ["src"]))
    assert got == sorted([("s", 1.0, 2.0, 5, 6, None), ("s", 31.0, 2.0, None, None, 7), ("t", 1.00001, None, 8, None, None)], key=repr)
    plan = R.stack_by_center(px, ["src"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_classes_by_search_equal_classes_by_value(spark, sf_dir, rows):
    px = V.pixels(spark, sf_dir).select("scene_id", "band", "dn")
    for classes in (1, 2, 7, 256, 1000):
        by_value = px.join(R.quantile_breaks(px, classes), ["scene_id", "band", "dn"]).select("scene_id", "band", "dn", "class_id")
        steps = R.class_steps(px, classes)
        assert steps.agg(F.max(F.size("starts"))).first()[0] <= classes
        joined = px.where("dn IS NOT NULL").join(steps, ["scene_id", "band"])
        found = R.with_class(joined, classes).select("scene_id", "band", "dn", "class_id")
        assert rows(found) == rows(by_value)


def test_colours_join_one_row_per_key(spark, sf_dir):
    px = V.pixels(spark, sf_dir).select("scene_id", "band", "x", "y", "dn")
    steps = R.class_steps(px)
    assert steps.count() == steps.select("scene_id", "band").distinct().count() == 12
    plan = R.quantile_colours(px)._jdf.queryExecution().optimizedPlan().toString()
    assert "dn" not in re.search(r"Join Inner, (.*)", plan).group(1)


def test_sketches_keep_their_rank_error(spark):
    values = spark.range(200_000).selectExpr("id % 2 AS scene_id", "'B2' AS band", "id % 7 AS part", "exp((id * 7919 % 200003) / 2e4) AS dn")
    parts = R.percentile_sketches(values, ("scene_id", "band", "part"))
    merged = R.sketch_bounds(R.merge_sketches(parts))
    for r in merged.collect():
        mine = values.where(F.col("scene_id") == r["scene_id"])
        for p, share in ((r["p_low"], 0.02), (r["p_high"], 0.98)):
            assert abs(mine.where(F.col("dn") <= p).count() / r["n"] - share) <= 2 * R.SKETCH_ERROR
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^\]]*dn", plan)  # no histogram: never grouped by value
    nothing = spark.createDataFrame([(1, "B2", -1.0), (1, "B2", None)], "scene_id INT, band STRING, dn DOUBLE")
    assert [tuple(r)[2:] for r in R.sketch_bounds(R.percentile_sketches(nothing)).collect()] == [(0, None, None)]


def test_tile_form_equals_pixel_form(spark, sf_dir, rows):
    tiles = V.tiles(spark, sf_dir)
    pixels = S.raster_pixels(tiles).withColumns(
        {"x": (F.col("x") + F.col("xmin")).cast("int"), "y": (F.col("y") - F.col("ymax")).cast("int")}
    )
    want = rows(R.rgb_composite(pixels, ["source"]), "scene_id", "x", "y", "r", "g", "b")
    got = T.to_pixels(T.composite(tiles, tile=16), 16).fillna(0, ["r", "g", "b"])
    assert rows(got) == want
    low = rows(R.percentile_bounds(pixels))
    assert rows(T.percentile_bounds(tiles)) == low
    assert rows(S.raster_pixels(T.clamp_normalize(tiles)), "source", "x", "y", "dn") == rows(
        R.clamp_normalize(S.raster_pixels(tiles)), "source", "x", "y", "dn"
    )


@pytest.mark.parametrize("limit", [10**9, -1])
def test_crowded_cells_are_split_without_changing_the_result(spark, sf_dir, rows, limit):
    tiles = V.tiles(spark, sf_dir)
    want = rows(T.to_pixels(T.composite(tiles, tile=16), 16))
    split = T.composite(tiles, tile=16, max_pieces=4, limit=limit)
    assert rows(T.to_pixels(split, 16)) == want


def test_hot_cell_with_nodata_and_text_sources(spark):
    """A third of the tiles lie on one grid cell; sources rank as text."""
    rnd = random.Random(3)
    tiles, stacked = [], {}
    for i in range(600):
        place = 0 if i % 3 == 0 else rnd.randrange(1, 12)
        values = [rnd.choice([None, rnd.randrange(4000, 15177)]) for _ in range(4)]
        tiles.append(("s", "B2", f"f{rnd.random():.9f}", place * 2.0, 0.0, place * 2.0 + 2, 2.0, 2, 2, values))
    for _, _, _, xmin, _, _, _, _, _, values in sorted(tiles, key=lambda t: t[2]):
        for i, v in enumerate(values):
            if v is not None:
                stacked.setdefault((int(xmin) + i % 2, i // 2), (v - 4000) * 255 // 11176)
    schema = (
        "scene_id STRING, band STRING, source STRING, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, "
        "ymax DOUBLE, cols INT, rows INT, cells ARRAY<INT>"
    )
    df = spark.createDataFrame(tiles, schema).repartition(7)
    for pieces in (10**6, 20):
        got = T.to_pixels(T.composite(df, tile=2, max_pieces=pieces), 2).collect()
        assert {(r["x"], r["y"]): r["r"] for r in got} == stacked
        assert all(r["g"] is None and r["b"] is None for r in got)


def test_tile_histogram_and_stretch_with_nodata(spark):
    df = spark.createDataFrame(
        [(1, "B2", 1, [0, None, 100, 200]), (1, "B2", 2, [300, 300, None, None])],
        "scene_id INT, band STRING, source INT, cells ARRAY<INT>",
    )
    hist = {r["dn"]: r["n"] for r in T.value_histogram(df).collect()}
    assert hist == {0: 1, None: 3, 100: 1, 200: 1, 300: 2}
    got = T.percentile_stretch(df).orderBy("source").collect()
    assert got[0]["cells"][:2] == [None, None] and got[1]["cells"] == [255, 255, None, None]


def test_tone_on_tiles_equals_pixels(spark):
    df = spark.createDataFrame([([0, 64, None, 255],)], "cells ARRAY<INT>")
    assert T.tone_adjust(df).first()["cells"] == [0, 39, None, 255]


def test_scene_table_replaces_only_written_scenes(spark, tmp_path, rows):
    schema = "scene_id INT, x INT, r INT"
    first = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], schema)
    K.write_scenes(first, str(tmp_path / "out"))
    K.write_scenes(spark.createDataFrame([(2, 5, 5)], schema), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, "scene_id", "x", "r") == [(1, 1, 1), (2, 5, 5)]
