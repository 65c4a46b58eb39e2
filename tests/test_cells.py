import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scenetext.functions import cells as C
from scenetext.operators import raster as R
from scenetext.operators import tiles as T

DN = [0, 3999, 4000, 4001, 9588, 15175, 15176, 20000, None]


def column(spark, values, expr, type_="INT"):
    df = spark.createDataFrame(list(enumerate(values)), f"i INT, dn {type_}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("dn"))).collect()]


def test_clamp_normalize(spark):
    assert column(spark, DN, C.clamp_normalize) == [0, 0, 0, 0, 127, 254, 255, 255, None]


def test_clamp_keeps_nodata_and_is_idempotent(spark):
    once = column(spark, DN, C.clamp)
    assert once[-1] is None and min(once[:-1]) == 4000 and max(once[:-1]) == 15176
    assert column(spark, once, C.clamp) == once


def test_normalize_full_int_range_does_not_overflow(spark):
    lo, hi = -(2**31), 2**31 - 1
    got = column(spark, [lo, 0, hi], lambda c: C.normalize(c, lo, hi))
    assert got == [0, 127, 255]


def test_percentile_stretch(spark):
    values = [0, 0, *range(100, 1001, 100)]
    px = spark.createDataFrame(
        [("s", "B2", i, 0, v) for i, v in enumerate(values)], "scene_id STRING, band STRING, x INT, y INT, dn INT"
    )
    bounds = R.percentile_bounds(px).first()
    assert (round(bounds["p_low"], 9), round(bounds["p_high"], 9)) == (118.0, 982.0)
    got = [r["dn"] for r in R.percentile_stretch(px).orderBy("x").collect()]
    assert got == [None, None, 0, 24, 53, 83, 112, 142, 171, 201, 230, 255]


def test_percentile_bounds_equal_numpy(spark):
    values = np.random.default_rng(1).integers(-5, 65535, 999)
    px = spark.createDataFrame(
        [(1, "B2", i, 0, int(v)) for i, v in enumerate(values)], "scene_id INT, band STRING, x INT, y INT, dn INT"
    )
    low, high = np.percentile(values[values > 0], (2, 98))
    got = R.percentile_bounds(px).first()
    assert abs(got["p_low"] - low) < 1e-6 and abs(got["p_high"] - high) < 1e-6


def test_stretch_of_a_flat_band_and_of_a_band_of_fill(spark):
    px = spark.createDataFrame(
        [("flat", "B2", i, 0, 500) for i in range(4)] + [("fill", "B2", i, 0, v) for i, v in enumerate([0, None])],
        "scene_id STRING, band STRING, x INT, y INT, dn INT",
    )
    got = R.percentile_stretch(px).select("scene_id", "dn").collect()
    assert sorted((r[0], r[1]) for r in got if r[0] == "flat") == [("flat", 0)] * 4
    assert [r[1] for r in got if r[0] == "fill"] == [None, None]


def test_tone_table(spark):
    table = C.tone_table()
    assert [table[v] for v in (0, 1, 64, 127, 128, 200, 255)] == [0, 0, 39, 120, 121, 226, 255]
    assert len(table) == 256 and table == sorted(table)
    assert column(spark, [0, 64, 255, None], C.tone_adjust) == [0, 39, 255, None]


def test_pack_rgb(spark):
    df = spark.createDataFrame([(1, 2, 3), (0, 0, 0), (None, 5, None)], "r INT, g INT, b INT")
    got = [r["rgba"] for r in R.rgb_packed(df).collect()]
    assert got == [0x010203FF, 0, 0x000500FF]


def test_quantile_classes(spark):
    px = spark.createDataFrame(
        [(1, "B2", v) for v in range(8)] + [(1, "B2", None)], "scene_id INT, band STRING, dn INT"
    )
    got = [(r["dn"], r["class_id"]) for r in R.quantile_breaks(px, 4).orderBy("dn").collect()]
    assert got == [(0, 0), (1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (7, 3)]


def test_colour_ramp_ends_and_nodata(spark):
    ramp = [r[0] for r in spark.range(0, 256, 255).select(R.colour_ramp(F.col("id"))).orderBy("id").collect()]
    assert ramp == [0xFF0000FF, 0x0000FFFF]
    px = spark.createDataFrame([(1, "B2", 0, 0, 7), (1, "B2", 1, 0, None)], "scene_id INT, band STRING, x INT, y INT, dn INT")
    got = {r["x"]: r["rgba"] for r in R.quantile_colours(px).collect()}
    assert got == {0: 0x0000FFFF, 1: 0xFFFFFFFF}


@given(st.lists(st.integers(-(2**31) + 1, 2**31 - 1), min_size=1, max_size=50))
def test_numpy_form_of_normalize(values):
    got = T._normalized(np.array(values), C.DN_MIN, C.DN_MAX)
    want = [(min(max(v, C.DN_MIN), C.DN_MAX) - C.DN_MIN) * 255 // (C.DN_MAX - C.DN_MIN) for v in values]
    assert got.tolist() == want and 0 <= got.min() and got.max() <= 255
