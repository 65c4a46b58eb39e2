"""User functions and derived tables on NULL keys and integers beyond 2^53."""

import pytest

from scenetext.operators import raster as R
from scenetext.operators import rows as U
from scenetext.plans.sizing import attach, sized

BIG = 9007199254740993


def test_user_functions_keep_values(spark, rows):
    df = spark.createDataFrame([(BIG, "a b"), (None, "c"), (BIG + 2, "a")], "id long, t string")
    assert rows(U.filter_rows(df, "t", lambda t: "a" in t)) == [(BIG, "a b"), (BIG + 2, "a")]
    assert (BIG, "b") in rows(U.flat_map(df, "t", str.split, "w", "string"))
    got = rows(U.map_column(df, "id", lambda v: None if v is None else v + 1, "next", "bigint"), "id", "next")
    assert got == sorted([(BIG, BIG + 1), (None, None), (BIG + 2, BIG + 3)], key=repr)


def test_reduce_keeps_keys_apart_and_null_as_one(spark, rows):
    data = [(BIG - 1, 1), (BIG, 2), (BIG, BIG), (None, 5), (None, 6), (BIG - 1, None), (7, None)]
    df = spark.createDataFrame(data, "k long, v long").repartition(3)
    got = rows(U.reduce_rows(df, "k", "v", lambda a, b: a + b, "bigint"))
    assert got == sorted([(BIG - 1, 1), (BIG, BIG + 2), (None, 11), (7, None)], key=repr)


@pytest.mark.parametrize("limit", [10**9, -1])
def test_attach_keeps_null_keys(spark, rows, limit):
    large = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("b", 4)], "k string, x int")
    small = sized(spark.createDataFrame([(None, 2, "n"), ("a", 1, "y"), ("b", 1, "z")], "k string, n long, v string"))
    got = attach(large, small, ["k"], ["x"], limit)
    assert got.columns == ["k", "x", "v"]
    assert rows(got) == sorted([(None, 1, "n"), (None, 3, "n"), ("a", 2, "y"), ("b", 4, "z")], key=repr)


def test_stretch_keeps_rows_without_scene(spark):
    df = spark.createDataFrame([(None, "B2", 0, 0, 10), (None, "B2", 1, 0, 30), (1, "B2", 0, 0, 5)], "scene_id int, band string, x int, y int, dn int")
    assert R.percentile_stretch(df).count() == 3
