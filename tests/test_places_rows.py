from functools import reduce

import pytest
from pyspark.sql import functions as F

from scenetext.operators import places as PL
from scenetext.operators import rows as U
from scenetext.operators import text as X
from scenetext.plans import sizing


@pytest.mark.parametrize("limit", [10**9, -1])
def test_points_without_a_usable_place_are_dropped(spark, rows, limit):
    coords = spark.createDataFrame(
        [("A", [12.5, 46.2]), ("C", [12.0, 2.0, 46.2])], "code STRING, coord ARRAY<DOUBLE>"
    )
    points = spark.createDataFrame([("A", 5), ("B", 6), ("C", 7)], "code STRING, value BIGINT")
    got = PL.place_points(points, PL.load_places(coords), limit=limit)
    assert rows(got) == [("A", 12.5, 46.2, 5, "A : 5")]


def test_a_repeated_code_is_one_place(spark, rows):
    coords = spark.createDataFrame([("A", [2.0, 3.0]), ("A", [1.0, 9.0]), ("B", [5.0, 6.0])], "code STRING, coord ARRAY<DOUBLE>")
    points = spark.createDataFrame([("A", 5), ("B", 6)], "code STRING, value BIGINT")
    assert rows(PL.place_points(points, PL.load_places(coords))) == [("A", 1.0, 9.0, 5, "A : 5"), ("B", 5.0, 6.0, 6, "B : 6")]


def test_user_functions_equal_expressions(spark, rows, sf_dir):
    text = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("turn", "text")
    flat = X.words_flat(text).select("turn", "w")
    assert rows(U.flat_map(text, "text", str.split, "w", "string")) == rows(flat)
    assert rows(U.filter_rows(flat, "w", lambda w: len(w) > 3)) == rows(X.longer_than(flat, 3))
    plural = U.map_column(flat, "w", lambda w: w + "s", "plural", "string")
    assert rows(plural) == rows(X.plural(flat))


def test_flat_map_drops_empty_lists(spark, rows):
    df = spark.createDataFrame([(1, " "), (2, "a b")], "id INT, text STRING")
    assert rows(U.flat_map(df, "text", str.split, "w", "string")) == [(2, "a"), (2, "b")]


def test_reduce_rows_with_a_hot_key_and_tiny_buffers(spark, rows, monkeypatch):
    monkeypatch.setattr(U, "COMBINE_KEYS", 5)
    monkeypatch.setattr(U, "OUTPUT_KEYS", 3)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    df = spark.range(5000).select(key.alias("w"), F.col("id").alias("n"))
    got = U.reduce_rows(df, "w", "n", max, "bigint")
    assert rows(got) == rows(df.groupBy("w").agg(F.max("n").alias("n")))
    assert reduce(max, [r["n"] for r in got.collect()]) == 4999


@pytest.fixture
def skewed(spark):
    """A third of all rows under one key, the rest over many."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 2000)
    return spark.range(9000).select(key.alias("k"), F.col("id").alias("x"))


def test_attach_is_the_same_with_and_without_broadcast(spark, rows, skewed):
    small = skewed.groupBy("k").agg(F.max("x").alias("m"), F.count("*").alias("n"))
    plain = sizing.attach(skewed, sizing.sized(small), ["k"], ["x"], 10**9)
    salted = sizing.attach(skewed, sizing.sized(small), ["k"], ["x"], -1)
    assert rows(plain, "k", "x", "m") == rows(salted, "k", "x", "m")
    assert plain.count() == skewed.count() and plain.columns == salted.columns == ["k", "x", "m"]


def test_only_hot_keys_are_copied(spark, skewed):
    small = skewed.groupBy("k").agg(F.count("*").alias("n"))
    salted = sizing.attach(skewed, sizing.sized(small), ["k"], ["x"], -1)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "_salt" in plan
    hot = small.where(F.col("n") * sizing.HOT_SHARE > 9000)
    assert hot.count() < sizing.HOT_SHARE


def test_hot_keys_get_groups_by_their_weight(spark, skewed):
    """The key with a third of all rows gets a third of HOT_SHARE groups, and no group has many more rows than another."""
    small = skewed.groupBy("k").agg(F.count("*").alias("n"))
    spread = sizing.attach(skewed, sizing.sized(small), ["k"], ["x"], -1)
    assert spread.where("k = -1").count() == 3000
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, (" in plan
    groups = skewed.where("k = -1").groupBy(F.pmod(F.xxhash64("x"), F.lit(334))).count().agg(F.max("count")).first()[0]
    assert groups <= 30


def test_measured_bytes_counts_arrays(spark):
    df = spark.createDataFrame([([1, 2, 3], [(1, 2)])], "a array<int>, b array<struct<x:int,y:int>>")
    assert sizing.measured_bytes(df)[0] == 2 * 16 + 3 * 16 + (16 + 2 * 16)


def test_measured_bytes_counts_text(spark):
    df = spark.createDataFrame([("a" * 1000, 1), ("é", 2)], "s STRING, n INT")
    size, total = sizing.measured_bytes(df, "n")
    assert size == 2 * 16 * 2 + 1002 and total == 3
