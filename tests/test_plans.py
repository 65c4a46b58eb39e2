"""The plans Spark makes: what is read, moved and computed where."""

import re

import pytest

from scenetext.operators import raster as R
from scenetext.operators import text as X
from scenetext.plans.registry import QUERIES
from scenetext.sources import rasters as S
from scenetext.sources import tables as V


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning)\(([^)]*)\)", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_and_no_row_at_a_time_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition"):
        allowed = bad == "SinglePartition" and name == "word_total"  # one number in the end
        assert bad not in text or allowed, text


def test_composite_is_one_shuffle_of_hash_aggregates(spark, sf_dir):
    text = plan(QUERIES["rgb_composite"](spark, sf_dir))
    assert len(shuffles(text)) == 1 and text.count("HashAggregate") == 2
    assert "SortAggregate" not in text
    read = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "l_tax" not in read and "l_shipdate" not in read


def test_several_order_columns_still_make_one_shuffle(spark, sf_dir):
    px = V.pixels(spark, sf_dir)
    text = plan(R.rgb_composite(px, ["src", "dn"]))
    assert len(shuffles(text)) == 1 and "SortAggregate" in text


def test_stretch_broadcasts_bounds_and_leaves_pixels_in_place(spark, sf_dir):
    px = V.pixels(spark, sf_dir)
    text = plan(R.percentile_stretch(px))
    main = text.split("InMemoryTableScan")[0]
    assert "BroadcastHashJoin" in main and not shuffles(main)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = plan(R.percentile_stretch(px, limit=-1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in salted and "_salt" in salted


def test_word_count_combines_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["word_count"](spark, sf_dir))
    assert len(shuffles(text)) == 1 and text.count("HashAggregate") == 2
    assert "Python" not in text and "ReadSchema: struct<text:string>" in text


@pytest.mark.parametrize("name", ["top_words", "tokens_by_freq_top15", "tokens_by_length_top10"])
def test_rankings_are_heaps(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_first_words_splits_only_the_first_texts(spark, sf_dir):
    text = plan(QUERIES["first_words"](spark, sf_dir))
    generate, inner = text.index("Generate"), text.rindex("TakeOrderedAndProject")
    assert generate < inner


def test_only_the_wanted_json_field_is_parsed(spark, sf_dir):
    text = plan(QUERIES["tweet_text"](spark, sf_dir))
    assert "from_json(StructField(text,StringType,true), " in text


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "S1").mkdir()
    (tmp_path / "S1" / "S1_B2.TIF").write_bytes(b"x")
    text = plan(S.scene_catalog(S.raster_files(spark, str(tmp_path)).select("path", "length")))
    assert "ReadSchema: struct<path:string,length:bigint>" in text


def test_line_filter_sits_on_the_scan(spark, tmp_path):
    (tmp_path / "t.json").write_text("a\n\n")
    text = plan(X.nonempty_lines(spark.read.text(str(tmp_path / "t.json"))))
    assert "PushedFilters: [IsNotNull(value)]" in text


def test_small_tables_are_spread_and_large_ones_are_not(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    assert "RoundRobinPartitioning" in plan(V.spread(docs))
    # one file, but planned as many tasks: left to the reader
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert "Exchange" not in plan(V.spread(V.table(spark, sf_dir, "documents")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tile_form_work_needs_no_shuffle(spark, sf_dir):
    for name in ("tile_clamp_normalize", "scan_rasters", "raster_info"):
        assert not shuffles(plan(QUERIES[name](spark, sf_dir)))


def test_user_functions_get_one_column(spark, sf_dir):
    text = plan(QUERIES["user_map_plural"](spark, sf_dir))
    sent = re.findall(r"ArrowEvalPython \[<?lambda>?.*?\((\w+)#\d+\)|ArrowEvalPython \[\w+\((\w+)#\d+\)", text)
    assert sent == [("", "w")] and "MapInArrow" not in text
    # pruning goes through: without the new column nothing runs in Python
    assert "Python" not in plan(QUERIES["user_map_plural"](spark, sf_dir).select("conv_id", "w"))
