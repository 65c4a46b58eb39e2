"""Every registered query against its SQL text, whole tables."""

import pytest

from scenetext.plans.oracle import ORACLE
from scenetext.plans.registry import QUERIES
from tests.oracle import compare, database


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) > 0


def test_every_query_but_the_png_images_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"render_png"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["scene_id", "x", "y", "r", "g", "b"]
    assert df.count() > 0
    # the training-data queries are added if they are there
    assert set(QUERIES) <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql()) <= set(e.queries())
