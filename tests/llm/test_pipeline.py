"""Odd documents in every stage of the pipeline: values, not only numbers of rows."""

import pytest

import corpus_pipeline
from tests.llm.conftest import TEXTS

ODD = "score int, spans string, size int, target string, copy int, copies string, _key string, row string, source_size int, `a.b` int"


@pytest.fixture
def folder(spark, tmp_path):
    labels = [(100 + k, 0) for k in range(30)] + [(200 + k, 1) for k in range(30)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    passage = " ".join(f"bench{k}" for k in range(30))
    spark.createDataFrame([(1, passage), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.fixture
def docs(spark):
    rows = [(i, t, lang, source) for i, t, lang, source in TEXTS]
    rows += [(100 + k, " ".join(f"plain{k}x{j}" for j in range(8)), "a", "x") for k in range(30)]
    rows += [(200 + k, " ".join([f"other{k}x{j}" for j in range(8)] + ["vilest vilest vilest"]), "a", "y") for k in range(30)]
    rows += [(300, "one " * 9 + " ".join(f"bench{k}" for k in range(30)), "a", "x")]
    odd = [(7, "keep", k, "me", -k, "as", f"key{k}", "I", k * 2, k * 3) for k in range(len(rows))]
    return spark.createDataFrame([a + b for a, b in zip(rows, odd)], "doc_id long, text string, lang string, source string, " + ODD)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_keep_columns_as_they_are(spark, docs, folder):
    before = _rows(docs)
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, folder)
        assert after.schema.names == docs.columns, name
        by_stage[name] = _rows(after)
    gone = lambda name: sorted({r[0] for r in before if r not in by_stage[name]}, key=repr)
    assert gone("toxicity") == [200 + k for k in range(30)]
    assert gone("near_duplicates") == [4]  # both rows of it are copies of document 1
    assert gone("decontamination") == [300]
    assert set(by_stage["mixing"]) <= set(before)
    words = {r: len((r[1] or "").split()) for r in before}
    assert max(by_stage["mixing"].count(r) for r in before) <= 3 * max(before.count(r) for r in before)
    assert sum(words[r] for r in by_stage["mixing"]) > 0
    # null doc_ids and null texts are there as before
    for name in ("toxicity", "near_duplicates", "decontamination"):
        assert [r for r in by_stage[name] if r[0] is None] == [r for r in before if r[0] is None]
        assert [r for r in by_stage[name] if r[1] is None] == [r for r in before if r[1] is None]


def test_last_stage(spark, docs, folder):
    rows = corpus_pipeline.token_output(spark, docs, folder).collect()
    assert sorted((r["doc_id"] for r in rows), key=repr) == sorted((r["doc_id"] for r in docs.collect()), key=repr)
    empty = [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)]
    assert empty == [1, 1]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, docs, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, docs.limit(0), folder).collect() == []


def test_no_labels_and_no_benchmark(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("toxicity", "decontamination"):
        assert _rows(dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))) == _rows(docs)
