"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from scenetext.llm import spelling
from scenetext.llm.queries import QUERIES

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _near(words):
    """Words that share a key with one letter left out, or are the key of the other."""
    holes = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            near[w] |= holes[w[:k], w[k + 1 :]] - {w}
            if (shorter := w[:k] + w[k + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def _variants(words):
    near, form = _near(words), {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    wanted = _variants(_words(docs))
    found = _found(QUERIES["op12_spelling_variants"](spark, sf_dir))
    assert found == wanted
    assert sum(r[4] for r in wanted) > 100 and any(r[1] for r in wanted)


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words_equal_brute_force(spark, seed):
    """Few letters, many runs of equal ones: every kind of edit, at either end, in runs and in chains of forms."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randint(7, 10))): 10 ** rng.randint(0, 4) for _ in range(900)}
    words |= {"z" * k: k for k in range(7, 60)}
    listed = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _found(spelling.variants(listed)) == _variants(words)


def test_hot_nodes_take_the_broadcast_way(spark):
    rng = random.Random(3)
    words = {"con" + "".join(rng.choice("abcd") for _ in range(5)) + "tion": 1 for _ in range(900)}
    listed = spark.createDataFrame(list(words.items()), "word string, n long")
    edges = spelling.trie(spelling._sides(listed, 7), 2 * len(words)).where("hot")
    assert {">con", "<noit"} <= {r["node"] for r in edges.collect()}
    assert _found(spelling.variants(listed)) == _variants(words)


def test_odd_rows(odd, none, spark):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    clash = odd.selectExpr("*", "'x' AS word", "'y' AS n", "'z' AS _run")
    assert _found(spelling.group(clash)) == _variants(_words(docs))
    assert _found(spelling.group(none)) == []
    lonely = spark.createDataFrame([("abcdefgh", 5)], "word string, n long")
    assert _found(spelling.variants(lonely)) == [("abcdefgh", None, "abcdefgh", 5, 0, None)]


def test_very_long_words(spark):
    long = "ab" * 1000
    words = {long: 2, long[:800] + "x" + long[801:]: 30, long[:-1]: 3, long[1:]: 300}
    listed = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _found(spelling.variants(listed)) == _variants(words)
