"""Collocations against counts of all phrases in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenetext.llm import phrases

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain(docs, support, longest, top):
    words, found = {}, {}
    for lang, text in docs:
        n, f = words.setdefault(lang or "und", Counter()), found.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n.update(w)
            f.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        n = sum(words[lang].values())
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in known.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in known.items()
            )
            if not inside:
                cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("n_shards", "chunk_words"), [(8, 1 << 19), (3, 200), (50, 40)])
def test_equals_brute_force(spark, sf_dir, n_shards, chunk_words):
    """However the corpus is cut: one chunk per task, many chunks in few shards, local supports of 1."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 3 = 0")
    docs = [tuple(r) for r in rows.select("lang", "text").collect()]
    wanted = _plain(docs, 6, 5, 150)
    found = _found(phrases.collocations(rows.repartition(7), 6, 5, 150, n_shards=n_shards, chunk_words=chunk_words))
    assert found == wanted
    assert {len(r[2].split()) for r in wanted} >= {2, 3, 4}


def test_phrase_of_one_shard_and_phrase_of_all(spark):
    """Frequent in one shard only, thinly spread over all, and just below the support."""
    rng = random.Random(1)
    noise = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(30)) for _ in range(300)]
    docs = [("a", t) for t in noise] + [("a", "one place only. " * 20)] + [("a", f"{t} every where x{k}") for k, t in enumerate(noise[:20])]
    docs += [("a", "nearly there; " * 19), (None, "und words stay. " * 20), ("b", None), ("b", "")]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(9)
    found = _found(phrases.collocations(df, 20, n_shards=8, chunk_words=100))
    assert found == _plain(docs, 20, 5, 2000)
    assert {"one place only", "every where", "und words stay"} <= {r[2] for r in found}


def test_arithmetic_is_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**13, 2 * 10**13 + 1, 10**13, 10**13 + 1)], "a long, total long, l long, r long")
    a, total, l, r = df.first()
    big = "CAST({} AS DECIMAL(19, 0))"
    score = f"CAST(1000 * {big.format('a')} AS DECIMAL(22, 0)) * {big.format('total')} DIV ({big.format('l')} * {big.format('r')})"
    assert df.selectExpr(f"{score} AS s").first()["s"] == 1000 * a * total // (l * r)


def test_one_hash_may_collide(spark, monkeypatch):
    """The first hash is that of the last word alone: the second one keeps phrases apart."""
    rng = random.Random(2)
    docs = [("a", " ".join(f"w{rng.randint(0, 12)}" for _ in range(40))) for _ in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(phrases, "_FACTORS", phrases._FACTORS * np.array([0, 1], np.uint64))
    assert _found(phrases.collocations(df, 8)) == _plain(docs, 8, 5, 2000)


def test_odd_rows(odd, none, spark):
    odd = odd.withColumn("lang", odd["source"]).selectExpr("*", "1 AS chunk", "2 AS shard", "'p' AS phrase", "'w' AS words", "3 AS n")
    docs = [tuple(r) for r in odd.select("lang", "text").collect()]
    assert _found(phrases.collocations(odd, 2)) == _plain(docs, 2, 5, 2000)
    assert _found(phrases.collocations(none.withColumn("lang", none["source"]))) == []


def test_long_text_is_cut_between_pieces(spark):
    text = "the same three words. " * 60_000 + "no mark " * 20_000
    rows = spark.createDataFrame([("a", text)], "lang string, text string")
    found = _found(phrases.collocations(rows, 100, chunk_words=1000))
    assert found == _plain([("a", text)], 100, 5, 2000)


def test_many_languages_are_closed_in_time(spark):
    docs = [(f"l{k}", "some words of it " * 8) for k in range(200)]
    rows = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    assert phrases.chunks(rows, 4, 100).count() >= 200
    assert _found(phrases.collocations(rows, 5, chunk_words=100)) == _plain(docs, 5, 5, 2000)


def test_longer_phrases_are_counted_only_where_both_their_parts_are_frequent(spark, monkeypatch):
    docs = spark.createDataFrame([("a b. b c. c d", "en")] * 3 + [("a b c d", "en"), ("x y z", "en")] , "text string, lang string")
    made, counts = [], phrases._chunk_counts

    def counted(*args):
        out = counts(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(phrases, "_chunk_counts", counted)
    found, _ = phrases.frequent(docs.coalesce(1), support=3, longest=5)
    assert sorted(r["phrase"] for r in found.collect()) == ["a b", "b c", "c d"]
    # three pairs and x y, y z; two triples of frequent pairs; no triple is frequent, so nothing longer is looked at
    assert made == [5, 2, 0, 0]


def test_numbers_as_bytes():
    numbers = np.array([0, 1, 127, 128, 300, 2**35 + 5, 2**63, 2**64 - 1, 7], np.uint64)
    data, starts = phrases._to_bytes(numbers)
    assert phrases._from_bytes(data).tolist() == numbers.tolist()
    assert starts.tolist() == [0, 1, 2, 3, 5, 7, 13, 23, 33]
    assert len(phrases._from_bytes(phrases._to_bytes(numbers[:0])[0])) == 0


def test_few_bytes_are_shuffled_for_a_phrase(spark, tmp_path):
    """Pairs of words that are hardly ever the same: rows of hashes took 19 bytes for each that is shuffled."""
    n = 400_000
    words = np.random.default_rng(3).integers(0, 3000, n)
    texts = [(" ".join(f"w{w}" for w in words[k : k + 1000]), "a") for k in range(0, n, 1000)]
    docs = spark.createDataFrame(texts, "text string, lang string").coalesce(1)
    with phrases.batch_rows(spark, 4):
        rows = phrases.chunks(docs).withColumn("support", F.lit(13).cast("long"))
        phrases._chunk_counts(rows, 2, phrases._sizes(n), None).repartition(4, "part").write.parquet(f"{tmp_path}/out")
    size = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    assert size < 6 * n, size / n


@pytest.mark.parametrize(("held", "table_bits"), [(500, 27), (1 << 21, 13)])
def test_sums_in_between_and_a_crowded_table_change_nothing(spark, monkeypatch, held, table_bits):
    rng = random.Random(4)
    docs = [(f"l{k % 3}", " ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(60)) + ".") for k in range(200)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "TABLE_BITS", table_bits)
    assert _found(phrases.collocations(df, 7, n_shards=3, chunk_words=300)) == _plain(docs, 7, 5, 2000)


def _made_by_counting(spark, monkeypatch, docs):
    """Phrases found, and rows that the count of candidates sends to be summed up."""
    from pyspark.sql.classic.dataframe import DataFrame

    made, plain = spark.sparkContext.accumulator(0), DataFrame.mapInArrow

    def counting(df, run, *args, **how):
        def counted(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return plain(df, counted if run.__qualname__ == "_counted.<locals>.run" else run, *args, **how)

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, 1 << 20)  # a file of chunks for each task that reads them
    try:
        with monkeypatch.context() as patched:
            patched.setattr(DataFrame, "mapInArrow", counting)
            return phrases.frequent(docs, support=2 * docs.rdd.getNumPartitions())[0].collect(), made.value
    finally:
        spark.conf.set(key, before)


def test_rows_of_counts_grow_with_the_tasks_and_not_with_their_phrases_too(spark, monkeypatch):
    """Five times the tasks and as many times the frequent phrases, each in every task: one row for each was 25 times as many."""

    def docs(n_tasks, n_phrases):
        texts = [(" ".join(f"a{i} b{i}." for i in range(k, k + 100)) + " ", "a") for k in range(0, n_phrases, 100)]
        return spark.createDataFrame(spark.sparkContext.parallelize(texts * 2 * n_tasks, n_tasks), "text string, lang string")

    few, rows = _made_by_counting(spark, monkeypatch, docs(2, 1000))
    many, more = _made_by_counting(spark, monkeypatch, docs(10, 5000))
    assert (len(few), len(many)) == (1000, 5000)
    assert {r["n"] for r in few} == {4} and {r["n"] for r in many} == {20}
    assert more <= 5.5 * rows, (rows, more)


def test_sums_as_bytes():
    first = np.array([5, 5, 2**56, 2**64 - 1], np.uint64)
    second = np.array([1, 2**40 - 1, 7, 0], np.uint64)
    sums = phrases._Sums(first, second, np.array([1, 2**33, 3, 300]), np.array([2**40, -1, 9, 2**40]))
    rows = phrases._sums_packed(sums, 8).to_pylist()
    assert [r["part"] for r in rows] == [0, 1, 255]
    back = phrases._Sums(*(np.concatenate(c) for c in zip(*map(phrases._sums_unpacked, rows), strict=True)))
    assert [c.tolist() for c in back] == [c.tolist() for c in sums]
    twice = phrases._summed([back, sums], spread=True)
    assert twice.n.tolist() == [2, 2**34, 6, 600]
    assert [c.tolist() for c in twice if c is not twice.n] == [c.tolist() for c in sums if c is not sums.n]
