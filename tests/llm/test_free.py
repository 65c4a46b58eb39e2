"""Toxicity, token files, near duplicates, repeated text and the pipeline."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from scenetext.llm import near_duplicates, repeated_text, token_files, toxicity
from scenetext.llm.components import components
from scenetext.llm.queries import QUERIES


def test_marginals_equal_sums_over_all_taggings():
    rng = np.random.default_rng(1)
    e, trans = rng.normal(size=5), rng.normal(size=(2, 2))
    weight = {}
    for code in range(32):
        tags = [code >> k & 1 for k in range(5)]
        weight[code] = np.exp(sum(e[k] for k in range(5) if tags[k]) + sum(trans[a, b] for a, b in zip(tags, tags[1:])))
    want = [sum(w for c, w in weight.items() if c >> k & 1) / sum(weight.values()) for k in range(5)]
    padded = np.array([[*e, np.nan], [*e[:1], *[np.nan] * 5]])
    got = toxicity.marginals(padded, trans)
    assert np.allclose(got[0, :5], want) and np.isclose(got[1, 0], 1 / (1 + np.exp(-e[0])))


def _brute(e, trans):
    """Weight of every tagging of a sequence."""
    n = len(e)
    tags = [[code >> k & 1 for k in range(n)] for code in range(2**n)]
    return tags, [np.exp(sum(e[k] for k in range(n) if t[k]) + sum(trans[a, b] for a, b in zip(t, t[1:]))) for t in tags]


def test_pair_marginals_equal_sums_over_all_taggings():
    rng = np.random.default_rng(3)
    e, trans = rng.normal(size=5), rng.normal(size=(2, 2))
    tags, weight = _brute(e, trans)
    padded = np.array([[*e, np.nan, np.nan], [*e[:2], *[np.nan] * 5]])
    got = toxicity.pair_marginals(padded, trans)
    for k in range(4):
        for a in (0, 1):
            for b in (0, 1):
                want = sum(w for t, w in zip(tags, weight) if (t[k], t[k + 1]) == (a, b)) / sum(weight)
                assert np.isclose(got[a, b, 0, k], want)
    assert np.isnan(got[:, :, 1, 1:]).all() and np.isclose(got[:, :, 1, 0].sum(), 1)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    tags = np.array([[0, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    real = np.array([[True] * 5, [True] * 3 + [False] * 2])
    at, feature, many = np.array([1, 2, 2, 5]), np.array([0, 0, 1, 1]), np.array([[1.0], [7.0]])
    x = rng.normal(size=7)

    def likelihood(x):
        total = 0.0
        for r, n in ((0, 5), (1, 3)):
            e = np.full(5, x[2])
            for a, f in zip(at, feature):
                if a // 5 == r:
                    e[a % 5] += x[f]
            every, weight = _brute(e[:n], x[3:].reshape(2, 2))
            total += many[r, 0] * np.log(weight[every.index([int(t) for t in tags[r, :n]])] / sum(weight))
        return total

    w, b, t = toxicity.gradient([(real, at, feature, tags, many)], x[:2], x[2], x[3:].reshape(2, 2))
    found = np.concatenate([w, [b], t.ravel()])
    step = 1e-6
    want = [(likelihood(x + step * d) - likelihood(x - step * d)) / (2 * step) for d in np.eye(7)]
    assert np.allclose(found, want, atol=1e-5)


def test_sequences_without_features_count_as_often_as_they_occur():
    """2,000 clean sequences without a feature: each one more makes toxic tags less likely."""
    toxic = [f"some words {i} vilething" for i in range(20)]
    few = toxicity.train(toxic + [f"n{i} words of it" for i in range(50)], [1] * 20 + [0] * 50)
    many = toxicity.train(toxic + [f"n{i} words of it" for i in range(6000)], [1] * 20 + [0] * 6000)
    assert many.bias < few.bias - 1


def test_training_holds_no_lists_of_words():
    """Texts of many different words: what training takes beside them is a few times their bytes at most."""
    import tracemalloc

    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(2000)] + [f"a bc{i} vilething" for i in range(20)]
    given = sum(map(len, texts))
    labels = [0] * 2000 + [1] * 20
    tracemalloc.start()
    model = toxicity.train(iter(texts), labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights and most < 4.5 * given, most / given


def test_toxicity_beats_the_constant_answer_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in QUERIES["op3_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    hits = sum(labels[r["doc_id"]] and r["predicted"] for r in held)
    toxic, flagged = sum(labels[r["doc_id"]] for r in held), sum(r["predicted"] for r in held)
    right = sum(labels[r["doc_id"]] == r["predicted"] for r in held)
    assert hits >= 0.8 * toxic and hits >= 0.8 * flagged, (hits, toxic, flagged)
    assert right > len(held) - toxic, (right, len(held), toxic)  # more than with 0 for all


def test_toxicity_runs_where_the_package_is_not(spark):
    """What travels to the executors holds no class of this package."""
    import pickle

    model = toxicity.train([f"a bc{i} vilething" for i in range(20)] + [f"de fg{i}" for i in range(20)], [1] * 20 + [0] * 20)
    assert b"scenetext" not in pickle.dumps(tuple(model))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["doc_id"] in labels and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = sum(labels[r["doc_id"]] == r["predicted"] for r in held)
    assert right >= 0.85 * len(held)


def test_toxic_spans(spark):
    bad = [(i, f"quiet words here number{i} vilething more words") for i in range(40)]
    good = [(i, f"quiet words here number{i} some more words") for i in range(100, 160)]
    docs = spark.createDataFrame([*bad, *good, (999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good] + [(None, 1), (999, None)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.judge(docs, labels).collect()}
    assert all(bad[k][1][slice(*map(int, out[k]["spans"].split(":")))] == "vilething" and out[k]["predicted"] for k in range(40))
    assert not any(out[i]["predicted"] for i, _ in good) and out[999]["predicted"] == 0


def test_wavelet_matrix_operations():
    ids = np.random.default_rng(2).integers(0, 50, 3000)
    m, docs, sizes = token_files.from_bytes(token_files.to_bytes(ids, [7, None], [1000, 2000], 16))
    assert docs == [7, None] and list(sizes) == [1000, 2000] and (m.decode() == ids).all()
    for i in (0, 1, 511, 512, 2999):
        assert m.access(i) == ids[i]
    for v in (0, 13, 49, 50):
        places = np.flatnonzero(ids == v)
        assert m.rank(v, 1777) == (places < 1777).sum() and m.rank(v, 3000) == len(places)
        assert [m.select(v, j) for j in range(len(places))] == list(places) and m.select(v, len(places)) == -1


def test_token_files_equal_plain_encoding(spark, sf_dir, texts):
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    rows = {r["doc_id"]: r for r in QUERIES["op4_token_files"](spark, sf_dir).collect()}
    for k in sorted(texts):
        ids = [*tokenizer.encode(texts[k], add_special_tokens=False).ids, 2]
        assert (rows[k]["start"], rows[k]["n_tokens"], rows[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_words_encode_as_in_their_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "<|endoftext|>. A<|ENDOFTEXT|>, don't É. e\u0301. x\xa0y. İ. ΑΣ ². ½! '. a'S. ﬁ. <|startoftext|>x 12.5, ---"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_files.encode([text], path)[0], "<u2").tolist() == want


def brute_components(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def shingle_set(text, n=2):
    w = text.encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize("top", [1, 100])
def test_parts_of_unlinked_documents_are_bounded(spark, top):
    rows = [(7, i, 0 if i < top else i, 1) for i in range(200)]
    parts = {}
    for r in near_duplicates._parted(spark.createDataFrame(rows, "key long, id long, component long, one int"), "one", 20).collect():
        parts.setdefault(r["part"], []).append(r["id"])
    assert max(map(len, parts.values())) <= 80  # two blocks of about 20, dealt by hash
    met = {(a, b) for ids in parts.values() for a in ids for b in ids if a < b}
    assert met >= {(a, b) for a in range(200) for b in range(max(a + 1, top), 200)}


@pytest.mark.parametrize("block", [8192, 3])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, texts, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", block * 4096)
    base = [f"w{i}" for i in range(60)]
    many = {10_000 + k: " ".join(base[:k] + ["x"] * (k % 9) + base[k + k % 9 :]) for k in range(50)}
    rows = {k: t for k, t in texts.items() if len(t) < 3000} | many | {20_000: "one", 20_001: "ONE", 20_002: " "}
    want = brute_components({k: shingle_set(t) for k, t in rows.items()})
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in near_duplicates.classes(docs).collect():
        assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
        assert r["n_shingles"] == len(shingle_set(rows[r["doc_id"]]))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 200}


def brute_removed(rows):
    first = {}
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            if k is not None:
                first[b[i : i + 50]] = min(k, first.get(b[i : i + 50], k))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if k is not None and first[b[i : i + 50]] < k:
                gone[i : i + 50] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(2_000_000, 200_000), (3000, 40)])
def test_repeated_text_equals_every_string(spark, monkeypatch, texts, sizes):
    monkeypatch.setattr(repeated_text, "CHUNK_BYTES", sizes[0])
    monkeypatch.setattr(repeated_text, "BLOCK_STRINGS", sizes[1])
    rows = [(k, t) for k, t in texts.items() if len(t) < 4000][:120]
    rows += [(5000 + k, "ab" * 90 + str(k) + "é" * 40) for k in range(5)] + [(None, rows[0][1]), (5000, "ab" * 80), (6000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = sorted((tuple(r[c] for c in columns) for r in repeated_text.remove_repeats(docs).collect()), key=repr)
    assert got == brute_removed(rows)


def test_deep_shallow_orders_long_equal_starts():
    rng = np.random.default_rng(3)
    words = np.zeros((400, 7), np.uint64)
    words[:, 4] = rng.integers(0, 3, 400)
    words[:, 6] = rng.integers(0, 4, 400)
    classes = repeated_text.deep_shallow(words)
    rank = {x: i for i, x in enumerate(sorted(set(map(tuple, words.tolist()))))}
    assert classes.tolist() == [rank[tuple(w)] for w in words.tolist()]


def test_odd_and_empty_input(spark, odd, none):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    for run in (
        lambda d: toxicity.judge(d, labels),
        lambda d: token_files.round_trip(d, vocabulary),
        near_duplicates.classes,
        repeated_text.remove_repeats,
    ):
        rows = run(odd).collect()
        assert len(rows) == odd.count() and {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}
        assert run(none).count() == 0


@pytest.mark.parametrize("kinds", [(), (0,), (1,)])
def test_toxicity_with_one_kind_of_label(spark, tmp_path, kinds):
    docs = spark.createDataFrame([(i, f"some plain words {i}" if i % 7 else None) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i in range(60) for k in kinds], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    toxic = int(kinds == (1,))
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == 60 and all(r["predicted"] == toxic and abs(r["score"] - toxic) < 1e-6 for r in rows)
    assert corpus_pipeline.toxic_text(spark, docs, str(tmp_path)).count() == (0 if toxic else 60)


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
        seen.append((name, {r["doc_id"]: r["text"] for r in docs.collect()}))
    everything = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    clean = {k for k, t in everything.items() if model.score(toxicity.expected_toxic(model, [t], {})[0])[0] < 0.5}
    assert set(seen[0][1]) == clean
    want = brute_components({k: shingle_set(t, 5) for k, t in seen[0][1].items()})
    assert set(seen[1][1]) == {k for k, c in want.items() if k == c}
    assert set(seen[2][1]) <= set(seen[1][1]) and len(seen[2][1]) > 0.8 * len(seen[1][1])
    out = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in out.collect()} <= set(seen[2][1])


def test_token_parts_in_use_are_not_encoded_again(monkeypatch):
    made, parts = [], token_files._encode_parts
    monkeypatch.setattr(token_files, "_encode_parts", lambda tokenizer, new: made.append(set(new)) or parts(tokenizer, new))
    monkeypatch.setattr(token_files, "CACHE_WORDS", 60)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    letters = "abcdefghijklmnopqrstuvwxy"
    for k in letters:  # 25 times 24 other words: more than are remembered
        text = " ".join(["Kept***", "kept", "d'un'", "größe!?", "x<|y>", *(f"zz{k}{j}" for j in letters[:20])])
        ids = np.frombuffer(token_files.encode([text], path)[0], "<u2")
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert all(not {"kept", "***", "d'un"} & new for new in made[1:])
