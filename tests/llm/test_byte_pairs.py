"""Byte-level BPE: against the library on whole texts, and against plain merges written out."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from scenetext.llm import byte_pairs
from scenetext.llm.queries import QUERIES

PATH = public_tokenizers.path(byte_pairs.RANKS)


@pytest.fixture(scope="module")
def encoding():
    return byte_pairs.encoder(PATH)


def _plain(text, ranks):
    """Lowest rank first, leftmost first, match by match."""
    ids = []
    for match in regex.findall(public_tokenizers.PATTERN, text):
        pieces = [bytes([b]) for b in match.encode()]
        while True:
            best = min((ranks.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(pieces, pieces[1:]))) if len(pieces) > 1 else (1 << 40, 0)
            if best[0] == 1 << 40:
                break
            k = best[1]
            pieces[k : k + 2] = [pieces[k] + pieces[k + 1]]
        ids += [ranks[p] for p in pieces]
    return ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ é'sdt7 \n\t  \x1c9ſ中!_"), max_size=60), st.integers(1, 7))
def test_parts_give_the_ids_of_the_whole_text(encoding, text, least):
    assert "".join(byte_pairs.parts(text, least)) == text
    assert byte_pairs.encode_text(encoding, text, least) == encoding.encode_ordinary(text)


def test_long_runs_need_no_deep_stack(encoding):
    for run in (" " * 1_000_000, "\n" * 1_000_000, " \t" * 500_000):
        for text in (run, run + "x", "word" + run + "7 more"):
            ids = byte_pairs.encode_text(encoding, text)
            assert encoding.decode_bytes(ids).decode() == text
    # a short run of the same form has the same ids per match
    assert byte_pairs.encode_text(encoding, "a" + " " * 70_000 + "b") == encoding.encode_ordinary("a" + " " * 70_000 + "b")
    assert encoding.decode_bytes(byte_pairs.encode_text(encoding, "ab" * 1_000_000)) == b"ab" * 1_000_000


def test_query_equals_plain_merges(spark, sf_dir, texts):
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    rows = QUERIES["op13_byte_pairs"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if r["doc_id"] % 4 == 0:  # slow in plain Python
            ids = _plain(text, ranks)
            assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_odd_rows(odd, none, encoding):
    rows = byte_pairs.decode(byte_pairs.encode(odd, PATH), PATH)
    assert rows.columns == ["doc_id", "ids", "decoded"]
    wanted = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=repr)
    found = sorted(((r["doc_id"], bytes(r["decoded"]).decode()) for r in rows.collect()), key=repr)
    assert found == wanted
    for r in rows.collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == encoding.encode_ordinary(bytes(r["decoded"]).decode())
    clash = odd.selectExpr("*", "'x' AS ids", "'y' AS decoded")
    assert byte_pairs.digest(byte_pairs.decode(byte_pairs.encode(clash, PATH), PATH)).count() == odd.count()
    assert byte_pairs.digest(byte_pairs.decode(byte_pairs.encode(none, PATH), PATH)).collect() == []


def test_boundaries_are_few_and_stated():
    assert list(byte_pairs.parts("ab cd  ef", 1)) == ["ab", " cd", " ", " ef"]
    assert list(byte_pairs.parts("abc123abc", 1)) == ["abc", "123", "abc"]
    assert re.sub(r"\s", "", byte_pairs.WHITE) == ""
