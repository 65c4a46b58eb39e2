"""Sentences packed over ordered rows, against a loop."""

import random
import re

import pytest

from scenetext.operators import sequences as Q


def _plain(rows, most):
    out, by_key = [], {}
    for key, order, text in sorted(rows, key=lambda r: (r[0], r[1])):
        by_key.setdefault(key, []).extend((order, len(s.split())) for s in re.findall(r"[^.!?]+[.!?]*", text or "") if s.split())
    for key, sentences in by_key.items():
        blocks = []
        for order, n in sentences:
            if not blocks or blocks[-1][3] + n > most:
                blocks.append([order, order, 0, 0])
            blocks[-1][1], blocks[-1][2], blocks[-1][3] = order, blocks[-1][2] + 1, blocks[-1][3] + n
        out += [(key, k, *b) for k, b in enumerate(blocks)]
    return sorted(out)


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_blocks(spark, rows, most):
    rng = random.Random(most)
    texts = ["", None, "no end", "One. Two words! Is it three?", "... leading. marks", "w " * 30 + ". " + "v. " * 20]
    data = [(key, turn, rng.choice(texts)) for key in range(20) for turn in rng.sample(range(50), 12)]
    df = spark.createDataFrame(data, "conv LONG, turn LONG, text STRING").repartition(5)
    assert sorted(rows(Q.pack_sentences(df, "conv", "turn", most=most))) == _plain(data, most)


def test_no_rows(spark, rows):
    df = spark.createDataFrame([], "conv LONG, turn LONG, text STRING")
    assert rows(Q.pack_sentences(df, "conv", "turn")) == []
