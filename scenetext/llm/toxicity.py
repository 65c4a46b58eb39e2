"""Toxic spans by a linear-chain conditional random field with two tags.

Tokens carry a few features (the word, its first letters). Forward-backward
gives each token's probability of the toxic tag; the sum of the large ones, on
a logistic curve, is the document's score, and runs of likely tokens are the spans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scenetext.llm.common import WORD, text_of

# Bounds of the training sample: labelled documents, taken in order of a hash, and the bytes of one of them.
MAX_TRAIN, MAX_TRAIN_BYTES = 6000, 1 << 16
# Sequences of the training sample are cut after so many tokens.
MAX_SEQUENCE = 256
PREFIXES = (4, 5, 6)
# Words whose features a task remembers, and texts it scores at a time.
CACHE, TEXTS = 50_000, 256
# Numbers in a matrix of padded sequences, in tasks and where the field is fitted.
CELLS, TRAIN_CELLS = 500_000, 250_000

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: str) -> list[str]:
    w = _EDGES.sub("", word.lower())
    return [f"={w}"] + [f"{w[:n]}*" for n in PREFIXES if len(w) > n] if len(w) > 2 else []


class Model(NamedTuple):
    """``weights`` of the known features for the toxic tag, against the other tag;
    ``bias`` of any token; ``trans[a][b]`` log weight of tag b after a; the curve
    that turns summed probabilities into a score."""

    weights: dict[str, float]
    bias: float
    trans: np.ndarray
    slope: float
    centre: float

    def emission(self, word: str) -> float:
        found = [self.weights[f] for f in features(word) if f in self.weights]
        return self.bias + sum(found)

    def score(self, expected: np.ndarray) -> np.ndarray:
        z = self.slope * (np.log(expected + 1e-6) - self.centre)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _recursions(emissions: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token (first axis) and sequence: weight of the toxic tag against the other one from the
    token alone, from all tokens up to it, and from all behind it.

    With two tags the recursions only need the ratio of both tags' sums, so
    nothing can overflow however long a text is.
    """
    with np.errstate(over="ignore"):
        e = np.exp(np.clip(emissions, -30, 30)).T.copy()
    a = np.exp(trans)
    n = len(e)
    forward, back = np.empty_like(e), np.ones_like(e)
    ratio = np.ones(e.shape[1])
    for t in range(n):
        # before the first token both tags weigh the same
        ratio = e[t] * ((ratio * a[1, 1] + a[0, 1]) / (ratio * a[1, 0] + a[0, 0]) if t else 1.0)
        forward[t] = ratio
    ratio = np.ones(e.shape[1])
    for t in range(n - 2, -1, -1):
        after = e[t + 1]
        step = after * ratio
        ratio = np.where(np.isnan(after), 1.0, (a[1, 0] + a[1, 1] * step) / (a[0, 0] + a[0, 1] * step))
        back[t] = ratio
    return e, forward, back


def marginals(emissions: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(toxic tag) per token by forward-backward; rows are sequences, padded with NaN at the end."""
    _, forward, back = _recursions(emissions, trans)
    odds = forward * back
    return (odds / (1 + odds)).T


def pair_marginals(emissions: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(tag a, tag b) of every token and the next one: array [a, b, sequence, token]; NaN in the padding."""
    e, forward, back = _recursions(emissions, trans)
    a = np.exp(trans)
    behind = e[1:] * back[1:]
    out = np.empty((2, 2, *behind.shape))
    for i in (0, 1):
        for j in (0, 1):
            out[i, j] = (forward[:-1] if i else 1.0) * a[i, j] * (behind if j else np.where(np.isnan(behind), np.nan, 1.0))
    return (out / out.sum((0, 1))).transpose(0, 1, 3, 2)


def _blocks(values: list[np.ndarray], cells: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Groups of rows of about equal length as padded matrices of bounded size."""
    order = sorted(range(len(values)), key=lambda i: len(values[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < 512 and (end - at + 1) * len(values[order[end]]) <= cells:
            end += 1
        rows = order[at:end]
        block = np.full((len(rows), max(1, len(values[rows[-1]]))), np.nan)
        for k, i in enumerate(rows):
            block[k, : len(values[i])] = values[i]
        yield rows, block
        at = end


def _coded(texts: Iterable[str], common: dict[str, str]) -> tuple[list[np.ndarray], list[list[str]]]:
    """Words of each text as codes, and the ``common`` features of each code; 0 stands for all words
    without any. So no text and no vocabulary has to be held as a list of words."""
    known: list[list[str]] = [[]]
    codes: dict[bytes, int] = {}
    plain: set[bytes] = set()

    docs = []
    for text in texts:
        words = text.encode().split()
        if len(plain) > CACHE:
            plain.clear()
        for w in set(words) - plain:
            if w in codes:
                continue
            if found := [common[f] for f in features(w.decode("utf-8", "replace")) if f in common]:
                codes[w] = len(known)
                known.append(found)
            else:
                plain.add(w)
        docs.append(np.fromiter((codes.get(w, 0) for w in words), np.int32, len(words)))
    return docs, known


def train(texts: Iterable[str], labels: list[int], rounds: int = 12, rate: float = 0.2) -> Model:
    """Fits the field to labelled documents.

    Tokens get tags first: a feature is toxic when it stands in ``share`` of
    the toxic documents (and ``least``) or more and that is ``times`` its share
    of the others; a token of a toxic document with a toxic feature has the
    toxic tag. Weights start from the odds of the tags; likelihood is then
    climbed with AdaGrad, and the curve fitted on the documents. Equal texts
    count once. Without toxic labels every document scores about 0, with toxic
    ones only about 1.
    """
    least, share, times = 4, 0.02, 12.0
    once = dict(zip(texts, labels, strict=True))
    texts, labels = list(once), list(once.values())
    del once
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        # sums are 0 or tiny, so their logarithms, about -14, all lie far on one side of the centre
        return Model({}, -20.0, np.zeros((2, 2)), 1.0, -50.0 if len(y) and y.max() else 30.0)
    n_toxic, n_clean = y.sum(), len(y) - y.sum()
    # only features common in toxic documents are kept of any word, the rest of the vocabulary has none
    in_toxic: Counter[str] = Counter()
    for text, label in zip(texts, labels, strict=True):
        if label:
            in_toxic.update({f for w in set(text.encode().split()) for f in features(w.decode("utf-8", "replace"))})
    common = {f: f for f, n in in_toxic.items() if n >= max(least, share * n_toxic)}
    docs, known = _coded(texts, common)
    del texts
    in_clean: Counter[str] = Counter()
    for doc, label in zip(docs, labels, strict=True):
        if not label:
            in_clean.update({f for code in np.unique(doc).tolist() for f in known[code]})
    names = sorted(f for f in common if in_toxic[f] / n_toxic >= times * (in_clean[f] + 0.5) / n_clean)
    del in_toxic, in_clean
    number = {f: k for k, f in enumerate(names)}
    ids = [[number[f] for f in fs if f in number] for fs in known]
    has = np.array([bool(found) for found in ids])
    # sequences: tokens as (row, place) with feature numbers, tags
    cut = [d[i : i + MAX_SEQUENCE] for d in docs for i in range(0, len(d), MAX_SEQUENCE)]
    toxic = [label for d, label in zip(docs, labels, strict=True) for _ in range(0, len(d), MAX_SEQUENCE)]
    # sequences without any feature are alike but for their length: one of each length stands for all of them
    marked = [has[d].any() for d in cut]
    bare = Counter(len(d) for d, m in zip(cut, marked, strict=True) if not m)
    plain_rows = [(np.zeros(n, np.int32), 0, many) for n, many in sorted(bare.items())]
    rows_of = [(cut[k], toxic[k], 1) for k in range(len(cut)) if marked[k]] + plain_rows
    blocks = []
    for rows, block in _blocks([np.empty(len(d)) for d, _, _ in rows_of], TRAIN_CELLS):
        at, feature, tags = [], [], np.zeros(block.shape)
        for r, k in enumerate(rows):
            seq, label, _ = rows_of[k]
            for c in np.flatnonzero(has[seq]).tolist():
                found = ids[seq[c]]
                tags[r, c] = label
                at += [r * block.shape[1] + c] * len(found)
                feature += found
        real = np.arange(block.shape[1]) < np.array([len(rows_of[k][0]) for k in rows])[:, None]
        many = np.array([rows_of[k][2] for k in rows], float)[:, None]
        blocks.append((real, np.array(at, int), np.array(feature, int), tags, many))
    tagged, plain, active = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    for _, at, feature, tags, _ in blocks:
        per_token = np.bincount(at, minlength=tags.size)
        tag = tags.ravel()[at]
        tagged += np.bincount(feature, tag, len(names))
        plain += np.bincount(feature, 1 - tag, len(names))
        active += np.bincount(feature, per_token[at], len(names))
    n_tokens = sum(len(d) for d in docs)
    del cut, rows_of, plain_rows
    bias = np.array(np.log((sum(b[3].sum() for b in blocks) + 1) / (n_tokens + 1)))
    # features of one token share its weight
    weights = (np.log((tagged + 0.5) / (plain + 0.5)) - bias) / np.maximum(active / np.maximum(tagged + plain, 1), 1)
    trans = np.zeros((2, 2))
    history = [np.full_like(weights, 1e-3), np.array(1e-3), np.full((2, 2), 1e-3)]
    total = sum((real * many).sum() for real, *_, many in blocks)
    for _ in range(rounds):
        grads = gradient(blocks, weights, float(bias), trans)
        for x, g, h, pull in zip((weights, bias, trans), grads, history, (1e-4, 0.0, 1e-4), strict=True):
            g = g / total * 1000 - pull * x
            h += g * g
            x += rate * g / np.sqrt(h)
    fitted = Model(dict(zip(names, weights.tolist(), strict=True)), float(bias), trans, 1.0, 0.0)
    del blocks
    by_code = np.array([fitted.bias + sum(fitted.weights[f] for f in fs if f in fitted.weights) for fs in known])
    expected = np.zeros(len(docs))
    for rows, coded in _blocks(docs, TRAIN_CELLS):
        real = ~np.isnan(coded)
        coded[real] = by_code[coded[real].astype(int)]
        expected[rows] = _sums(fitted, coded)[1]
    expected = np.log(expected + 1e-6)
    slope, centre = _logistic(expected, y)
    return fitted._replace(slope=slope, centre=centre)


def gradient(blocks: list[tuple], weights: np.ndarray, bias: float, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log-likelihood: observed minus expected counts of features, of toxic tags and of pairs of
    tags. ``blocks`` hold padded sequences: real tokens, places and numbers of features, tags, and
    how many sequences a row stands for."""
    by_weight, by_bias, by_trans = np.zeros(len(weights)), 0.0, np.zeros((2, 2))
    for real, at, feature, tags, many in blocks:
        e = np.full(real.size, bias)
        np.add.at(e, at, weights[feature])
        e = np.where(real, e.reshape(real.shape), np.nan)
        miss = np.where(real, tags - marginals(e, trans), 0.0) * many
        by_weight += np.bincount(feature, miss.ravel()[at], len(weights))
        by_bias += miss.sum()
        both, pairs = real[:, 1:], pair_marginals(e, trans)
        for a in (0, 1):
            for b in (0, 1):
                seen = (tags[:, :-1] == a) & (tags[:, 1:] == b)
                by_trans[a, b] += (np.where(both, seen - pairs[a, b], 0.0) * many).sum()
    return by_weight, np.array(by_bias), by_trans


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and centre of a logistic curve, by Newton steps with a slight pull to 0 on the slope."""
    b = np.zeros(2)
    mid, scale = x.mean(), x.std() or 1.0
    design = np.stack([np.ones_like(x), (x - mid) / scale], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-2])
        b += np.clip(np.linalg.solve(hess, design.T @ (y - p) - np.array([0, 1e-2]) * b), -2, 2)
    slope = max(b[1], 1e-3) / scale
    return float(slope), float(mid - b[0] / slope / 1.0)


def _sums(model: Model, emissions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the words, and for each text the greatest one plus those of all words that are
    more likely toxic than not; rows are texts, padded with NaN at the end."""
    p = marginals(emissions, model.trans)
    return p, np.nanmax(np.nan_to_num(p), 1) + np.where(p >= 0.5, p, 0.0).sum(1)


def expected_toxic(
    model: Model, texts: list[str], cache: dict[bytes, float], spans: bool = False, cells: int = CELLS
) -> tuple[np.ndarray, list[str]]:
    """Toxic tokens per text, and ``start:end`` of likely runs (code points).

    The number is the greatest probability plus those of all tokens that are
    more likely toxic than not, so the many small ones of a long text add nothing.
    ``cache`` remembers emissions of words from call to call.
    """
    values = []
    for text in texts:
        words = text.encode().split()
        got = list(map(cache.get, words))
        if None in got:
            for w in set(w for w, g in zip(words, got, strict=True) if g is None):
                cache[w] = model.emission(w.decode("utf-8", "replace"))
            got = [cache[w] for w in words]
        if len(cache) > CACHE:
            cache.clear()
        values.append(np.array(got) if got else np.array([]))
    out, runs = np.zeros(len(texts)), [""] * len(texts)
    for rows, block in _blocks(values, cells):
        p, sums = _sums(model, block)
        for k, i in enumerate(rows):
            if not len(values[i]):
                continue
            out[i] = sums[k]
            if spans:
                likely = np.flatnonzero(p[k, : len(values[i])] >= 0.5)
                if len(likely):
                    runs[i] = _runs(texts[i], likely)
    return out, runs


_WORD = re.compile(WORD)


def _runs(text: str, likely: np.ndarray) -> str:
    places = [m.span() for m in _WORD.finditer(text)]
    groups = np.split(likely, np.flatnonzero(np.diff(likely) > 1) + 1)
    return ",".join(f"{places[g[0]][0]}:{places[g[-1]][1]}" for g in groups)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Model from at most ``max_train`` labelled documents outside the held-out
    fifth, taken in order of a hash of doc_id, each of ``MAX_TRAIN_BYTES`` bytes at
    most. The sample is picked from the labels alone, so it is small when it
    meets the texts; of a repeated doc_id one text counts, and so no more
    than the sample reaches the driver."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold != 0))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    )
    # at most max_train rows of two numbers
    texts = docs.select("doc_id", text_of().alias("text")).where(F.octet_length("text") <= MAX_TRAIN_BYTES)
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted(rows.select("doc_id", "text", "toxic").collect(), reverse=True)
    classes = [int(r["toxic"]) for r in reversed(rows)]
    # rows go as they are read, so that train() alone holds the texts and can let them go
    return train((rows.pop()["text"] for _ in classes), classes)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` as ``row``, a struct of its ``keep`` columns, with ``score`` (0 to 1) and ``spans``.

    Only the text is an input. Null and empty texts have no tokens and get the
    curve's lowest score. Texts are scored a few at a time in matrices of fixed
    size, so many texts need no more memory than few; one text takes some
    numbers per token. No shuffle.
    """
    # plain values: a class of this package would have to be there on the executors
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, cache = Model(*shared.value), {}
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                expected, spans = expected_toxic(fitted, batch.column("text").to_pylist(), cache, spans=True)
                found = [pa.array(fitted.score(expected), pa.float64()), pa.array(spans, pa.string())]
                # the row stays as it is, in Arrow
                yield pa.RecordBatch.from_arrays([batch.column("row"), *found], ["row", "score", "spans"])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), text_of().alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema["row"]]).add("score", "double").add("spans", "string"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every row of ``docs``."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    scored = score(rows, fit(docs, labels), ("doc_id", "held_out"))
    return scored.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
