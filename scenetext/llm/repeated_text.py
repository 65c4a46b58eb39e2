"""Removal of text that a document with a smaller id already has, byte by byte.

Every string of ``LENGTH`` bytes is one suffix cut at that length; two are the
same if they sort next to each other without a difference. Sorting all of them
in one order is not needed: equal strings have the same anchor (the 16 bytes
with the least hash in them), so strings are grouped by anchor and every group
is sorted by itself, with the deep-shallow method: multikey quicksort on words
of eight bytes to a shallow depth, then blind tries for what still is equal.

Steps, with texts packed into chunks of a few MB in a bucketed table, so that
they never move again:

1. Chunks send the hashes of their anchors, four bytes each, to the owner of
   the hash, and get back one bit: does another document have this anchor?
2. For anchors that repeat, chunks send the distinct stretches around them (all
   strings with that anchor in a row) with the smallest doc_id; the owner sorts
   the strings and answers which of them a smaller document has.
3. Chunks turn the answers into covered bytes.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import text_of

LENGTH, GRAM = 50, 16
GRAMS = LENGTH - GRAM + 1
CHUNK_BYTES = 2_000_000
# Anchor hashes that one owner gets, about.
OWNER_ANCHORS = 50_000
# Strings that are sorted at once, about.
BLOCK_STRINGS = 200_000
# Depth in words of eight bytes to which quicksort goes before blind tries take over.
SHALLOW = 3

_U = np.uint64
_M = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h *= _M[3]
    h ^= h >> _U(29)
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from every place."""
    h, step = data.astype(np.uint64) + _U(1), 1
    for m in _M:
        h = h[:-step] * m + h[step:]
        step *= 2
    return _mixed(h)


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, anchor, hashes``: runs of string starts in one text with the
    same anchor (the leftmost least hash in the string), and all gram hashes."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, np.empty(0, np.uint64)
    h = gram_hashes(data)
    key = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16, GRAMS - 32):
        key = np.minimum(key[:-step], key[step:])
    anchor = (key & _U(0xFFFFFFFF)).astype(np.int64)
    # starts of strings that end in the text they begin in
    valid = np.ones(len(anchor), bool)
    starts = np.concatenate([[0], ends[:-1]])
    for a, b in zip(np.maximum(starts, ends - LENGTH + 1), ends, strict=True):
        valid[a:b] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, h
    cut = np.flatnonzero((np.diff(anchor[at]) != 0) | (np.diff(at) != 1)) + 1
    first, last = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    return first, last, anchor[first], h


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, ends, doc ids and null marks of a chunk."""
    data = np.frombuffer(row.data, np.uint8)
    ids = np.frombuffer(row.ids, np.int64)
    return data, np.cumsum(np.frombuffer(row.sizes, np.int64)), ids, np.frombuffer(row.nulls, bool)


def pack(docs: DataFrame) -> DataFrame:
    """Documents in chunks: ``chunk, data, sizes, ids, nulls``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        texts, ids, size = [], [], 0

        def close() -> pd.DataFrame:
            nulls = np.array([i is pd.NA or i is None for i in ids], bool)
            row = {
                "chunk": part << 32 | n,
                "data": b"".join(texts),
                "sizes": np.array([len(t) for t in texts], np.int64).tobytes(),
                "ids": np.array([0 if z else i for i, z in zip(ids, nulls, strict=True)], np.int64).tobytes(),
                "nulls": nulls.tobytes(),
            }
            return pd.DataFrame([row])

        for batch in batches:
            for i, null, text in zip(batch["id"].tolist(), batch["null"].tolist(), batch["text"], strict=True):
                texts.append(text.encode())
                ids.append(None if null else i)
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield close()
                    texts, ids, size, n = [], [], 0, n + 1
        if texts:
            yield close()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("null"),
        text_of().alias("text"),
    )
    return rows.mapInPandas(run, "chunk long, data binary, sizes binary, ids binary, nulls binary")


class Anchors:
    """The stretches of a chunk in order of their anchor's hash."""

    def __init__(self, row, bits: int) -> None:
        self.data, self.ends, self.ids, self.nulls = unpack(row)
        self.first, self.last, anchor, self.hashes = stretches(self.data, self.ends)
        doc = np.searchsorted(self.ends, self.first, "right")
        real = ~self.nulls[doc] if len(doc) else np.empty(0, bool)
        h = self.hashes[anchor] if len(anchor) else np.empty(0, np.uint64)
        order = np.flatnonzero(real)
        order = order[np.argsort(h[order], kind="stable")]
        self.first, self.last, self.doc, self.h = self.first[order], self.last[order], doc[order], h[order]
        self.rel = anchor[order] - self.first
        self.new = np.ones(len(order), bool)
        self.new[1:] = self.h[1:] != self.h[:-1]
        self.heads = np.flatnonzero(self.new)
        # owners by the high bits of the hash, as places in the distinct hashes
        self.cuts = np.searchsorted(self.h[self.heads] >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))

    def several(self) -> np.ndarray:
        """Per distinct hash: do two documents of this chunk have it?"""
        d = self.ids[self.doc]
        if not len(d):
            return np.empty(0, bool)
        return np.minimum.reduceat(d, self.heads) != np.maximum.reduceat(d, self.heads)


def ask(chunks: DataFrame, bits: int) -> DataFrame:
    """``chunk, owner, flags``: which distinct anchor hashes other documents have, a bit each."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a = Anchors(row, bits)
                low, several = a.h[a.heads].astype(np.uint32), a.several()
                out = [
                    (row.chunk, o, low[s:e].tobytes() + np.packbits(several[s:e]).tobytes(), e - s)
                    for o, (s, e) in enumerate(zip(a.cuts[:-1].tolist(), a.cuts[1:].tolist(), strict=True))
                    if e > s
                ]
                yield pd.DataFrame(out, columns=["chunk", "owner", "body", "n"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        counts = group["n"].tolist()
        low = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(group["body"], counts, strict=True)])
        twice = np.concatenate(
            [np.unpackbits(np.frombuffer(b, np.uint8, offset=4 * n), count=n) for b, n in zip(group["body"], counts, strict=True)]
        ).astype(bool)
        order = np.argsort(low, kind="stable")
        s = low[order]
        same = s[1:] == s[:-1]
        hit = twice[order]
        hit[1:] |= same
        hit[:-1] |= same
        # one chunk with two documents marks the hash for all
        run = np.cumsum(np.concatenate([[0], ~same]))
        marked = np.zeros(int(run[-1]) + 1, bool)
        np.logical_or.at(marked, run[hit], True)
        twice[order] = marked[run]
        ends = np.cumsum(counts)
        flags = [np.packbits(twice[e - n : e]).tobytes() for e, n in zip(ends, counts, strict=True)]
        return pd.DataFrame({"chunk": group["chunk"], "owner": group["owner"], "flags": flags})

    sent = chunks.mapInPandas(send, "chunk long, owner int, body binary, n int")
    return sent.groupBy("owner").applyInPandas(answer, "chunk long, owner int, flags binary")


def deep_shallow(words: np.ndarray) -> np.ndarray:
    """Class numbers of the rows of ``words`` (big-endian, eight bytes each) in sorted order:
    equal rows share a number, and smaller rows have smaller ones."""
    n, width = words.shape
    order, group = np.arange(n), np.zeros(n, np.int64)
    # shallow: multikey quicksort, a word at a time, on groups that are still equal
    for depth in range(min(SHALLOW, width)):
        sizes = np.bincount(group)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
        w = words[order[open_], depth]
        inner = np.lexsort((w, group[open_]))
        order[open_], w = order[open_][inner], w[inner]
        split = np.zeros(n, bool)
        split[1:] = group[1:] != group[:-1]
        step = np.concatenate([[False], w[1:] != w[:-1]])
        split[open_] |= step
        split[0] = False
        group = np.cumsum(split)
    # deep: a blind trie per group, all groups a level at a time. A node only knows the
    # first word in which its rows differ, and rows branch on it; words before are skipped.
    depth = np.full(n, SHALLOW)
    live = np.ones(n, bool)
    while width > SHALLOW:
        sizes = np.bincount(group)
        open_ = np.flatnonzero((sizes[group] > 1) & live)
        if not len(open_):
            break
        starts = np.concatenate([[True], group[open_][1:] != group[open_][:-1]])
        heads = np.flatnonzero(starts)
        lead = order[open_][np.repeat(heads, np.diff(np.concatenate([heads, [len(open_)]])))]
        differ = words[order[open_], SHALLOW:] != words[lead, SHALLOW:]
        where = np.where(differ.any(1), differ.argmax(1), width)
        branch = np.minimum.reduceat(where, heads)
        branch = np.repeat(branch, np.diff(np.concatenate([heads, [len(open_)]])))
        leaf = branch == width
        live[open_[leaf]] = False
        open_, branch = open_[~leaf], branch[~leaf]
        if not len(open_):
            break
        depth[open_] = branch
        w = words[order[open_], SHALLOW + branch]
        inner = np.lexsort((w, group[open_]))
        order[open_], w = order[open_][inner], w[inner]
        split = np.zeros(n, bool)
        split[1:] = group[1:] != group[:-1]
        split[open_] |= np.concatenate([[False], w[1:] != w[:-1]])
        split[0] = False
        group = np.cumsum(split)
    out = np.empty(n, np.int64)
    out[order] = group
    return out


def _least_docs(h: np.ndarray, seg: np.ndarray, size: np.ndarray, doc: np.ndarray, at: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Per stretch (anchor hash, hash, bytes ``data[at : at + size]``, smallest doc) a bit mask of
    its strings that a smaller document has."""
    n = len(h)
    order = np.lexsort((doc, seg, h))
    new_seg = np.ones(n, bool)
    new_seg[1:] = (h[order][1:] != h[order][:-1]) | (seg[order][1:] != seg[order][:-1])
    kind = np.cumsum(new_seg) - 1
    rep = order[new_seg]  # of each distinct stretch, with its smallest doc
    least = doc[rep]
    masks = np.zeros(n, np.uint64)
    full = (_U(1) << (size[order] - LENGTH + 1).astype(np.uint64)) - _U(1)
    masks[order] = np.where(doc[order] > least[kind], full, _U(0))
    # anchors with several distinct stretches: compare string by string
    head = np.ones(len(rep), bool)
    head[1:] = h[rep][1:] != h[rep][:-1]
    anchor = np.cumsum(head) - 1
    mixed = np.flatnonzero(np.bincount(anchor)[anchor] > 1)
    if not len(mixed):
        return masks
    counts = (size[rep[mixed]] - LENGTH + 1).astype(np.int64)
    # blocks of whole anchors, so that memory does not follow the owner's share
    upto = np.cumsum(counts)
    heads = np.flatnonzero(np.concatenate([[True], anchor[mixed][1:] != anchor[mixed][:-1]]))
    block = np.concatenate([[0], upto])[heads] // BLOCK_STRINGS
    cuts = heads[np.concatenate([[True], block[1:] != block[:-1]])].tolist()
    found = np.empty(int(upto[-1]), np.int64)
    views = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    for s, e in zip(cuts, [*cuts[1:], len(mixed)], strict=True):
        owner = np.repeat(mixed[s:e], counts[s:e])
        begin = int(upto[s] - counts[s])
        offset = np.arange(len(owner)) + begin - np.repeat(upto[s:e] - counts[s:e], counts[s:e])
        cells = np.zeros((len(owner), -(-LENGTH // 8) * 8), np.uint8)
        cells[:, :LENGTH] = views[at[rep[owner]] + offset]
        classes = deep_shallow(cells.view(">u8").astype(np.uint64))
        lowest = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, classes, least[owner])
        found[begin : begin + len(owner)] = lowest[classes]
    # all occurrences of these stretches, not only the one with the smallest doc
    span = np.zeros(len(rep) + 1, np.int64)
    span[mixed + 1] = counts
    begin = np.cumsum(span)
    for_kind = np.zeros(len(rep), bool)
    for_kind[mixed] = True
    rows = np.flatnonzero(for_kind[kind])
    k = kind[rows]
    each = begin[k + 1] - begin[k]
    row = np.repeat(rows, each)
    o = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    smaller = found[np.repeat(begin[k], each) + o] < doc[order[row]]
    value = np.where(smaller, _U(1) << o.astype(np.uint64), _U(0))
    if len(row):
        starts = np.concatenate([[0], np.cumsum(each)[:-1]])
        masks[order[rows]] = np.bitwise_or.reduceat(value, starts)
    return masks


def compare(chunks: DataFrame, flags: DataFrame, bits: int) -> DataFrame:
    """``chunk, owner, body``: masks of distinct stretches by owner, and with owner -1 the places of all stretches sent."""
    per_chunk = flags.groupBy("chunk").agg(F.collect_list(F.struct("owner", "flags")).alias("flags"))
    rows = chunks.join(per_chunk.hint("shuffle_hash"), "chunk")

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a = Anchors(row, bits)
                hit = np.zeros(len(a.heads), bool)
                for f in row.flags:
                    o = f["owner"]
                    s, e = a.cuts[o], a.cuts[o + 1]
                    hit[s:e] = np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=e - s)
                which = np.flatnonzero(hit[np.cumsum(a.new) - 1]) if len(a.heads) else np.empty(0, int)
                first, rel, h, doc = a.first[which], a.rel[which], a.h[which], a.ids[a.doc[which]]
                size = a.last[which] - first + LENGTH
                seg = rel.astype(np.uint64) * _M[0] + size.astype(np.uint64)
                for k in range(-(-(2 * LENGTH) // GRAM)):
                    seg = _mixed(seg) + a.hashes[np.minimum(first + k * GRAM, first + size - GRAM)]
                order = np.lexsort((doc, seg, h))
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (seg[order][1:] != seg[order][:-1])
                number = np.empty(len(order), np.int64)
                number[order] = np.cumsum(new) - 1
                one = order[new]
                out = []
                cuts = np.searchsorted(h[one] >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
                for o in range(1 << bits):
                    part = one[cuts[o] : cuts[o + 1]]
                    if not len(part):
                        continue
                    text = b"".join([a.data[f : f + n].tobytes() for f, n in zip(first[part].tolist(), size[part].tolist(), strict=True)])
                    body = h[part].tobytes() + seg[part].tobytes() + doc[part].tobytes() + size[part].astype(np.uint8).tobytes() + text
                    out.append((row.chunk, o, 1, len(part), zstandard.compress(body, 1)))
                if len(first):
                    by_place = np.argsort(first)
                    body = b"".join(
                        x[by_place].tobytes()
                        for x in (first.astype(np.uint32), number.astype(np.uint32), size.astype(np.uint8))
                    )
                    # places pass through; dealt by a hash of the chunk, whose number is that of a task and a small one
                    dealt = zlib.crc32(int(row.chunk).to_bytes(8, "little")) % (1 << bits)
                    out.append((row.chunk, dealt, 0, len(first), zstandard.compress(body, 1)))
                yield pd.DataFrame(out, columns=["chunk", "owner", "kind", "n", "body"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        places = group[group["kind"] == 0]
        through = pd.DataFrame({"chunk": places["chunk"], "owner": -1, "n": places["n"], "body": places["body"]})
        sent = group[group["kind"] == 1]
        if not len(sent):
            return through
        counts = sent["n"].to_numpy(np.int64)
        bodies = [zstandard.decompress(b) for b in sent["body"]]
        take = lambda kind, width, skip: np.concatenate(
            [np.frombuffer(b, kind, n, skip * n) for b, n in zip(bodies, counts.tolist(), strict=True)]
        )
        h, seg, doc, size = take(np.uint64, 8, 0), take(np.uint64, 8, 8), take(np.int64, 8, 16), take(np.uint8, 1, 24).astype(np.int64)
        data = np.frombuffer(b"".join(b[25 * n :] for b, n in zip(bodies, counts.tolist(), strict=True)), np.uint8)
        masks = _least_docs(h, seg, size, doc, np.cumsum(size) - size, data)
        ends = np.cumsum(counts)
        out = [zstandard.compress(masks[e - n : e].tobytes() + doc[e - n : e].tobytes(), 1) for e, n in zip(ends, counts, strict=True)]
        masked = pd.DataFrame({"chunk": sent["chunk"], "owner": sent["owner"], "n": sent["n"], "body": out})
        return pd.concat([through, masked], ignore_index=True)

    sent = rows.mapInPandas(send, "chunk long, owner int, kind int, n int, body binary")
    return sent.groupBy("owner").applyInPandas(answer, "chunk long, owner int, n int, body binary")


def covered(row) -> np.ndarray:
    """Bytes of a chunk that go, as a boolean per byte."""
    data, ends, ids, _ = unpack(row)
    parts = sorted(row.answers, key=lambda x: x["owner"]) if row.answers is not None else []
    diff = np.zeros(len(data) + 1, np.int32)
    if parts:
        body, n = zstandard.decompress(parts[0]["body"]), parts[0]["n"]
        first = np.frombuffer(body, np.uint32, n).astype(np.int64)
        number = np.frombuffer(body, np.uint32, n, 4 * n)
        size = np.frombuffer(body, np.uint8, n, 8 * n).astype(np.int64)
        bodies = [(zstandard.decompress(p["body"]), p["n"]) for p in parts[1:]]
        masks = np.concatenate([np.frombuffer(b, np.uint64, k) for b, k in bodies])[number]
        least = np.concatenate([np.frombuffer(b, np.int64, k, 8 * k) for b, k in bodies])[number]
        own = ids[np.searchsorted(ends, first, "right")]
        # another document of this chunk with a smaller id has the whole stretch
        whole = own > least
        np.add.at(diff, first[whole], 1)
        np.add.at(diff, (first + size)[whole], -1)
        some = np.flatnonzero(~whole & (masks != 0))
        for o in range(GRAMS):
            at = first[some[(masks[some] >> _U(o) & _U(1)).astype(bool)]] + o
            np.add.at(diff, at, 1)
            np.add.at(diff, at + LENGTH, -1)
    return np.cumsum(diff[:-1]) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every row of ``docs(doc_id, text)``.

    ``spans`` are the removed byte ranges ``start:end``. Texts shorter than
    ``LENGTH`` bytes and null texts lose nothing. A row with a null doc_id has
    no order: it loses nothing and takes nothing. Rows with equal doc_ids do
    not take from each other. Memory is bounded by a chunk (or one longer text)
    and by an owner's share of the anchors; inside a chunk equal stretches are
    sent once, so a passage in a third of all texts is a row per chunk.
    """
    spark = docs.sparkSession
    packed = pack(docs)
    volume = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    name = f"chunks_{uuid.uuid4().hex}"
    buckets = int(min(50_000, max(8, volume // (4 * CHUNK_BYTES))))
    packed.write.bucketBy(buckets, "chunk").option("compression", "zstd").saveAsTable(name)
    chunks = spark.table(name)
    owners = max(256, volume // 17 // OWNER_ANCHORS)
    bits = min(16, int(np.ceil(np.log2(owners))))
    flags = ask(chunks, bits)
    answers = compare(chunks, flags, bits)
    per_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("owner", "n", "body")).alias("answers"))
    rows = chunks.join(per_chunk.hint("shuffle_hash"), "chunk", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                data, ends, ids, nulls = unpack(row)
                gone, out, start = covered(row), [], 0
                for i, null, end in zip(ids.tolist(), nulls.tolist(), ends.tolist(), strict=True):
                    g, part = gone[start:end], data[start:end]
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                    spans = ",".join(f"{a}:{b}" for a, b in edge.reshape(-1, 2).tolist())
                    left = part[~g] if len(edge) else part
                    digest = hashlib.sha256(left.tobytes()).hexdigest()
                    out.append((None if null else i, end - start, int(g.sum()), len(edge) // 2, digest, spans))
                    start = end
                frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
                yield frame.astype({"doc_id": "Int64"})

    return rows.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string")
