"""Collocations by SON: phrases frequent in a shard are candidates, candidates are counted everywhere.

A phrase with ``support`` occurrences must have its share of them in at least
one shard, where the share of a shard is that of its words. So every shard is
mined completely with its share as support, and what is frequent in none of
them cannot be frequent overall.

Texts become chunks: word codes of one language, small enough for a task. A
shard is a group of tasks and as large as the corpus makes it. Candidates are
found by buckets, the first bits of a hash, length by length: a task sorts the
buckets of its chunks and sends the gaps between them, some two bytes for a
phrase; a part of all buckets is summed up by shard in one group. What reaches a
shard's share, and the support over all shards, are bits of a table of bounded
size. A bucket may hold several phrases, so it lets through a few too many and
never too few. Only candidates are then counted as phrases, by two independent
hashes, 104 bits together: a task sums up what it has and sends one row for each
part of the hashes; one chunk gives the words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from scenetext.llm.common import LONG, batch_rows, kept, text_of
from scenetext.plans.sizing import BROADCAST_BYTES, Sized, attach, measured_bytes

SUPPORT = 100  # occurrences of a phrase, at least
LONGEST = 5  # words of a phrase, at most
TOP = 2000  # phrases reported for a language
SHARDS = 8  # the local support is about SUPPORT / SHARDS
CHUNK_WORDS = 1 << 18  # words of a chunk, about
BATCH_TEXTS, BATCH_CHUNKS = 1000, 4  # handed to Python at a time
HELD = 1 << 20  # places of phrases a task holds before it sums them up (a quarter as many sums, an eighth to add to them)
PARTS_BITS, PART_WORDS = 12, 1 << 20  # of the buckets: number of parts (in bits, at least), and words for a part
TABLE_BITS = 26  # bits of the table of frequent buckets, in bits, at most
SUMS_BITS = 8  # of the counts of candidates: number of parts (in bits, at least)

# The marks that end a piece (with line feed to carriage return), and what separates words.
_MARKS = ".,;:!?\n\v\f\r"
_BREAK = b"\n"
# capital ASCII letters to small ones, marks to a break, tab to blank
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _MARKS.encode(), b"abcdefghijklmnopqrstuvwxyz " + _BREAK * len(_MARKS)
)
_CHUNK = "chunk long, lang string, shard int, n_words long, words array<string>, counts array<int>, codes binary"


def _slices(text: str, size: int) -> Iterator[list[bytes]]:
    """Words of a text with a break after each piece, cut at breaks after about ``size`` bytes."""
    data = text.encode().translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(_BREAK, at + size) + 1 or len(data)
        yield [w for w in data[at:end].replace(_BREAK, b" \n ").split(b" ") if w]
        at = end
    yield [_BREAK]


def _chunk(tokens: list[bytes]) -> tuple[int, list, np.ndarray, bytes]:
    """Number of words, the distinct words, their counts, and a code per token (-1: break)."""
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    counts = np.bincount(codes, minlength=len(words))
    at = words.index(_BREAK)
    codes = np.where(codes == at, -1, codes - (codes > at)).astype("<i4")
    del words[at]
    return int((codes >= 0).sum()), words, np.delete(counts, at), codes.tobytes()


def chunks(docs: DataFrame, n_shards: int = SHARDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs(text, lang)`` as chunks of one language each; a null lang is ``und``.

    A task closes a chunk when it has ``chunk_words`` words, and all chunks
    when they have four times as many together, so memory does not grow with
    the number of languages. A long text is cut between pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        part, made, total = TaskContext.get().partitionId(), 0, 0
        names = [c.split()[0] for c in _CHUNK.split(", ")]

        def close(lang: str) -> pa.RecordBatch:
            nonlocal made, total
            tokens = held.pop(lang)
            total -= len(tokens)
            n, words, counts, codes = _chunk(tokens)
            name = part << 32 | made
            made += 1
            shard = xxhash.xxh64_intdigest(str(part)) % n_shards
            row = [name, lang, shard, n, [w.decode() for w in words], counts, codes]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                for tokens in _slices(text.as_py(), 8 * chunk_words):
                    held.setdefault(lang, []).extend(tokens)
                    total += len(tokens)
                    if len(held[lang]) >= chunk_words:
                        yield close(lang)
                    while total >= 4 * chunk_words:
                        yield close(max(held, key=lambda k: len(held[k])))
        for lang in list(held):
            yield close(lang)

    rows = docs.select(text_of().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, _CHUNK)


# Odd factors of the two hashes.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_NAME_BYTES = 64  # of a row of hashes and count in a list, with its share of the list
_SECOND_BYTES = 5  # of the second hash
_FILTER_BITS = 20  # first bits of a hash by which most places of no known phrase are told


def _hashes(words: list[str], codes: np.ndarray, lang: str, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length k two hashes of the k words from every place on, and whether no break is among them."""
    seed = zlib.crc32(lang.encode())
    own = [
        np.append(np.fromiter((digest(w, seed) for w in words), np.uint64, len(words)), np.uint64(0))[codes]
        for digest in (xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest)
    ]
    inside, value = codes >= 0, own
    for k in range(1, longest + 1):
        if k > 1:
            value = [v[:-1] * factor + w[k - 1 :] for v, factor, w in zip(value, _FACTORS, own, strict=True)]
            inside = inside[:-1] & (codes[k - 1 :] >= 0)
        yield k, value[0], value[1] >> np.uint64(64 - 8 * _SECOND_BYTES), inside


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k] for name in batch.schema.names}
        out = {name: value.as_py() for name, value in row.items() if name not in ("codes", "known")}
        yield out | {"codes": np.frombuffer(row["codes"].as_buffer(), "<i4"), "known": row["known"].values if "known" in row else None}


def _unsigned(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).view(np.uint64)


def _to_bytes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as groups of seven bits, lowest first, the eighth bit set where one follows; and where each starts."""
    sizes = np.ones(len(numbers), np.int64)
    most = int(numbers.max(initial=0))
    for k in range(7, 64, 7):
        if most >> k:
            sizes += numbers >> np.uint64(k) > 0
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > k)
        group = (numbers[more] >> np.uint64(7 * k)).astype(np.uint8) & 127
        out[starts[more] + k] = group | (sizes[more] > k + 1).astype(np.uint8) << 7
    return out, starts


def _from_bytes(data: np.ndarray) -> np.ndarray:
    """What ``_to_bytes`` was given."""
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    sizes = ends - starts + 1
    out = np.zeros(len(ends), np.uint64)
    for k in range(int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > k)
        out[more] |= (data[starts[more] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    return out


def _split(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes cut at the places ``at``, the first 0 and the last their number."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


class _Sizes(NamedTuple):
    """In bits: a bucket, the number of parts of all buckets, the place of a bucket in the table of frequent ones,
    the number of parts of the counts of candidates."""

    bucket: int
    parts: int
    table: int
    sums: int


def _sizes(n_words: int) -> _Sizes:
    """Four buckets or more for each word, so that few phrases share one."""
    bucket, parts = max(24, (4 * n_words).bit_length()), max(PARTS_BITS, (n_words // PART_WORDS).bit_length())
    # a part has whole bytes of the table
    table = min(bucket, max(TABLE_BITS, parts + 3))
    return _Sizes(bucket, parts, table, max(SUMS_BITS, (n_words // PART_WORDS).bit_length() + 1))


def _table(pieces: list[tuple[int, bytes]], sizes: _Sizes) -> np.ndarray:
    """Bits of the frequent buckets, from those of their parts."""
    n = 1 << sizes.table - sizes.parts - 3
    out = np.zeros(n << sizes.parts, np.uint8)
    for part, piece in pieces:
        out[part * n : (part + 1) * n] = np.frombuffer(zlib.decompress(piece), np.uint8)
    return out


def _in_table(table: np.ndarray, first: np.ndarray, sizes: _Sizes) -> np.ndarray:
    at = first >> np.uint64(64 - sizes.table)
    return (table[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def _chunk_counts(rows: DataFrame, length: int, sizes: _Sizes, known: Broadcast | None) -> DataFrame:
    """Buckets of phrases of ``length`` words in the chunks of a task: ``part, shard, support, n`` and, as
    bytes, gaps between the ``n`` buckets of a part and those counts that are not 1.
    With the table of phrases one word shorter, only phrases of which both parts of that length are in it.
    """
    shift = np.uint64(64 - sizes.bucket)
    inner = np.uint64(sizes.bucket - sizes.parts)

    def packed(shard: int, support: int, found: list[np.ndarray]) -> pa.RecordBatch:
        buckets, counts = np.unique(np.concatenate(found), return_counts=True)
        part = (buckets >> inner).astype(np.int64)
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        gaps = np.diff(buckets, prepend=np.uint64(0))
        gaps[begin] = buckets[begin] & np.uint64((1 << int(inner)) - 1)
        several = counts > 1
        data, starts = _to_bytes(gaps << np.uint64(1) | several.astype(np.uint64))
        more, more_starts = _to_bytes(counts[several].astype(np.uint64))
        at = np.append(starts[begin], len(data))
        more_at = np.append(more_starts, len(more))[np.append(0, np.cumsum(several))[np.append(begin, len(several))]]
        n = np.diff(np.append(begin, len(buckets)))
        columns = [part[begin], np.full(len(begin), shard), np.full(len(begin), support), n]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)] + [_split(data, at), _split(more, more_at)]
        return pa.RecordBatch.from_arrays(arrays, ["part", "shard", "support", "n", "gaps", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if known is None else _table(known.value, sizes)
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        many: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for row in _rows_of(batch):
                for k, first, _, inside in _hashes(row["words"], row["codes"], row["lang"], length):
                    if table is not None and k == length - 1:
                        parts = inside.copy()
                        parts[inside] = _in_table(table, first[inside], sizes)
                if table is not None:
                    inside = parts[:-1] & parts[1:] & inside
                key = row["shard"], row["support"]
                held.setdefault(key, []).append(first[inside] >> shift)
                many[key] += len(held[key][-1])
                while many.total() > HELD:
                    key = max(many, key=many.get)
                    del many[key]
                    yield packed(*key, held.pop(key))
        for key in many:
            if many[key]:
                yield packed(*key, held[key])

    return rows.mapInArrow(run, "part int, shard int, support long, n int, gaps binary, counts binary")


def _part_candidates(rows: list[dict], support: int, sizes: _Sizes) -> np.ndarray:
    """Buckets of a part, in it, that reach its share of the support in some shard, and ``support`` in all."""
    n = np.array([r["n"] for r in rows])
    coded = _from_bytes(np.frombuffer(b"".join(r["gaps"] for r in rows), np.uint8))
    gaps = np.cumsum(coded >> np.uint64(1))
    # sums start anew with each row
    begin = np.cumsum(n) - n
    gaps -= np.repeat(np.concatenate([[np.uint64(0)], gaps[begin[1:] - 1]]), n)
    counts = np.ones(len(gaps), np.int64)
    counts[(coded & np.uint64(1)).astype(bool)] = _from_bytes(np.frombuffer(b"".join(r["counts"] for r in rows), np.uint8))
    order = np.lexsort((np.repeat([r["shard"] for r in rows], n), gaps))
    bucket, counts = gaps[order], counts[order]
    shard, share = (np.repeat([r[name] for r in rows], n)[order] for name in ("shard", "support"))
    new = np.append(True, (bucket[1:] != bucket[:-1]) | (shard[1:] != shard[:-1]))
    at = np.flatnonzero(new)
    in_shard, bucket = np.add.reduceat(counts, at), bucket[at]
    # languages that meet in a bucket have the least of their shares
    frequent = in_shard >= np.minimum.reduceat(share, at)
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return bucket[at][np.logical_or.reduceat(frequent, at) & (np.add.reduceat(in_shard, at) >= support)]


def _candidates(local: DataFrame, support: int, sizes: _Sizes) -> list[tuple[int, bytes]]:
    """For each part that has any, the bits of its buckets that are frequent in a shard and have ``support``
    occurrences over all shards. All of it is no larger than a table of ``sizes.table`` bits.

    A part gets the same share of the buckets everywhere, and a task's chunks are summed up before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, part in enumerate(batch.column("part").to_pylist()):
                found = _part_candidates(batch.column("rows")[k].as_py(), support, sizes)
                if len(found):
                    bits = np.zeros(1 << sizes.table - sizes.parts, np.uint8)
                    bits[found >> np.uint64(sizes.bucket - sizes.table)] = 1
                    packed = zlib.compress(np.packbits(bits).tobytes(), 1)
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], ["part", "bits"])

    rows = F.collect_list(F.struct("shard", "support", "n", "gaps", "counts")).alias("rows")
    return [tuple(r) for r in local.repartition("part").groupBy("part").agg(rows).mapInArrow(run, "part int, bits binary").collect()]


class _Sums(NamedTuple):
    """Of phrases: two hashes, a count, and a chunk that holds it."""

    first: np.ndarray
    second: np.ndarray
    n: np.ndarray
    chunk: np.ndarray


def _summed(parts: list[_Sums], spread: bool) -> _Sums:
    """One row for each phrase, in the order of the hashes. Any of its chunks will do: the first one,
    or with ``spread`` one that its hash picks, so that not the first ones name most phrases."""
    first, second, n, chunk = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(first, kind="stable")
    first, second = first[order], second[order]
    same = first[1:] == first[:-1]
    if (second[1:] != second[:-1])[same].any():
        again = np.lexsort((second, first))
        order, first, second = order[again], first[again], second[again]
        same &= second[1:] == second[:-1]
    at = np.flatnonzero(np.append(True, ~same))
    many = np.diff(np.append(at, len(first)))
    first, second = first[at], second[at]
    pick = at + (second % many.astype(np.uint64)).astype(np.int64) if spread else at
    return _Sums(first, second, np.add.reduceat(n[order], at), chunk[order[pick]])


def _sums_packed(sums: _Sums, bits: int) -> pa.RecordBatch:
    """A row for each part of the hashes that has any, told by their first ``bits``."""
    part = (sums.first >> np.uint64(64 - bits)).astype(np.int64)
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(begin, len(part))
    second = np.ascontiguousarray(sums.second.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SECOND_BYTES]).ravel()
    counts, starts = _to_bytes(sums.n.astype(np.uint64))
    # of the chunks those of the part, and which of them it is
    chunks, places = zip(*(np.unique(sums.chunk[a:b], return_inverse=True) for a, b in zip(begin, ends[1:], strict=True)), strict=True)
    which, which_starts = _to_bytes(np.concatenate(places).astype(np.uint64))
    arrays = [
        pa.array(part[begin], pa.int32()),
        _split(sums.first.astype("<u8").view(np.uint8), 8 * ends),
        _split(second, _SECOND_BYTES * ends),
        _split(counts, np.append(starts, len(counts))[ends]),
        _split(which, np.append(which_starts, len(which))[ends]),
        pa.array(chunks, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["part", "first", "second", "counts", "which", "chunks"])


def _sums_unpacked(row: dict) -> _Sums:
    first = np.frombuffer(row["first"], "<u8")
    second = np.zeros((len(first), 8), np.uint8)
    second[:, :_SECOND_BYTES] = np.frombuffer(row["second"], np.uint8).reshape(-1, _SECOND_BYTES)
    n, which = (_from_bytes(np.frombuffer(row[name], np.uint8)).astype(np.int64) for name in ("counts", "which"))
    return _Sums(first, second.view("<u8").ravel(), n, np.array(row["chunks"], np.int64)[which])


def _counted(rows: DataFrame, tables: list[Broadcast], support: int, sizes: _Sizes) -> DataFrame:
    """``h, g, n, chunk`` of the phrases with ``support`` occurrences: two hashes, the count, and a chunk that
    holds it. Only phrases of which the bucket is in the table of their length are counted; a task sums
    up all its chunks before they are shuffled, and a part of the hashes is summed up in one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = [_table(pieces.value, sizes) for pieces in tables]
        held: list[_Sums] = []
        new = 0
        for batch in batches:
            for row in _rows_of(batch):
                for k, first, second, inside in _hashes(row["words"], row["codes"], row["lang"], len(tables) + 1):
                    if k > 1:
                        places = np.flatnonzero(inside)
                        places = places[_in_table(found_in[k - 2], first[places], sizes)]
                        # four numbers for each place, and as many again while they are sorted
                        for i in range(0, len(places), HELD // 16):
                            part = places[i : i + HELD // 16]
                            held.append(_Sums(first[part], second[part], np.ones(len(part), np.int64), np.full(len(part), row["chunk"])))
                            new += len(part)
                            if new > HELD // 8:
                                held, new = [_summed(held, spread=False)], 0
                                if len(held[0].first) > HELD // 4:
                                    yield _sums_packed(held.pop(), sizes.sums)
        if held:
            yield _sums_packed(_summed(held, spread=False), sizes.sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("rows"):
                sums = _summed([_sums_unpacked(row) for row in packed.as_py()], spread=True)
                enough = sums.n >= support
                columns = [sums.first.view(np.int64), sums.second.view(np.int64), sums.n, sums.chunk]
                yield pa.RecordBatch.from_arrays([pa.array(c[enough], pa.int64()) for c in columns], ["h", "g", "n", "chunk"])

    schema = "part int, first binary, second binary, counts binary, which binary, chunks array<long>"
    sums = rows.mapInArrow(run, schema).repartition("part").groupBy("part")
    packed = F.collect_list(F.struct("first", "second", "counts", "which", "chunks")).alias("rows")
    return sums.agg(packed).mapInArrow(total, "h long, g long, n long, chunk long")


def _named(rows: DataFrame, longest: int) -> DataFrame:
    """``lang, phrase, words, n`` of the phrases in ``known`` (hashes and counts), each found in its chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                first, second = (_unsigned(row["known"].field(k)) for k in (0, 1))
                wanted = dict(zip(zip(first.tolist(), second.tolist(), strict=True), row["known"].field(2).to_pylist(), strict=True))
                begins = np.zeros(1 << _FILTER_BITS, bool)
                begins[first >> np.uint64(64 - _FILTER_BITS)] = True
                out = []
                for k, h, g, inside in _hashes(row["words"], row["codes"], row["lang"], longest):
                    places = np.flatnonzero(inside & begins[h >> np.uint64(64 - _FILTER_BITS)]) if k > 1 else np.zeros(0, np.int64)
                    for at in places[np.isin(h[places], first)].tolist():
                        if (n := wanted.pop((int(h[at]), int(g[at])), None)) is not None:
                            out.append((row["lang"], " ".join([row["words"][c] for c in row["codes"][at : at + k]]), k, n))
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "words", "n"])

    return rows.mapInArrow(run, "lang string, phrase string, words int, n long")


def _with(rows: DataFrame, table: DataFrame, weight: str, on: list[str], spread_on: list[str]) -> DataFrame:
    """``rows`` with the columns of a table that has few rows as a rule: broadcast if its measured
    size allows it, else a join that deals out the rows of frequent languages."""
    table = kept(table.withColumn("_weight", F.col(weight)), "phrase-table")
    return attach(rows, Sized(table, "_weight", *measured_bytes(table, "_weight")), on, spread_on, BROADCAST_BYTES)


def _mined(cut: DataFrame, support: int, longest: int) -> DataFrame:
    """``lang, phrase, words, n`` of the frequent phrases of the chunks."""
    shares = cut.groupBy("lang", "shard").agg(F.sum("n_words").alias("n"))
    whole = shares.groupBy("lang").agg(F.sum("n").alias("total"))
    # ceil of the shard's share of the support, in whole numbers
    share = F.expr(f"CAST(({support} * CAST(n AS DECIMAL(20, 0)) + total - 1) DIV total AS BIGINT)")
    shares = shares.join(whole, "lang").where("total > 0").select("lang", "shard", "n", F.greatest(share, F.lit(1)).alias("support"))
    packed = cut.select("chunk", "lang", "shard", "words", "codes")
    rows = _with(packed, shares.withColumnRenamed("n", "_n"), "_n", ["lang", "shard"], ["chunk"]).drop("_n")

    sizes = _sizes(shares.agg(F.sum("n")).first()[0] or 0)
    tables: list[Broadcast] = []
    # length by length: most phrases of frequent pairs have a longer part that is not frequent
    for k in range(2, longest + 1):
        pieces = _candidates(_chunk_counts(rows, k, sizes, tables[-1] if tables else None), support, sizes)
        tables.append(cut.sparkSession.sparkContext.broadcast(pieces))
    # one chunk of those that hold a phrase gives its words
    one = kept(_counted(packed, tables, support, sizes), "phrase-names")
    lists = one.groupBy("chunk").agg(F.collect_list(F.struct("h", "g", "n")).alias("known"))
    small = one.count() * _NAME_BYTES <= BROADCAST_BYTES
    phrases = _named(packed.join(F.broadcast(lists) if small else lists, "chunk"), longest)
    return kept(phrases, "phrases")


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, n_shards: int = SHARDS, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of two to ``longest`` words with ``support``
    occurrences or more, with exact counts, and ``lang, word, n`` of all words.

    Phrases lie within a piece. Null texts have no words, repeated rows count
    again, other columns do not matter, no rows give no phrases.
    """
    spark = docs.sparkSession
    with batch_rows(spark, BATCH_TEXTS):
        cut = kept(chunks(docs, n_shards, chunk_words), "phrase-chunks")
    with batch_rows(spark, BATCH_CHUNKS):
        phrases = _mined(cut, support, longest)
    words = cut.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("word"))
    return phrases, words.agg(F.sum("counts").cast(LONG).alias("n"))


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, **how: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    The score of a cut is floor(1000 * a * n / (l * r)) with the counts of the
    phrase, its parts and all words; the least one counts. A phrase inside a
    longer one that is as frequent is left out. Ties: greater ``a``, then the
    phrase by code points. Arithmetic is in decimals of 38 digits.
    """
    phrases, words = frequent(docs, support, longest, **how)
    # a part is frequent, too, as it occurs wherever the whole does
    words = kept(words, "phrase-words")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    known = phrases.select("lang", F.col("phrase").alias("part"), "n").union(words.where(F.col("n") >= support))
    cut = phrases.withColumn("_w", F.split("phrase", " ")).select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "_w"
    )
    cut = cut.select(
        "lang", "phrase", "a", "k",
        F.concat_ws(" ", F.expr("slice(_w, 1, k)")).alias("left"),
        F.concat_ws(" ", F.expr("slice(_w, k + 1, size(_w))")).alias("right"),
    )
    cut = cut.join(known.withColumnsRenamed({"part": "left", "n": "l"}), ["lang", "left"])
    cut = cut.join(known.withColumnsRenamed({"part": "right", "n": "r"}), ["lang", "right"])
    big = "CAST({} AS DECIMAL(19, 0))"
    score = f"CAST(1000 * {big.format('a')} AS DECIMAL(22, 0)) * {big.format('total')} DIV ({big.format('l')} * {big.format('r')})"
    scored = _with(cut, total, "total", ["lang"], ["phrase"]).withColumn("score", F.expr(score))
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "total")).alias("best"))
    # a longer phrase that is as frequent and holds this one has one as frequent with one word more
    ends = F.array(F.expr("slice(_w, 1, words - 1)"), F.expr("slice(_w, 2, words - 1)"))
    inner = phrases.where("words > 2").withColumn("_w", F.split("phrase", " ")).select("lang", "n", F.explode(ends).alias("_p"))
    inner = inner.groupBy("lang", F.concat_ws(" ", "_p").alias("phrase")).agg(F.max("n").alias("longer"))
    alone = least.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < best.a")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = alone.selectExpr("lang", "phrase", "best.a AS a", "best.l AS l", "best.r AS r", "best.total AS n", "best.score AS score")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast(LONG).alias("rank"), "phrase", "a", "l", "r", "n", "score")
