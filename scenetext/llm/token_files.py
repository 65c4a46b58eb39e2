"""Token ids as wavelet matrices, one file per shard.

File: a header line of JSON (sizes), doc ids (int64) and document lengths
(uint32), both deflated, then per bit plane, highest first, the packed bits and
the number of ones before every block. The matrix gives any token, counts of an
id before a place and places of an id without decoding the rest.
"""

from __future__ import annotations

import json
import os
import string
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from scenetext.llm.common import kept, text_of
from scenetext.sinks.folders import shared_folder
from scenetext.sources.stores import open_store

BLOCK = 512  # bits per rank entry
SHARD_TOKENS = 8_000_000  # a file is closed when it has so many
GATHER = 1 << 16  # words or ids that are put together at a time
CACHE_WORDS = 500_000  # parts of words a worker remembers, from task to task


def _sides(ids: np.ndarray, ones: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Part by part: ids, and the places in the part of zeros and of ones. Places are much faster
    than masks where bits follow no rule, and few at a time."""
    for k in range(0, len(ids), GATHER):
        part = ones[k : k + GATHER]
        yield ids[k : k + GATHER], np.flatnonzero(~part), np.flatnonzero(part)


class WaveletMatrix:
    """Bit planes of a sequence of ids: plane by plane, zeros first then ones, order kept."""

    def __init__(self, planes: list[np.ndarray], ranks: list[np.ndarray], n: int) -> None:
        self.planes, self.ranks, self.n = planes, ranks, n
        self.zeros = [n - self._ones(k, n) for k in range(len(planes))]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ranks = [], []
        ids = ids.astype(np.uint32 if bits > 16 else np.uint16)
        for k in range(bits - 1, -1, -1):
            ones = (ids >> k & 1).astype(bool)
            planes.append(packed := np.packbits(ones))
            filled = np.zeros(-(-len(packed) * 8 // BLOCK) * BLOCK // 8, np.uint8)
            filled[: len(packed)] = packed
            counts = np.bitwise_count(filled.reshape(-1, BLOCK // 8)).sum(1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)]).astype(np.uint32))
            dealt, low, high = np.empty_like(ids), 0, len(ids) - int(np.count_nonzero(ones))
            for part, zero, one in _sides(ids, ones):
                dealt[low : (low := low + len(zero))] = part.take(zero)
                dealt[high : (high := high + len(one))] = part.take(one)
            ids = dealt
        return cls(planes, ranks, len(ids))

    def _ones(self, k: int, i: int) -> int:
        """Ones before place i of plane k."""
        block = i // BLOCK
        at = block * BLOCK // 8
        part = np.unpackbits(self.planes[k][at : at + BLOCK // 8])[: i - block * BLOCK]
        return int(self.ranks[k][block]) + int(part.sum())

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        value = 0
        for k in range(len(self.planes)):
            bit = self._bit(k, i)
            i = self.zeros[k] + self._ones(k, i) if bit else i - self._ones(k, i)
            value = value << 1 | bit
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where ``value`` starts after the last plane, and how far its first i tokens reach."""
        low, high = 0, i
        for k in range(len(self.planes)):
            if value >> (len(self.planes) - 1 - k) & 1:
                low, high = self.zeros[k] + self._ones(k, low), self.zeros[k] + self._ones(k, high)
            else:
                low, high = low - self._ones(k, low), high - self._ones(k, high)
        return low, high

    def rank(self, value: int, i: int) -> int:
        """How often ``value`` occurs before place i."""
        low, high = self._range(value, i)
        return high - low

    def select(self, value: int, j: int) -> int:
        """Place of occurrence j (from 0) of ``value``; -1 if there are fewer."""
        low, high = self._range(value, self.n)
        if not 0 <= j < high - low:
            return -1
        i = low + j
        for k in reversed(range(len(self.planes))):
            one = value >> (len(self.planes) - 1 - k) & 1
            i = self._place(k, i - self.zeros[k], True) if one else self._place(k, i, False)
        return i

    def _place(self, k: int, j: int, one: bool) -> int:
        """Place of one (or zero) number j of plane k."""
        ends = self.ranks[k].astype(np.int64)
        if not one:
            ends = np.arange(len(ends)) * BLOCK - ends
        block = int(np.searchsorted(ends, j, "right")) - 1
        bits = np.unpackbits(self.planes[k][block * BLOCK // 8 : (block + 1) * BLOCK // 8]) == one
        return block * BLOCK + int(np.flatnonzero(bits)[j - int(ends[block])])

    def decode(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first in sequential passes."""
        ids = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for k in reversed(range(len(self.planes))):
            ones = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            before, low, high = np.empty_like(ids), 0, self.zeros[k]
            bit = ids.dtype.type(1 << (len(self.planes) - 1 - k))
            for part, zero, one in _sides(before, ones):
                part[zero] = ids[low : (low := low + len(zero))]
                part[one] = ids[high : (high := high + len(one))] | bit
            ids = before
        return ids


def to_bytes(ids: np.ndarray, doc_ids: list, lengths: list[int], bits: int) -> bytes:
    matrix = WaveletMatrix.build(ids, bits)
    nulls = [k for k, d in enumerate(doc_ids) if d is None]
    docs = zlib.compress(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), 1)
    sizes = zlib.compress(np.array(lengths, "<u4").tobytes(), 1)
    head = {"n": len(ids), "bits": bits, "block": BLOCK, "docs": len(docs), "sizes": len(sizes), "nulls": nulls}
    parts = [json.dumps(head).encode() + b"\n", docs, sizes]
    for plane, rank in zip(matrix.planes, matrix.ranks, strict=True):
        parts += [plane.tobytes(), rank.astype("<u4").tobytes()]
    return b"".join(parts)


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """Matrix, doc ids and document lengths of a file."""
    at = data.index(b"\n") + 1
    head = json.loads(data[:at])
    docs = np.frombuffer(zlib.decompress(data[at : at + head["docs"]]), "<i8").tolist()
    for k in head["nulls"]:
        docs[k] = None
    at += head["docs"]
    sizes = np.frombuffer(zlib.decompress(data[at : at + head["sizes"]]), "<u4")
    at += head["sizes"]
    n_bytes = -(-head["n"] // 8)
    n_ranks = -(-n_bytes * 8 // head["block"]) + 1
    planes, ranks = [], []
    for _ in range(head["bits"]):
        planes.append(np.frombuffer(data, np.uint8, n_bytes, at))
        ranks.append(np.frombuffer(data, "<u4", n_ranks, at + n_bytes))
        at += n_bytes + 4 * n_ranks
    return WaveletMatrix(planes, ranks, head["n"]), docs, sizes


_MARKS = string.punctuation


def _apart(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without the marks at their end, which are encoded on their own, and how many marks each lost.

    The tokenizer cuts between letters and marks, so final marks do not matter
    for the rest; words that may hold a special token stay whole.
    """
    cores = pc.ascii_rtrim(words, characters=_MARKS)
    # only an ASCII letter or digit is sure to end its piece
    sure = pc.and_(pc.match_substring_regex(cores, "[A-Za-z0-9]$"), pc.invert(pc.match_substring(words, "<|")))
    cores = pc.if_else(sure, cores, words)
    lost = pc.subtract(pc.binary_length(words), pc.binary_length(cores))
    return cores, lost.to_numpy(zero_copy_only=False)


# letters that stand for the bytes of a text in such a vocabulary: printable ones for themselves, the rest from 256 on
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _one_piece(part: str) -> str | None:
    """A part that is one piece and not changed by the tokenizer, its bytes as letters: small
    letters of the Latin, Greek or Cyrillic alphabets in composed form. Else None."""
    if part.isascii():
        return part if part.isalpha() and part.islower() else None
    if not part.isalpha():
        return None
    if max(part) < "\u0530" and part == part.lower() and unicodedata.is_normalized("NFC", part):
        return part.encode().decode("latin-1").translate(_LETTERS)
    return None


def _encode_parts(tokenizer: Tokenizer, parts: set[str]) -> dict[str, bytes]:
    """Ids of each part. Small letters go straight to the vocabulary's merges; all else takes the whole way."""
    out, rest, merges = {}, [], tokenizer.model.tokenize
    for p in parts:
        if piece := _one_piece(p):
            out[p] = array("H", [t.id for t in merges(piece)]).tobytes()
        else:
            rest.append(p)
    coded = tokenizer.encode_batch_fast(rest, add_special_tokens=False)
    out.update((p, array("H", c.ids).tobytes()) for p, c in zip(rest, coded, strict=True))
    return out


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The slices ``which`` of ``flat``, one after the other."""
    out = [flat[:0]]
    for k in range(0, len(which), GATHER):
        part = which[k : k + GATHER]
        n = sizes[part]
        ends = np.cumsum(n)
        out.append(flat[np.arange(ends[-1]) + np.repeat(starts[part] - ends + n, n)])
    return np.concatenate(out)


def _known(parts: list[str], tokenizer: Tokenizer, young: dict[str, bytes], old: dict[str, bytes]) -> list[bytes]:
    """Ids of each part; those of the last ``CACHE_WORDS`` or so are remembered, in two halves, so that
    the older half can go without the words that are in use."""
    if len(young) > CACHE_WORDS // 2:
        old.clear()
        old.update(young)
        young.clear()
    found = [young.get(p) for p in parts]
    new = set()
    for p, ids in zip(parts, found, strict=True):
        if ids is None:
            if (ids := old.get(p)) is None:
                new.add(p)
            else:
                young[p] = ids
    young.update(_encode_parts(tokenizer, new))
    return [young[p] if ids is None else ids for p, ids in zip(parts, found, strict=True)]


def encode(texts: list[str], vocabulary: str) -> list[bytes]:
    """Ids of each text as uint16 bytes.

    White space always ends a piece of this kind of tokenizer, so words are
    encoded on their own and remembered. It also makes letters small, so ASCII
    case is dropped first, but in texts that may hold a special token.
    """
    # a module of its own outlives the task: functions of this package travel by value
    encoders = vars(sys.modules.setdefault("_token_files_words", types.ModuleType("_token_files_words")))
    if vocabulary not in encoders:
        encoders[vocabulary] = (Tokenizer.from_file(vocabulary), {}, {})
    # a new array, as the kernel for small letters misreads slices that were cast
    column = pa.array(texts, pa.large_string())
    small = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
    split = pc.ascii_split_whitespace(small)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary
    cores, lost = _apart(words)
    cores = cores.dictionary_encode()
    # parts: the cores, the marks at the ends of words, and nothing for a word without
    parts = cores.dictionary.to_numpy(zero_copy_only=False).tolist()
    marked = np.flatnonzero(lost)
    ends = [w[-n:] for w, n in zip(words.take(pa.array(marked)).to_numpy(zero_copy_only=False), lost[marked].tolist(), strict=True)]
    marks = {m: len(parts) + k for k, m in enumerate(dict.fromkeys(ends))}
    found = _known([*parts, *marks], *encoders[vocabulary]) + [b""]
    flat = np.frombuffer(b"".join(found), "<u2")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
    pairs = np.full((len(words), 2), len(found) - 1)
    pairs[:, 0] = cores.indices.to_numpy()
    pairs[marked, 1] = [marks[m] for m in ends]
    # the ids of the different words, then of all words
    flat = _gathered(flat, np.cumsum(sizes) - sizes, sizes, pairs.reshape(-1))
    sizes = sizes[pairs].sum(1)
    which = coded.indices.to_numpy()
    ids = _gathered(flat, np.cumsum(sizes) - sizes, sizes, which)
    at = np.concatenate([[0], np.cumsum(sizes[which])])
    at = at[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)]
    return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, bits: int = 16, keep: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``docs(doc_id, text)`` in ascending doc_id order (nulls first) and
    returns one row per file: ``part, file, path, n_docs, n_tokens``.

    Rows are dealt by ranges of doc_id, so files in order of (part, file) hold
    the documents in order; a range is one task and closes a file after
    ``SHARD_TOKENS`` ids, so memory is bounded by that and the longest text.
    A file is written under a name of the attempt and renamed, so tasks can be
    repeated. Null texts are empty and still get the end id; repeated doc_ids
    follow one another, in order of their text.
    """
    rows = docs.select("doc_id", text_of().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        out, ids, names, sizes, total = [], [], [], [], 0

        def close() -> None:
            nonlocal total
            path = f"{base}/part-{part:06d}-{len(out):04d}.wm"
            data = to_bytes(np.frombuffer(b"".join(ids), "<u2"), names, sizes, bits)
            with store.open_output_stream(f"{path}.{attempt}") as f:
                f.write(data)
            store.move(f"{path}.{attempt}", path)
            out.append((part, len(out), f"{folder}/{path.rsplit('/', 1)[1]}", len(names), total))
            ids.clear(), names.clear(), sizes.clear()
            total = 0

        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            # at most 1024 texts at a time, so that their words and ids stay few
            coded_all = (c for k in range(0, len(texts), 1024) for c in encode(texts[k : k + 1024], vocabulary))
            for doc_id, coded in zip(batch.column("doc_id").to_pylist(), coded_all, strict=True):
                ids += [coded, end]
                names.append(doc_id)
                sizes.append(len(coded) // 2 + 1)
                total += sizes[-1]
                if total >= SHARD_TOKENS:
                    close()
        if names:
            close()
        kinds = {"part": pa.int32(), "file": pa.int32(), "path": pa.string(), "n_docs": pa.int64(), "n_tokens": pa.int64()}
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(kinds))

    files = rows.mapInArrow(run, "part int, file int, path string, n_docs long, n_tokens long")
    return kept(files, "token-files")


def read(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files that ``write`` made.

    Files are few (one per ``SHARD_TOKENS`` ids), so a running sum over their
    rows gives the ids before each; every file is decoded in its own task.
    """
    before = W.orderBy("part", "file").rowsBetween(W.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, min(files.count(), 10_000))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["_before"].tolist(), strict=True):
                store, inner = open_store(path)
                with store.open_input_file(inner) as f:
                    matrix, doc_ids, sizes = from_bytes(f.read())
                ids = matrix.decode()
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                names = pd.array(doc_ids, dtype="Int64")
                yield pd.DataFrame({"doc_id": names, "start": starts + start, "n_tokens": sizes.astype(np.int64), "ids_crc32": crc})

    placed = files.select("path", "_before").repartition(n, "path")
    return placed.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes all documents to a new shared folder and reads them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read(write(docs, folder, vocabulary or public_tokenizers.path("word_bpe_49k.json"), end_id))
