"""Byte-level BPE with the tiktoken library and a local rank file: texts to ids and back to bytes."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, text_of

RANKS = "byte_bpe_50k.tiktoken"
PART = 1 << 16  # code points of a text that go through the pattern at a time, at least
FLUSH = 8 << 20  # bytes of results held before they are sent on

# Fixed value: white space as the pattern understands it (Unicode's White_Space).
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Places that no match of the pattern crosses and that change no match before or behind them: where white space
# begins, before the last of several white spaces in front of something else, between an ASCII letter and a digit.
_BOUNDARY = re.compile(
    rf"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[{WHITE}])(?=[{WHITE}][^{WHITE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
)


def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The ranks of a file (a line each: base64 of the bytes, rank) as an encoding without special tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, least: int = PART) -> Iterator[str]:
    """``text`` cut at safe boundaries into parts of ``least`` code points or a little more; much
    longer only where no boundary comes, as in a run of letters or of white space."""
    at = 0
    while len(text) - at > least and (found := _BOUNDARY.search(text, at + least)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encode_text(encoding: tiktoken.Encoding, text: str, least: int = PART) -> list[int]:
    """Ids of a text of any length.

    A run of white space at the end of a part is one match. The pattern would
    need a stack as deep as a long run, so that one goes to the merges directly.
    """
    if len(text) <= least:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in parts(text, least):
        core = part.rstrip(WHITE)
        whole = len(part) - len(core) > least
        ids += encoding.encode_ordinary(core if whole else part)
        if whole:
            ids += encoding._encode_single_piece(part[len(core) :].encode())
    return ids


def _per_row(rows: DataFrame, source: str, added: str, make: Callable[[], Callable[[object], bytes]]) -> DataFrame:
    """``rows`` with a binary column ``added`` that a function made by ``make``, once per task, takes from
    ``source``. Values pass one at a time; beside Spark's batch a task holds ``FLUSH`` bytes and one row."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            first, held, out = 0, 0, []
            for k, value in enumerate(batch.column(source)):
                out.append(convert(value.as_py()))
                held += len(out[-1])
                if held >= FLUSH or k + 1 == batch.num_rows:
                    columns = batch.slice(first, k + 1 - first).columns
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], [*names, added])
                    first, held, out = k + 1, 0, []

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join([*kinds, f"{added} binary"]))


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, ids``, where ids are packed as little-endian unsigned
    32-bit integers. ``path`` is the rank file, at the same place on every machine.

    Only the pattern and the ranks count: text that looks like a special token
    is text. A null text is empty and has no ids; a null doc_id and repeated
    rows stay as they are; other columns are left out; no rows give none.
    Texts are cut at places that no match crosses, so very long ones have the
    ids of the whole text and need no deep stack.
    """

    def make() -> Callable[[str], bytes]:
        encoding = encoder(path, pattern)
        return lambda text: np.array(encode_text(encoding, text), "<u4").tobytes()

    texts = docs.select("doc_id", text_of().alias("text"))
    return _per_row(texts, "text", "ids", make).select("doc_id", "ids")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded(doc_id, ids)`` with the bytes that the ids stand for as ``decoded``. Bytes need not
    be whole characters, so they stay binary. Null ids have no bytes; an id without a rank is an error."""

    def make() -> Callable[[bytes], bytes]:
        encoding = encoder(path)
        return lambda ids: encoding.decode_bytes(np.frombuffer(ids, "<u4").tolist())

    ids = F.coalesce("ids", F.lit(b"")).alias("ids")
    return _per_row(coded.select("doc_id", ids), "ids", "decoded", make)


def digest(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``decode``'s rows."""
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast(LONG).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
