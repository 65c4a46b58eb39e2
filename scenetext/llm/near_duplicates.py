"""Near duplicates by banded MinHash, candidates checked by odd sketches, links confirmed on full sets.

1. Per document: the set of hashed shingles, MinHash samples, one hash per
   band of samples, and the odd sketch: every sample flips one bit of a bitmap,
   so the bitmaps of two documents differ where their samples do, and the number
   of differing bits gives a precise estimate where similarity is high.
2. Equal sets become one node.
3. Nodes of a bucket (equal band hash) are compared with the bucket's smallest
   node and linked if their full sets are similar enough.
4. What is in one component by then needs no more links. Documents of a bucket
   that are close by sketch but in different components form clusters; in a
   cluster every document is compared with those of the other components on
   full sets. So every pair that shares a bucket is connected, far by sketch or
   compared in full, and no pairs of a large group are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import batch_rows, kept, text_of, without
from scenetext.llm.components import components
from scenetext.plans.sizing import BROADCAST_BYTES, measured_bytes

# 32 bands of 4 samples: a pair with similarity 0.8 shares no band with probability 5e-8.
BANDS, PER_BAND = 32, 4
SAMPLES = BANDS * PER_BAND
SKETCH_BITS = 512
# Candidates whose estimate is lower are left out: five standard deviations below 0.8.
LEAST_ESTIMATE = 0.6
# Nodes of one bucket in a block; two blocks are compared in one task.
BLOCK = 8192
# Bytes of full sets in a block; two blocks are compared in one task.
BLOCK_BYTES = 32 * 2**20
CACHE_WORDS = 50_000
BATCH_TEXTS = 1000  # handed to Python at a time

_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_words: dict[bytes, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``n`` words in a row, A-Z in lower case;
    the whole sequence as one if there are fewer words; empty without words."""
    words = text.encode().lower().split()  # for bytes: A-Z only, and exactly the six blanks
    if not words:
        return np.empty(0, np.uint64)
    got = list(map(_words.get, words))
    if None in got:
        if len(_words) > CACHE_WORDS:
            _words.clear()
        for w in set(words).difference(_words):
            _words[w] = xxhash.xxh64_intdigest(w)
        got = [_words[w] for w in words]
    h = np.array(got, np.uint64)
    short = len(h) < n
    m = 1 if short else len(h) - n + 1
    out = np.full(m, len(h) if short else 0, np.uint64)
    for k in range(len(h) if short else n):
        out = out * _STEP + h[k : k + m]
    return np.unique(_mixed(out))


def samples(h: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max)
    for i in range(0, len(h), 512):
        part = h[i : i + 512]
        np.minimum(least, (part[None, :] * _A[:, None] + _B[:, None]).min(1), out=least)
    return least


def odd_sketch(least: np.ndarray) -> bytes:
    bits = np.zeros(SKETCH_BITS, np.uint8)
    at = _mixed(least + np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP) % np.uint64(SKETCH_BITS)
    np.bitwise_xor.at(bits, at.astype(np.int64), 1)
    return np.packbits(bits).tobytes()


def most_bits(estimate: float) -> int:
    """Differing bits up to which the estimated similarity is at least ``estimate``."""
    changed = 2 * SAMPLES * (1 - estimate)
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * changed / SKETCH_BITS)))


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, set (two hashes as text), bands, sketch``; the last three null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(1, BANDS + 1, dtype=np.uint64)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                h = shingles(text.as_py(), n)
                if not len(h):
                    rows.append((0, None, None, None))
                    continue
                least = samples(h)
                keys = band.copy()
                for k in range(PER_BAND):
                    keys = _mixed(keys * _STEP + least[k::PER_BAND])
                rows.append((len(h), xxhash.xxh128_hexdigest(h.tobytes()), keys.view(np.int64), odd_sketch(least)))
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "set", "bands", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set string, bands array<long>, sketch binary")


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``id, h``: shingle hashes of the documents whose id is in ``ids(id)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "h": [shingles(t, n).tobytes() for t in batch["text"]]})

    n_bytes, _ = measured_bytes(ids)
    wanted = F.broadcast(ids) if n_bytes <= BROADCAST_BYTES else ids
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")).join(wanted, "id", "left_semi")
    return rows.mapInPandas(run, "id long, h binary")


def confirm(pairs: DataFrame, docs: DataFrame, n: int, similar: float) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose full sets have at least ``similar`` of their union in common."""
    ids = kept(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    sets = kept(_sets(docs, ids, n), "pair-sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("h").alias("h_a")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("h").alias("h_b")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        percent = round(similar * 100)
        for batch in batches:
            good = []
            for x, y in zip(batch["h_a"], batch["h_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[good, ["a", "b"]]

    return kept(both.mapInPandas(run, "a long, b long"), "edges")


def _by_group(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(group)`` for every (key, part) of ``rows``; many small groups share one call of Python."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None

        def all_of(groups: pd.DataFrame) -> Iterator[pd.DataFrame]:
            keys = groups[["key", "part"]].to_numpy()
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            found = [work(groups.iloc[a:b]) for a, b in zip([0, *edges], [*edges, len(groups)], strict=True) if b - a > 1]
            found = [f for f in found if f is not None]
            if found:
                yield pd.concat(found).drop_duplicates()

        for batch in batches:
            rows_now = batch if left is None else pd.concat([left, batch], ignore_index=True)
            last = rows_now[["key", "part"]].iloc[-1]
            open_ = ((rows_now["key"] == last["key"]) & (rows_now["part"] == last["part"])).to_numpy()
            left = rows_now[open_]
            if not open_.all():
                yield from all_of(rows_now[~open_])
        if left is not None:
            yield from all_of(left)

    return rows.repartition("key", "part").sortWithinPartitions("key", "part").mapInPandas(run, schema)


def _near(bits: np.ndarray, comp: np.ndarray, r: int) -> np.ndarray:
    """Rows of other components whose sketch is close to that of row r."""
    return (np.bitwise_count(bits ^ bits[r]).sum(1) <= most_bits(LEAST_ESTIMATE)) & (comp != comp[r])


def _clusters(g: pd.DataFrame) -> pd.DataFrame | None:
    """Links ``a, b`` that connect, within one group, every row marked ``rest`` with all its near rows: at most one per row."""
    ids, comp = g["id"].to_numpy(), g["component"].to_numpy()
    bits = np.frombuffer(b"".join(g["sketch"]), np.uint64).reshape(len(g), -1)
    label = ids.copy()
    for r in np.flatnonzero(g["rest"].to_numpy()):
        hit = _near(bits, comp, r)
        hit[r] = True
        joined = np.unique(label[hit])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    moved = label != ids
    return pd.DataFrame({"a": label[moved], "b": ids[moved]}) if moved.any() else None


def _links(percent: int):
    """For one part of a cluster: links of rows marked ``rest`` by full sets, one per other component."""

    def work(g: pd.DataFrame) -> pd.DataFrame | None:
        ids, comp = g["id"].to_numpy(), g["component"].to_numpy()
        bits = np.frombuffer(b"".join(g["sketch"]), np.uint64).reshape(len(g), -1)
        sets = [np.frombuffer(h, np.uint64) for h in g["h"]]
        size = np.array([len(h) for h in sets])
        out = []
        for r in np.flatnonzero(g["rest"].to_numpy()):
            near = _near(bits, comp, r)
            near &= (100 * size >= percent * size[r]) & (100 * size[r] >= percent * size)
            done = set()
            for c in np.flatnonzero(near):
                if comp[c] in done:
                    continue
                place = np.searchsorted(sets[r], sets[c])
                place[place == size[r]] = 0
                common = int((sets[r][place] == sets[c]).sum())
                if 100 * common >= percent * (size[r] + size[c] - common):
                    done.add(comp[c])
                    out.append((min(ids[r], ids[c]), max(ids[r], ids[c])))
        return pd.DataFrame(out, columns=["a", "b"]) if out else None

    return work


def _parted(rows: DataFrame, weight: str, block: int) -> DataFrame:
    """``rows(key, id, component, ...)`` of keys with several components, in parts of about two blocks of ``block``
    of ``weight``. Rows of the key's largest component are dealt into blocks, and all others (``rest``) into
    blocks of their own; every pair of blocks with at least one of the latter is a part, so each
    row of ``rest`` meets all rows of the key."""
    per = rows.groupBy("key", "component").agg(F.sum(weight).alias("c"))
    mixed = per.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("size"), F.count("*").alias("k"))
    blocks = lambda c: F.ceil(c / block).cast("long")
    mixed = mixed.where("k > 1").select(
        "key", F.col("top.component").alias("top"),
        blocks(F.col("size") - F.col("top.c")).alias("n_rest"), blocks(F.col("top.c")).alias("n_top"),
    )
    rows = rows.join(mixed, "key").withColumn("rest", F.col("component") != F.col("top"))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    rows = rows.withColumn("own", F.when(F.col("rest"), dealt("n_rest")).otherwise(F.col("n_rest") + dealt("n_top")))
    # blocks of rest come first: parts are (i, j) with i < j and i < n_rest
    own, n = F.col("own"), F.col("n_rest") + F.col("n_top")
    before = F.transform(F.sequence(F.lit(0).cast("long"), F.least(own, F.col("n_rest")) - 1), lambda i: i * n + own)
    after = F.transform(F.sequence(own + 1, n - 1), lambda j: own * n + j)
    none = F.array().cast("array<bigint>")
    parts = F.concat(F.when(own > 0, before).otherwise(none), F.when(F.col("rest"), after).otherwise(none))
    return rows.withColumn("part", F.explode(parts)).drop("top", "n_rest", "n_top", "own", weight)


def classes(docs: DataFrame, n: int = 2, similar: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Rows without words are linked with nothing; rows with a null doc_id neither
    (component null, kept). Rows that share a doc_id count as one document.
    ``kept`` marks the smallest doc_id of each component. Memory is bounded by
    two blocks of a bucket or cluster and by the largest single set; what is shuffled
    grows with the square of the blocks of unlinked documents that are close by sketch.
    """
    with batch_rows(docs.sparkSession, BATCH_TEXTS):
        sig = kept(signatures(docs, n), "signatures")
    full = sig.where("set IS NOT NULL AND doc_id IS NOT NULL")
    nodes = full.groupBy("set").agg(F.min("doc_id").alias("id"))
    nodes = kept(nodes, "nodes")
    own = full.join(nodes.select("set", F.col("id").alias("doc_id")), ["set", "doc_id"], "left_semi")
    own = own.select(F.col("doc_id").alias("id"), "bands", "sketch").dropDuplicates(["id"])
    spread = own.select("id", F.explode("bands").alias("bucket"))
    least = spread.groupBy("bucket").agg(F.min("id").alias("least"), F.count("*").alias("size")).where("size > 1")
    shared = kept(spread.join(least, "bucket"), "buckets")
    sketches = own.select("id", "sketch")
    star = shared.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    star = star.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("s_a")), "a")
    star = star.join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("s_b")), "b")
    star = star.withColumn("bits", differing("s_a", "s_b")).where(F.col("bits") <= most_bits(LEAST_ESTIMATE))
    # the nearest and the smallest partner: whatever is left unconnected is compared below
    star = star.groupBy("b").agg(F.min("a").alias("a1"), F.min(F.struct("bits", "a"))["a"].alias("a2"))
    star = kept(star.select(F.explode(F.array_distinct(F.array("a1", "a2"))).alias("a"), "b"), "star")
    edges = confirm(star, docs, n, similar)
    first = kept(components(edges), "components")
    placed = shared.select(F.col("bucket").alias("key"), "id").join(first, "id", "left")
    placed = kept(placed.withColumns({"component": F.coalesce("component", "id"), "one": F.lit(1)}), "placed")
    rows = _parted(placed, "one", BLOCK).join(sketches, "id")
    clusters = kept(_by_group(rows, _clusters, "a long, b long").distinct(), "clusters")
    clusters = kept(components(clusters), "cluster-ids")
    # every document of a cluster goes there once, with its full set
    sets = kept(_sets(docs, kept(clusters.select("id"), "set-ids"), n), "sets")
    members = clusters.select("id", F.col("component").alias("key")).join(first, "id", "left")
    members = members.withColumn("component", F.coalesce("component", "id")).join(sets, "id")
    members = _parted(members.withColumn("size", F.octet_length("h")), "size", BLOCK_BYTES).join(sketches, "id")
    edges = edges.union(kept(_by_group(members, _links(round(similar * 100)), "a long, b long"), "links"))
    final = components(edges)
    label = nodes.join(final, "id", "left").select("set", F.coalesce("component", "id").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set")).alias("set"))
    out = out.join(label, "set", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept_one = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept_one.alias("kept"))


def dedup(docs: DataFrame, n: int = 5, similar: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller doc_id; all columns kept."""
    gone = classes(docs, n, similar).where("NOT kept").select("doc_id").distinct()
    return without(docs, gone, "doc_id")


def differing(a: str, b: str):
    """Bits in which two sketches of equal length differ."""
    words = range(0, SKETCH_BITS // 8, 4)  # four bytes at a time: conv gives unsigned numbers
    part = lambda s, i: F.conv(F.hex(F.substring(s, i + 1, 4)), 16, 10).cast("bigint")
    return sum((F.bit_count(part(a, i).bitwiseXOR(part(b, i))) for i in words), F.lit(0))
