"""URL filters by a cascade of Bloom filters.

Level 1 encodes the listed keys, level 2 the keys of the corpus that are not
listed and pass level 1, level 3 the listed keys that pass level 2, and so on
until no key is wrong. Every key of the corpus was tried while building, so the
first level that rejects a key gives its exact answer, and judging rows needs
no join: the levels are small bit arrays inside the expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import kept

# Bits that one level may have: its array goes to every task, so its size is checked.
MAX_BITS = 2**27


class Level(NamedTuple):
    bits: bytes
    n_bits: int
    n_hashes: int
    number: int

    def passes(self, key: Column) -> Column:
        out, bits = F.lit(True), F.lit(bytearray(self.bits))
        for at in self.positions(key):
            # words are written with the high byte first
            byte = F.shiftright(at, 6) * 8 + 7 - F.shiftright(at % 64, 3)
            value = F.conv(F.hex(F.substring(bits, (byte + 1).cast("int"), F.lit(1))), 16, 10)
            out = out & (F.getbit(value.cast("int"), (at % 8).cast("int")) == 1)
        return out

    def positions(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.n_bits))
            for j in range(self.n_hashes)
        ]


def encode(keys: DataFrame, n: int, number: int, fpp: float) -> Level:
    """One level for the ``n`` rows of ``keys(key)``.

    Bits are combined per 64-bit word before the shuffle, so what meets in one
    row are n_bits / 64 words, a size that is checked against ``MAX_BITS``.
    """
    n_bits = max(64, 64 * math.ceil(n * math.log(1 / fpp) / math.log(2) ** 2 / 64))
    if n_bits > MAX_BITS:
        raise ValueError(f"{n} keys need {n_bits} bits; split the list, the limit is {MAX_BITS}")
    level = Level(b"", n_bits, math.ceil(math.log2(1 / fpp)), number)
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    one = F.expr("shiftleft(1L, CAST(at % 64 AS INT))")
    words = at.select(F.shiftright("at", 6).alias("w"), one.alias("b"))
    blank = keys.sparkSession.range(n_bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("b"))
    words = words.union(blank).groupBy("w").agg(F.bit_or("b").alias("b"))
    dense = F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: F.lpad(F.hex(x["b"]), 16, "0"))
    return level._replace(bits=bytes(words.agg(F.unhex(F.array_join(dense, "")).alias("b")).first()["b"]))


class Cascade(NamedTuple):
    """``contains(key)`` is exact for every key of the universe it was built over."""

    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in reversed(range(len(self.levels))):
            answer = F.when(~self.levels[k].passes(key), F.lit(k % 2 == 1)).otherwise(answer)
        return answer


def build(universe: DataFrame, listed: DataFrame, fpp: float = 0.01, name: str = "list") -> Cascade:
    """Cascade for the keys of ``listed(key)`` within ``universe(key)``.

    Nulls and repeated keys do not matter. A list or universe without rows
    works: an empty list has no level and contains nothing. Only keys that
    occur in the corpus are encoded, so the levels follow what is there.
    Building takes a few passes over the distinct keys, each smaller by the
    factor ``fpp``; the driver only sees row counts.
    """
    listed = listed.where("key IS NOT NULL").select("key").distinct()
    universe = universe.where("key IS NOT NULL").select("key").distinct()
    inside = kept(universe.join(listed, "key", "left_semi"), f"{name}-in")
    outside = universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    now, rest = inside, outside
    while (n := now.count()) > 0:
        levels.append(encode(now, n, len(levels), fpp))
        wrong = rest.where(levels[-1].passes(F.col("key")))
        now, rest = kept(wrong, f"{name}-{len(levels)}"), now
    return Cascade(tuple(levels))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def candidates(host: str, path: str, host_parts: int, path_lengths: Sequence[int]) -> Column:
    """All keys that could fit: the last 1 to ``host_parts`` parts of the host,
    each alone and with every start of the path that has one of the lengths."""
    parts = F.split(F.col(host), r"\.", -1)
    deep = F.least(F.size(parts), F.lit(host_parts))
    ends = F.transform(F.sequence(F.lit(1), deep), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    starts = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]
    starts = F.array_compact(F.array(F.lit(""), *starts))
    return F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda s: F.concat(e, s))))


def judge(pages: DataFrame, rules: DataFrame, fpp: float = 0.01) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed_host`` for every row of ``pages(page_id, url)``.

    ``rules(key, action)`` holds keys ``host`` or ``host/path`` with action
    allow or block. A key fits its host and all subdomains if the url's path
    starts with the key's. The longest key with a path is the ``rule`` and
    decides; without one, a listed host (a key without a path) does, the
    longest again; without any, the url is allowed. A key with both actions
    counts as allow. Null urls have an empty host and are allowed; repeated
    rows are each judged; other columns do not matter. The text of a url never
    makes more keys than host parts times path lengths of the rules.
    """
    # only sizes of the rules reach the driver: parts of hosts and distinct lengths of paths
    rules = kept(rules.select("key", "action").where("key IS NOT NULL"), "url-rules")
    start = F.instr("key", "/")
    shape = rules.select(
        F.size(F.split(F.split_part("key", F.lit("/"), F.lit(1)), r"\.", -1)).alias("parts"),
        F.when(start > 0, F.length("key") - start + 1).alias("n"),
    ).agg(F.max("parts").alias("parts"), F.collect_set("n").alias("n"))
    found = shape.first()
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path}).drop("url")
    keys = candidates("host", "path", found["parts"] or 0, sorted(found["n"] or []))
    rows = rows.withColumn("_keys", F.when(F.col("host") != "", keys).otherwise(F.array().cast("array<string>")))
    universe = kept(rows.select(F.explode("_keys").alias("key")).distinct(), "url-keys")
    allow = build(universe, rules.where("action = 'allow'"), fpp, "allow")
    block = build(universe, rules.where("action = 'block'"), fpp, "block")
    hits = F.filter(F.col("_keys"), lambda k: allow.contains(k) | block.contains(k))
    rows = rows.withColumn("_hits", hits)

    def longest(with_path: bool) -> Column:
        some = F.filter(F.col("_hits"), lambda k: (F.instr(k, "/") > 0) == F.lit(with_path))
        return F.array_max(F.transform(some, lambda k: F.struct(F.length(k), k.alias("key"))))["key"]

    rows = rows.withColumns({"rule": longest(True), "listed_host": longest(False)})
    decides = F.coalesce("rule", "listed_host")
    verdict = F.when(decides.isNull() | allow.contains(decides), "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed_host")


def tracking_hosts(pages: DataFrame, share: float = 0.4, least: int = 20) -> DataFrame:
    """Keys of hosts with ``least`` pages or more of which at least ``share``
    carry tracking parameters: the list used where no list is given."""
    host, _ = url_parts(F.col("url"))
    tracked = F.regexp_like(F.col("url"), F.lit(r"[?&](?:utm_[a-z]+|ref|fbclid|gclid)="))
    by_host = pages.select(host.alias("key"), tracked.cast("int").alias("t")).where("key <> ''")
    by_host = by_host.groupBy("key").agg(F.count("*").alias("n"), F.sum("t").alias("t"))
    return by_host.where((F.col("n") >= least) & (F.col("t") >= share * F.col("n"))).select("key")
