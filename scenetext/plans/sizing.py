"""Joins whose broadcast side is measured first."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only below this many bytes, as counted by ``measured_bytes``.
BROADCAST_BYTES = 32 * 1024 * 1024

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so fewer than
# HOT_SHARE keys can be hot. Each is spread over as many shuffle groups as it has
# such shares, so that no group has more of it, and all of them have fewer than
# 2 * HOT_SHARE groups.
HOT_SHARE = 1000


def _width(kind: T.DataType) -> int:
    """Bytes of a value without its text, and of an element of an array, at most."""
    if isinstance(kind, T.StructType):
        return 16 + sum(_width(f.dataType) for f in kind)
    return 16


def measured_bytes(df: DataFrame, weight: str | None = None) -> tuple[int, int]:
    """Upper estimate of the bytes of a table of scalars, texts and arrays of numbers, and the sum of ``weight``."""
    fixed = sum(_width(f.dataType) for f in df.schema)
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    arrays = [f for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    sizes += [F.coalesce(F.size(f.name), F.lit(0)) * _width(f.dataType.elementType) for f in arrays]
    text = sum((c.cast("bigint") for c in sizes), F.lit(0).cast("bigint"))
    total = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("chars"), total.alias("rows")).first()
    return row["n"] * fixed + (row["chars"] or 0), row["rows"] or 0


class Sized(NamedTuple):
    """A derived table of one row per key, computed once and measured.

    ``weight`` is its column that says how many rows of the table it was
    derived from have the key, ``rows`` the sum of that.
    """

    table: DataFrame
    weight: str
    size: int
    rows: int


def sized(table: DataFrame, weight: str = "n") -> Sized:
    """Keeps ``table`` (a lost executor only means its blocks are computed
    again) and measures it in the job that fills it."""
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    return Sized(table, weight, *measured_bytes(table, weight))


def null_safe_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, where NULL equals NULL: keys first, as a join by name has them."""
    right = small.withColumnsRenamed({c: f"_right_{c}" for c in on})
    equal = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    rest = [c for df in (large, small) for c in df.columns if c not in on]
    return large.join(right, equal, how).select(*on, *rest)


def attach(
    large: DataFrame, small: Sized, on: Sequence[str], spread_on: Sequence[str], limit: int
) -> DataFrame:
    """Inner join of a large table with one derived from it; the weight is left out.
    NULL in a key is a value like any other, so no row of ``large`` is lost.

    Up to ``limit`` bytes the small side is broadcast and ``large`` does not
    move. Beyond that both are shuffled; the rows of hot keys are spread by a
    hash of ``spread_on`` and meet one copy of their small row per group.
    """
    on, table, weight = list(on), small.table, small.weight
    if small.size <= limit:
        return null_safe_join(large, F.broadcast(table.drop(weight)), on)
    is_hot = F.col(weight) * HOT_SHARE > small.rows
    salts = F.ceil(F.col(weight) * HOT_SHARE / F.lit(max(small.rows, 1))).cast("int")
    hot = table.where(is_hot).select(*on, salts.alias("_salts"))
    salt = F.pmod(F.xxhash64(*spread_on), F.col("_salts")).cast("int")
    spread = (
        null_safe_join(large, F.broadcast(hot), on, "left")  # fewer than HOT_SHARE rows, see above
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_salts")
    )
    groups = F.when(is_hot, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))
    copies = table.withColumn("_salt", F.explode(groups)).drop(weight)
    return null_safe_join(spread, copies, [*on, "_salt"]).drop("_salt")
