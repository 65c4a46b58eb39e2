"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.plans.sizing import BROADCAST_BYTES, measured_bytes
from scenetext.sinks.folders import shared_folder

# White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

INT, LONG = "int", "bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast(LONG)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Within it, jobs hand rows to Python ``n`` at a time: for rows that are large each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def without(rows: DataFrame, bad: DataFrame, on: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` whose ``on`` is not in ``bad(on)``; a null ``on`` stays.

    ``bad`` is measured: up to ``limit`` bytes it is broadcast and ``rows`` do
    not move, beyond that both are shuffled.
    """
    bad = kept(bad, "without")
    n_bytes, _ = measured_bytes(bad)
    return rows.join(F.broadcast(bad) if n_bytes <= limit else bad, on, "left_anti")


# Elements of an array that are put together at a time.
_FAN = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(numbers: Column, levels: int = 3) -> Column:
    """Sum of the numbers before each one.

    Appending to an array copies it, so sums are made over blocks, over blocks
    of their sums, and so on: for a million numbers each is copied some hundred
    times and not a million.
    """
    if levels == 1:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(numbers, start, step, lambda acc: acc["out"])

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        starts = sums_before(sums, levels - 1)
        return F.flatten(F.zip_with(blocks, starts, lambda b, s: F.transform(sums_before(b, 1), lambda v: v + s)))

    def cut(whole: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(whole) - 1) / _FAN).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(whole, k * _FAN + 1, F.lit(_FAN)))

    return let(numbers, lambda whole: let(cut(whole), joined))


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (no capturing groups) as
    array<struct<start, end, m, gap, after>>: code points, end exclusive, the text matched
    and the text between it and the match before and behind.

    The pieces between matches give the positions, so the text is only
    searched twice and never cut character by character; the work is in
    proportion to the text and its matches.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def placed(gaps: Column) -> Column:
        pairs = F.arrays_zip(gaps.alias("gap"), found.alias("m"), F.slice(gaps, 2, 2**30).alias("after"))
        return let(F.filter(pairs, lambda x: x["m"].isNotNull()), spans)

    def spans(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda x: F.length(x["gap"]) + F.length(x["m"]))

        def span(x: Column, at: Column) -> Column:
            start = at + F.length(x["gap"])
            end = start + F.length(x["m"])
            return F.struct(
                start.alias("start"), end.alias("end"), x["m"].alias("m"), x["gap"].alias("gap"), x["after"].alias("after")
            )

        return F.zip_with(pairs, sums_before(sizes), span)

    return let(F.split(text, pattern, -1), placed)


def span_text(kind: Column, span: Column) -> Column:
    return F.concat_ws(":", kind, span["start"].cast("string"), span["end"].cast("string"))
