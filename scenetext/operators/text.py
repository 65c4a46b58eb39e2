"""Text operators: words, characters, counts and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetext.functions import words as W


def strip_punctuation(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, W.strip_punctuation(F.col(text)))


def sentence_words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence: ``words ARRAY<STRING>`` in place of the text."""
    return df.withColumn("words", W.split_words(F.col(text))).drop(text)


def words_flat(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per word, with its position ``pos`` in the sentence."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(W.split_words(F.col(text))).alias("pos", "w"))


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """Bag of lower-case words without punctuation, one row each."""
    return df.select(F.explode(W.clean_words(F.col(text))).alias("w")).where(F.col("w") != "")


def words_in_order(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Like ``words`` with the place of every word: ``keys`` of the text and ``pos``."""
    split = F.array_remove(W.clean_words(F.col(text)), "")
    return df.select(*keys, F.posexplode(split).alias("pos", "w"))


def characters(df: DataFrame, text: str = "text") -> DataFrame:
    """One row ``c`` per character (code point)."""
    return df.select(F.explode(W.characters(F.col(text))).alias("c")).where(F.col("c") != "")


def plural(df: DataFrame, word: str = "w") -> DataFrame:
    return df.withColumn("plural", F.concat(F.col(word), F.lit("s")))


def with_length(df: DataFrame, word: str = "w") -> DataFrame:
    return df.withColumn("n", W.text_length(F.col(word)))


def longer_than(df: DataFrame, length: int = 3, word: str = "w") -> DataFrame:
    return df.where(F.length(word) > length)


def nonempty_lines(df: DataFrame, line: str = "value") -> DataFrame:
    return df.where(F.length(line) > 0)


def count_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows ``n`` per key. Combined before the shuffle: a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def reduce_by_key(df: DataFrame, *keys: str, value: str = "n", how=F.sum) -> DataFrame:
    """Values of a key reduced with an aggregate function; result stays distributed."""
    return df.groupBy(*keys).agg(how(value).alias(value))


def top(df: DataFrame, k: int, by: str, ties: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal ones in order of ``ties``.

    Planned as a bounded heap per task, not as a sort of all rows.
    """
    return df.orderBy(F.desc(by), F.asc(ties)).limit(k)


TRACKED = 65_536  # keys that a frequency sketch follows
SKETCH_TASKS = 64  # tasks that merge the sketches of all others

# A key with more than this share (over ``tracked``) of all rows is in the sketch: its stated error.
SKETCH_SHARE = 3.5


def frequent(df: DataFrame, key: str, k: int, n: str = "n", tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent values of ``key`` with exact counts, as ``top`` of ``count_by_key``
    would give them, without a shuffle of all distinct values.

    A sketch of bounded size per task gives candidates, and only those are
    counted. What is no candidate has at most as many rows as the sketch's
    error or its last candidate; if the last of the ``k`` has more, the result
    is proven and returned, else everything is counted after all.
    """
    known = df.where(F.col(key).isNotNull()).select(key)
    sketch = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked))
    parts = known.groupBy((F.spark_partition_id() % SKETCH_TASKS).alias("_task")).agg(sketch.alias("s"), F.count(key).alias("n"))
    # grouped, as there may be nothing to combine
    merged = parts.groupBy(F.lit("all").alias("_all")).agg(F.call_function("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s"), F.sum("n").alias("n"))
    most = min(max(20 * k, 200), tracked)
    row = merged.select(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(most)).alias("found"), "n").first()
    if row is None:
        return top(count_by_key(known, key), k, n, key)
    candidates = [x["item"] for x in row["found"]]
    left_out = max(SKETCH_SHARE * row["n"] / tracked, row["found"][-1]["count"] if len(candidates) == most else 0)
    listed = df.sparkSession.createDataFrame([(c,) for c in candidates], df.select(key).schema)
    counted = top(count_by_key(known.join(F.broadcast(listed), key), key), k, n, key).persist(StorageLevel.MEMORY_AND_DISK)
    least = counted.agg(F.min(n), F.count(F.lit(1))).first()
    if least[1] == k and least[0] > left_out:
        return counted
    counted.unpersist()
    return top(count_by_key(known, key), k, n, key)


def first(df: DataFrame, k: int, *order: str) -> DataFrame:
    """The first ``k`` rows in a given order."""
    return df.orderBy(*order).limit(k)


def first_texts(df: DataFrame, k: int, key: str, text: str, blank: str) -> DataFrame:
    """The first ``k`` texts by ``key`` that hold anything but ``blank`` characters.

    Each has at least one word or token, so the first ``k`` of those lie in
    these texts and no other text needs to be split.
    """
    other = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in blank) + "]"
    return df.where(F.col(text).rlike(other)).orderBy(key).limit(k)


def first_words(df: DataFrame, k: int, key: str, text: str = "text") -> DataFrame:
    """The first ``k`` words of all texts in order of the unique ``key``."""
    head = first_texts(df, k, key, text, W.SPACES + W.PUNCTUATION)
    return first(words_in_order(head, [key], text), k, key, "pos")


def total(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row table."""
    return df.agg(F.count("*").alias("n"))
