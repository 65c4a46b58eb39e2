"""Quality rules, line first: bad lines go, then documents that lost too much."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, SPACE, WORD, text_of, words_of


class LineRules(NamedTuple):
    """What makes a line fail.

    A line is *navigation* when it is short and cut by separators, or when
    separators are a large part of it; *boilerplate* when it matches one of
    the fixed phrases; and fails on *punctuation* when symbols stand at so
    many of its words, or when it has many words and no mark that ends or
    divides a sentence.
    """

    separator: str = r"\||»|›|::| [>/] "
    nav_words_per_separator: float = 3.0
    boilerplate: str = (
        r"(?i)all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|"
        r"javascript is (?:disabled|required)|subscribe to our|click here|sign up|log in to"
    )
    symbols: str = r"[#*$%&<>{}\[\]\\^~=_]{2,}"
    symbol_share: float = 0.3
    unpunctuated_words: int = 40
    marks: str = r"[.!?,;:…。！？]"
    max_lost_share: float = 0.5


def line_verdict(line: Column, rules: LineRules) -> Column:
    """Why a line fails, or null."""
    words = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(rules.separator))
    symbols = F.regexp_count(line, F.lit(rules.symbols))
    return (
        F.when(words == 0, None)
        .when((separators >= 2) & (words < rules.nav_words_per_separator * separators), "navigation")
        .when(F.regexp_like(line, F.lit(rules.boilerplate)), "boilerplate")
        .when(symbols > rules.symbol_share * words, "punctuation")
        .when(
            (words >= rules.unpunctuated_words) & ~F.regexp_like(line, F.lit(rules.marks)), "punctuation"
        )
    )


def _bare_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast(LONG)


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``docs`` with ``clean_text`` (lines that pass, in order), ``lost_chars``
    and ``full_chars`` (code points in words), ``n_bad_lines`` and ``too_much_lost``.

    Null and empty texts have no words, lose nothing and stay. Columns of
    these names are replaced; all others are kept. No shuffle.
    """
    lines = F.split(text_of(text), "\n", -1)
    good = F.filter(lines, lambda x: line_verdict(x, rules).isNull())
    out = docs.withColumn("_good", good)
    out = out.withColumns(
        {
            "clean_text": F.array_join("_good", "\n"),
            "n_bad_lines": (F.size(lines) - F.size("_good")).cast(LONG),
            "full_chars": _bare_length(text_of(text)),
        }
    ).drop("_good")
    out = out.withColumn("lost_chars", F.col("full_chars") - _bare_length(F.col("clean_text")))
    return out.withColumn("too_much_lost", F.col("lost_chars") > rules.max_lost_share * F.col("full_chars"))


def with_repeat_words(docs: DataFrame, words: str, into: str, n: int = 3) -> DataFrame:
    """Adds ``into``: how many words stand in windows of ``n`` words that occur
    twice or more in their row (first ones included).

    Windows are compared by 64-bit hashes. They are sorted once per row, so
    the cost is n log n in the words, whatever repeats.
    """
    docs = docs.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_h") - n),
        lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(n)]),
    )
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn("_w", F.when(F.size("_h") >= n, window).otherwise(none))
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    pairs = F.transform(F.col("_w"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    docs = docs.withColumn("_r", F.when(repeats, F.array_sort(pairs)))

    def again(s: Column, k: Column) -> Column:
        near = [F.get(F.col("_r"), k + d)["x"] == s["x"] for d in (-1, 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    covered = F.transform(
        F.filter(F.col("_r"), again), lambda s: F.array(*[s["i"] + k for k in range(n)])
    )
    count = F.size(F.array_distinct(F.flatten(covered)))
    return docs.withColumn(into, F.when(repeats, count).otherwise(0).cast(LONG)).drop("_h", "_w", "_r")


def assess(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, and ``kept`` (false
    if the base rules fail or the line rules take too much of the text).

    A null text counts as empty: no words, so it fails. Repeated rows are each
    judged; other columns of ``docs`` do not matter. No shuffle.
    """
    text = text_of()
    docs = docs.select("doc_id", text.alias("text"))
    docs = clean_lines(docs, rules).withColumn("_words", words_of(F.col("text")))
    docs = with_repeat_words(docs, "_words", "n_repeat_words")
    filled = F.filter(F.split(F.col("text"), "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    marks = "#*$%&|<>"
    docs = docs.withColumn("_lines", filled).withColumn("n_words", F.size("_words").cast(LONG))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return docs.select(
        "doc_id",
        "n_words",
        F.col("full_chars").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", marks, ""))).cast(LONG).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast(LONG).alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.col("too_much_lost")).alias("kept"),
        "n_bad_lines",
        "lost_chars",
    )
