"""Personal data: fixed patterns, and identifiers found by bootstrapped contextual extraction.

Seeds are what the fixed patterns find, with all their blanks. The words to the
left of a seed, and those to its right, are lexical patterns; other
identifier-like strings beside the same words are their instances. Patterns and instances form a graph on which scores are passed back
and forth a fixed number of times:

    pattern  = (sum of its instances' scores) / (its instances + ``doubt``)
    instance = 1 for a seed, else 1 - product of (1 - score) of its patterns

Instances of patterns above ``accept`` that no fixed pattern found are the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, SPACE, find_all, kept, let, span_text, text_of

KINDS = ("email", "ip", "card", "phone", "context")

# The base patterns. Possessive and anchored to the start of a run
# (or the end of the match before), so the matches are the same and long runs cost linear time.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# An identifier-like string: a word with a digit or an at sign.
LIKE = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
LEAST_CHARS = 6
# Code points on either side in which the words of a pattern are looked for. A word that reaches beyond them is
# left out, and a pattern with it; it is never cut.
SIDE = 256


def _luhn(m: Column) -> Column:
    digits = F.reverse(F.regexp_replace(m, "[^0-9]", ""))
    doubled = F.transform(
        F.array_remove(F.split(digits, ""), ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", ""))


def base_spans(text: Column) -> Column:
    """array<struct<no, start, end, m>> in order of kind, then start."""

    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    tests = (
        (EMAIL, "@", None),
        (IP, ".", lambda s: F.forall(F.split(s["m"], r"\."), small)),
        (CARD, None, lambda s: F.when(_digits(s["m"]).between(13, 19), _luhn(s["m"])).otherwise(False)),
        (PHONE, "+", lambda s: _digits(s["m"]).between(9, 15)),
    )
    out = []
    for no, (pattern, needs, test) in enumerate(tests):
        spans = find_all(text, pattern)
        if needs:
            nothing = F.array().cast("array<struct<start:int,end:int,m:string,gap:string,after:string>>")
            spans = F.when(F.contains(text, F.lit(needs)), spans).otherwise(nothing)
        spans = F.filter(spans, test) if test else spans
        out.append(_named(no, spans))
    return F.concat(*out)


def _named(no: int, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(no).alias("no"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"),
            s["gap"].alias("gap"), s["after"].alias("after"),
        ),
    )


def _patterns(before: Column, behind: Column, words: int) -> Column:
    """array<string>: the ``words`` whole words right before a place and those right behind it, lower
    case, each if there are as many; a word that the text between two matches cuts off does not count."""

    def side(text: Column, first: bool) -> Column:
        near = F.left(text, F.lit(SIDE)) if first else F.right(text, F.lit(SIDE))
        pieces = F.split(F.lower(near), f"[{SPACE}]+")
        # what touches the place is no word of its own, and what lies at the far edge may be cut
        whole = F.when(
            F.length(text) > SIDE, F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0)))
        ).otherwise(F.slice(pieces, 2, 2**30) if first else F.slice(pieces, 1, F.size(pieces) - 1))
        listed = F.array_remove(whole, "")
        near_words = F.slice(listed, 1, words) if first else F.slice(listed, -words, words)
        mark = "> " if first else "< "
        return F.when(F.size(listed) >= words, F.concat(F.lit(mark), F.array_join(near_words, " ")))

    return F.array_compact(F.array(side(before, False), side(behind, True)))


def mentions(text: Column, base: Column, words: int, least_chars: int = LEAST_CHARS) -> Column:
    """array<struct<start, end, instance, patterns, seed>>: the base spans, whole, and
    identifier-like words outside them without marks at their ends, ``least_chars`` long or more."""

    def one(s: Column) -> Column:
        bare = F.regexp_extract(s["m"], r"^[^\p{L}\p{N}+]*(.*?)[^\p{L}\p{N}]*$", 1)
        cut = F.instr(s["m"], bare) - 1
        start = s["start"] + cut
        # blanks stand for the marks that were taken off
        before = F.concat(s["gap"], F.when(cut > 0, " ").otherwise(""))
        behind = F.concat(F.when(cut + F.length(bare) < F.length(s["m"]), " ").otherwise(""), s["after"])
        return F.struct(
            start.alias("start"), (start + F.length(bare)).alias("end"), bare.alias("instance"),
            _patterns(before, behind, words).alias("patterns"), F.lit(False).alias("seed"),
        )

    def whole(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("instance"),
            _patterns(s["gap"], s["after"], words).alias("patterns"), F.lit(True).alias("seed"),
        )

    def outside(s: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    words_like = F.filter(F.transform(find_all(text, LIKE), one), lambda s: (F.length(s["instance"]) >= least_chars) & (F.size(s["patterns"]) > 0))
    return F.concat(F.transform(base, whole), F.filter(words_like, outside))


def score(graph: DataFrame, rounds: int, doubt: float) -> DataFrame:
    """``pattern, score`` after ``rounds`` of passing scores over
    ``graph(pattern, instance, seed)`` with one row per pair.

    Patterns without a seed keep score 0 and only matter through shared
    instances. Sums are combined before the shuffle, so a pattern or an
    instance with a third of all pairs is no hot group.
    """
    edges = graph.withColumn("i", F.col("seed").cast("double"))
    for _ in range(rounds):
        patterns = edges.groupBy("pattern").agg((F.sum("i") / (F.count("*") + F.lit(doubt))).alias("score"))
        scored = graph.join(patterns, "pattern")
        # 1 - product of (1 - score), as a sum of logarithms
        missed = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-12)))))
        instances = scored.where(~F.col("seed")).groupBy("instance").agg((1 - missed).alias("i"))
        edges = kept(
            graph.join(instances, "instance", "left").withColumn(
                "i", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("i", F.lit(0.0)))
            ),
            "pii-round",
        )
    return patterns


def find(
    docs: DataFrame,
    words: int = 2,
    rounds: int = 3,
    doubt: float = 2.0,
    accept: float = 0.5,
    text: str = "text",
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``context``, arrays of
    struct<no, start, end, m> (no: place in ``KINDS``).

    The whole text is read once; the scoring works on the distinct pairs of
    pattern and instance. Null texts are empty. Repeated rows each get a row:
    found spans go back to their text by doc_id and a hash of the text, so
    equal rows share them and null doc_ids work. Columns that are not used
    are not carried, whatever they are called.
    """
    body = text_of(text)
    rows = docs.select("doc_id", body.alias("_text"), base_spans(body).alias("_base"))
    # two hashes, as one of 64 bits would meet another among very many rows
    key = F.concat_ws(":", F.xxhash64("doc_id", "_text").cast("string"), F.xxhash64(F.lit(1), "_text", "doc_id").cast("string"))
    plain = F.transform("_base", lambda s: F.struct(*(s[c].alias(c) for c in ("no", "start", "end", "m"))))
    found = let(F.col("_base"), lambda b: mentions(F.col("_text"), b, words, least_chars))
    rows = kept(rows.select("doc_id", key.alias("_key"), plain.alias("base"), found.alias("_mentions")), "pii")
    each = rows.select("_key", F.explode("_mentions").alias("s")).select("_key", "s.*")
    each = each.withColumn("pattern", F.explode("patterns")).drop("patterns")
    graph = each.groupBy("pattern", "instance").agg(F.bool_or("seed").alias("seed"))
    good = score(kept(graph, "pii-graph"), rounds, doubt).where(F.col("score") >= accept).select("pattern")
    new = each.where(~F.col("seed")).join(good, "pattern", "left_semi")
    span = F.struct(F.lit(len(KINDS) - 1).alias("no"), "start", "end", F.col("instance").alias("m"))
    new = new.groupBy("_key").agg(F.array_sort(F.collect_set(span)).alias("context"))
    none = F.array().cast("array<struct<no:int,start:int,end:int,m:string>>")
    return rows.join(new, "_key", "left").select("doc_id", "base", F.coalesce("context", none).alias("context"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and text of the spans of ``find``."""
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda spans: F.array_join(F.transform(spans, lambda s: span_text(F.get(names, s["no"]), s)), ",")
    count = lambda no: F.size(F.filter("base", lambda s: s["no"] == no)).cast(LONG)
    return found.select(
        "doc_id",
        *[count(no).alias(f"n_{KINDS[no]}") for no in range(4)],
        F.sha2(line(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        line(F.concat("base", "context")).alias("spans"),
        F.size("context").cast(LONG).alias("n_context"),
    )
