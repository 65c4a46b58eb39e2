"""Mixing sources to target weights by systematic sampling.

Within a source all documents have the same expected number of copies,
e = target / source size. With the documents of a source in a fixed order the
expected copies are summed up, one random offset u in [0, 1) is added, and a
document is emitted once for every whole number that its interval crosses:
document r (from 0) is taken floor((r + 1) e + u) - floor(r e + u) times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from scenetext.llm.common import LONG, kept, n_words, text_of

# Parts of 1 that expected copies and offsets are rounded down to, so that sums are exact.
UNIT = 10**9


def targets(sizes: DataFrame, weights: Sequence[float], most: int = 3) -> DataFrame:
    """``source, source_size, n_docs`` with a ``target`` in words each.

    Sources by code point, null last, weigh ``weights`` in turn. All sizes
    together are shared by weight; a target stops at ``most`` times its
    source's size, and the excess goes to the others by weight until none is
    above. The table has one row per source, never one per document.

    Sharing: let f be the words per unit of weight that the sources below
    their limit get. Sources reach their limit in the order of limit / weight,
    so f follows from running sums in that order, without repeated rounds.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    pick = F.element_at(F.lit([float(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    everyone = W.partitionBy()
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rows = sizes.withColumns({"weight": pick, "limit": (most * F.col("source_size")).cast("double")})
    share = F.sum("source_size").over(everyone).cast("double")
    rows = rows.withColumns(
        {
            "_left": share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "_weight": F.sum("weight").over(everyone)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    rows = rows.withColumn("_full", F.col("limit") / F.col("weight") <= F.col("_left") / F.col("_weight"))
    # words per weight for those below their limit: the first that is not full tells it
    rate = F.max(F.when(~F.col("_full"), F.struct(-F.col("limit") / F.col("weight"), F.col("_left") / F.col("_weight")))).over(everyone)
    rows = rows.withColumn("_rate", rate.getField("col2"))
    target = F.when(F.col("_full"), F.col("limit")).otherwise(F.col("weight") * F.col("_rate"))
    return rows.withColumn("target", target).drop("_left", "_weight", "_full", "_rate", "limit")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    seed: int = 0,
    digits: int = 3,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (of its source) and ``copies``.

    The order within a source is (size, md5 of doc_id and seed, doc_id): close
    sizes follow one another, so the words taken differ from the target by
    about one document. The running number of a document is found in three
    levels (size, first ``digits`` of the md5, row), so no window holds more
    than the documents of one source, size and md5 prefix: a source with a
    third of all rows is spread over all tasks, and so is a group of copies.

    A null source is a source of its own, a null text has size 0, a null
    doc_id sorts as the text ``null``. Sources without any word have e = 0.
    Repeated rows count as often as they occur; equal rows may swap copies.
    Columns named size, source_size, target or copies are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    # null sources as a value of their own, so that all keys join by plain equality
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    docs = docs.withColumns({"_key": key, "size": n_words(text_of()), "_mark": mark})
    docs = docs.withColumn("_part", F.substring("_mark", 1, digits))
    groups = docs.groupBy("_key", "size", "_part").agg(F.count(F.lit(1)).alias("_n"))
    groups = kept(groups, "mix-groups")
    by_size = groups.groupBy("_key", "size").agg(F.sum("_n").alias("_n"))
    per_source = by_size.groupBy("_key").agg(
        F.sum("_n").alias("n_docs"), F.sum(F.col("_n") * F.col("size")).alias("source_size")
    )
    name = F.when(F.col("_key") != "n", F.substring("_key", 2, 2**30))
    shares = targets(per_source.withColumn("source", name), weights, most).drop("source", "weight")
    # expected copies in UNITs; the limit of copies holds exactly, as it is a whole number
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_key")).cast("binary")), 1, 8), 16, 10)
    offset = F.floor(drawn.cast("double") / 2**32 * UNIT)
    shares = shares.withColumns({"_e": F.least(expected, F.lit(most * UNIT)).cast(LONG), "_u": offset.cast(LONG)}).drop("n_docs")

    def before(*order: str) -> W:
        return W.partitionBy(*order[:-1]).orderBy(order[-1]).rowsBetween(W.unboundedPreceding, -1)

    sizes = by_size.select("_key", "size", F.coalesce(F.sum("_n").over(before("_key", "size")), F.lit(0)).alias("_b1"))
    parts = groups.select("_key", "size", "_part", F.coalesce(F.sum("_n").over(before("_key", "size", "_part")), F.lit(0)).alias("_b2"))
    starts = parts.join(sizes, ["_key", "size"]).join(shares, "_key")
    here = W.partitionBy("_key", "size", "_part").orderBy("_mark", F.col("doc_id").isNull(), "doc_id")
    ranked = docs.withColumn("_i", F.row_number().over(here) - 1).join(starts, ["_key", "size", "_part"])
    rank = F.col("_b1") + F.col("_b2") + F.col("_i")

    def upto(r: Column) -> Column:
        # r * e + u, split so that it stays within 64 bits: e = whole * UNIT + rest
        whole, rest = F.floor(F.col("_e") / UNIT), F.col("_e") % UNIT
        exact = (r.cast("decimal(20,0)") * rest.cast("decimal(10,0)") + F.col("_u").cast("decimal(10,0)")) / F.lit(UNIT).cast("decimal(10,0)")
        return r * whole + F.floor(exact).cast(LONG)

    return ranked.withColumn("copies", upto(rank + 1) - upto(rank)).drop(
        "_key", "_mark", "_part", "_b1", "_b2", "_i", "_e", "_u"
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` once per copy, with the number of the copy in ``copy``."""
    n = F.col("copies").cast("int")
    copies = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return mixed.withColumn("copy", F.explode(copies))
