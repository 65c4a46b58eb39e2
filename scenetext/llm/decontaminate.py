"""Benchmark decontamination by spaced seeds.

A mask picks some of the words in a span and ignores the others. Hashes of
the picked words are joined between benchmark and documents, so a hit survives
changed words at ignored places. Around each hit, the words of document and
item are compared one by one on the hit's diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, kept, text_of, without
from scenetext.plans.sizing import BROADCAST_BYTES, measured_bytes

# Fixed masks of five words each: places picked, counted from the first.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 6, 7))


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits, lower case."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, masks=MASKS) -> DataFrame:
    """``rows`` (with ``h``, hashes of words) once per place ``at`` and mask ``mask`` with ``seed``.

    Rows with fewer words than a mask spans give none for it.
    """
    span = min(max(m) for m in masks) + 1
    last = F.size("h") - span
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("at", F.explode(places))
    hashes = [
        F.when(F.col("at") + max(m) < F.size("h"), F.xxhash64(F.lit(k), *[F.get("h", F.col("at") + p) for p in m]))
        for k, m in enumerate(masks)
    ]
    return rows.withColumn("seed", F.explode(F.array(*hashes))).where("seed IS NOT NULL")


def _short_hits(rows: DataFrame, items: DataFrame, span: int, limit: int) -> DataFrame | None:
    """Hits of items with fewer than ``span`` words, which no mask fits: the whole item, word for word.

    Only the lengths that occur are tried, fewer than ``span``; the items are
    measured like the seeds. None if there is no such item.
    """
    short = kept(items.where(F.size("h") < span).select("item_id", "h", F.size("h").alias("n")), "short-items")
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())
    if not lengths:
        return None
    n_bytes, _ = measured_bytes(short)
    whole = short.select("item_id", F.xxhash64("n", "h").alias("seed"), F.col("h").alias("item"))
    none = F.array().cast("array<struct<n:int,at:int>>")

    def places_of(n: int) -> Column:
        last = F.size("h") - n
        here = F.transform(F.sequence(F.lit(0), last), lambda at: F.struct(F.lit(n).alias("n"), at.alias("at")))
        return F.when(last >= 0, here).otherwise(none)

    places = F.concat(*map(places_of, lengths))
    each = rows.withColumn("p", F.explode(places)).select("_key", "doc_id", "p.*", F.expr("slice(h, p.at + 1, p.n)").alias("part"))
    each = each.withColumn("seed", F.xxhash64("n", "part"))
    found = each.join(F.broadcast(whole) if n_bytes <= limit else whole, "seed").where("part = item")
    return found.select("_key", "doc_id", "item_id", F.col("at").alias("start"), F.col("n").alias("matched"), F.col("n").alias("compared"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 25,
    similar: float = 0.8,
    limit: int = BROADCAST_BYTES,
    masks=MASKS,
) -> DataFrame:
    """``_key, doc_id, item_id, start, matched, compared`` for verified hits of ``docs(doc_id, text, _key)``.

    The window of ``window`` words of the item around the hit (all words of a
    shorter item) must agree with the document in ``similar`` of its words,
    place by place; ``start`` is the word of the document where it begins.
    Null and empty texts have no hits; an item shorter than the shortest mask is
    found where all its words stand in a row; items with equal texts are all
    reported.

    The seeds of the benchmark are measured; below ``limit`` bytes they are
    broadcast and the documents do not move. Beyond that the seeds of the
    documents are shuffled: first only hashes that a benchmark seed has stay
    (Spark's own runtime filter). Very common seeds of the benchmark are one
    row per distinct seed here, so no key multiplies the documents' rows.
    """
    items = benchmark.select("item_id", tokens(text_of()).alias("h")).where(F.size("h") > 0)
    by_seed = seeds(items, masks).groupBy("seed").agg(F.collect_set(F.struct("item_id", "at")).alias("places"))
    by_seed = kept(by_seed, "seeds")
    n_bytes, _ = measured_bytes(by_seed.select("seed"))
    n_bytes += 16 * (by_seed.agg(F.sum(F.size("places"))).first()[0] or 0)
    small = F.broadcast(by_seed) if n_bytes <= limit else by_seed
    rows = docs.select("_key", "doc_id", tokens(text_of()).alias("h"))
    found = seeds(rows, masks).join(small, "seed")
    around = F.slice("h", F.greatest(F.col("at") - window, F.lit(0)) + 1, F.lit(3 * window))
    found = found.select("_key", "doc_id", "at", around.alias("near"), F.greatest(F.col("at") - window, F.lit(0)).alias("from"), F.explode("places").alias("p"))
    found = found.select("_key", "doc_id", "at", "near", "from", "p.item_id", F.col("p.at").alias("item_at"))
    texts = items.select("item_id", F.col("h").alias("item"))
    m_bytes = (items.agg(F.sum(F.size("h"))).first()[0] or 0) * 8
    found = found.join(F.broadcast(texts) if m_bytes <= limit else texts, "item_id")
    length = F.least(F.size("item"), F.lit(window))
    begin = F.greatest(F.lit(0), F.least(F.col("item_at") - F.lit(window // 3), F.size("item") - length))
    found = found.withColumns({"_n": length, "_a": begin})
    shift = F.col("at") - F.col("item_at") - F.col("from")
    same = F.filter(
        F.sequence(F.col("_a"), F.col("_a") + F.col("_n") - 1),
        lambda k: F.coalesce(F.get("near", k + shift) == F.get("item", k), F.lit(False)),
    )
    found = found.select(
        "_key", "doc_id", "item_id",
        (F.col("at") - F.col("item_at") + F.col("_a")).alias("start"),
        F.size(same).alias("matched"), F.col("_n").alias("compared"),
    )
    found = found.where(F.col("matched") >= F.lit(similar) * F.col("compared"))
    short = _short_hits(rows, items, min(max(m) for m in masks) + 1, limit)
    return found if short is None else found.union(short)


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``contaminated``, ``item_ids`` (ascending) and ``n_hits``.

    Repeated rows are all marked; null doc_ids and null texts get a row.
    Documents that hold many items or one item many times collapse to distinct
    (item, window) before they are gathered.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key"))
    hits = overlaps(rows, benchmark, **how).groupBy("_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.count("*").alias("n_hits")
    )
    none = F.array().cast("array<bigint>")
    return rows.drop("text").join(hits, "_key", "left").select(
        "doc_id",
        F.col("n_hits").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce("n_hits", F.lit(0)).cast(LONG).alias("n_hits"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without verified overlap, all columns kept."""
    key = F.xxhash64("doc_id", "text")
    rows = docs.select("doc_id", "text", key.alias("_key"))
    bad = overlaps(rows, benchmark, **how).select("_key").distinct()
    return without(docs.withColumn("_key", key), bad, "_key").drop("_key")
