"""Spelling variants: words one edit apart, found by walking word states through a trie that is a table.

The trie of the sorted words is kept as edges (node, label, child); a chain
without a branch is one edge. A state is a word with the place reached in it,
the node reached, and its edits so far (0 or 1). In each round all states meet
the edges of their nodes in one join: a state follows its own letters, or
spends its edit. A state that reaches a leaf with one edit names a neighbour.

Every word is searched from both ends, for edits in the half that lies behind,
so a state may only spend its edit below the first half of its word, where few
branches are left. A replaced letter is searched from the word with the smaller
one and a letter left out from the longer word, so a pair is found once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.llm.common import LONG, kept, text_of

LEAST_CHARS = 7  # code points of a word, at least
LEAST_COUNT = 2  # occurrences of a word, at least
FORM_RATIO = 10  # a form is so many times as frequent as its variant, at least
DROP_ONE_IN = 31  # runs whose checksum this divides lose a letter

# A node with more than 1/HOT_SHARE of the words below it is hot. There are
# fewer than HOT_SHARE of them at each depth, so their edges are few.
HOT_SHARE = 1000

_END = " "  # after the last letter; sorts before all letters and is none
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = r"a-zÀ-ÿ"
_EDGES = "node string, label string, child string, nexts string, n long, hot boolean, child_hot boolean"


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """``word, n`` of ``docs(doc_id, text)``: runs of Latin letters, A-Z made small, some with a
    letter dropped by the checksum of ``<doc_id>:<run>``.

    Null texts have no words, a null doc_id stands as the empty string in the
    checksum, and a repeated row counts again. Counts combine before the shuffle.
    """
    small = F.translate(text_of(), _UPPER, _LOWER)
    # a shorter run gives no word, as letters only get lost
    runs = F.regexp_extract_all(small, F.lit(f"[{_LETTERS}]{{{least_chars},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(name.alias("_id"), F.explode(runs).alias("_run"))
    mark = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    place = F.pmod(F.col("_mark"), F.length("_run")).cast("int")
    shorter = F.concat(F.expr("substring(_run, 1, _place)"), F.expr("substring(_run, _place + 2)"))
    rows = rows.withColumn("_mark", mark).withColumn("_place", place)
    word = F.when(F.col("_mark") % drop_one_in == 0, shorter).otherwise(F.col("_run"))
    rows = rows.select(word.alias("word")).where(F.length("word") >= least_chars)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _sides(listed: DataFrame, least_chars: int) -> DataFrame:
    """Every word as read from either end, with its end mark: ``s, n, back, least, root``.

    ``least`` is where the other half begins. ``root`` stands for the first
    letters, as many as the least ``least`` of all words of that side.
    """
    n = F.length("word")
    half = (n / 2).cast("int")

    def side(w: Column, back: bool, least: Column, head: int) -> Column:
        return F.struct(w.alias("w"), F.lit(back).alias("back"), least.alias("least"), F.lit(head).alias("head"))

    ahead = side(F.col("word"), False, half, least_chars // 2)
    behind = side(F.reverse("word"), True, n - half, least_chars - least_chars // 2)
    rows = listed.select("n", F.inline(F.array(ahead, behind)))
    root = F.concat(F.when(F.col("back"), "<").otherwise(">"), F.expr("substring(w, 1, head)"))
    return rows.select(F.concat("w", F.lit(_END)).alias("s"), "n", "back", "least", root.alias("root"))


class _Node:
    """An open node of the trie: the edges known so far, and how many words are below."""

    __slots__ = ("depth", "name", "edges", "n_words")

    def __init__(self, depth: int, name: str) -> None:
        self.depth, self.name, self.edges, self.n_words = depth, name, [], 0

    def rows(self, hot: int) -> Iterator[tuple]:
        for label, child, nexts, n, n_words in self.edges:
            yield self.name, label, child, nexts, n, self.n_words > hot, child is not None and n_words > hot


def _edges(rows: Iterator[tuple[str, str, int]], prefix: str, hot: int) -> Iterator[tuple]:
    """Edges of the tries of sorted ``(root, s, n)``. Only the nodes above the last word are
    open, so memory is bounded by the longest word, whatever the number of words."""
    stack: list[_Node] = []
    last, last_n, made = "", 0, 0

    def hang(depth: int) -> Iterator[tuple]:
        """Hangs the last word into the trie and closes the nodes deeper than ``depth``."""
        nonlocal made
        end, child, nexts, n, n_words = len(last), None, "", last_n, 1
        while True:
            if stack[-1].depth < depth:
                made += 1
                stack.append(_Node(depth, f"{prefix}{made}"))
            top = stack[-1]
            top.edges.append((last[top.depth : end], child, nexts, n, n_words))
            top.n_words += n_words
            if top.depth == depth:
                return
            stack.pop()
            yield from top.rows(hot)
            end, child, n, n_words = top.depth, top.name, None, top.n_words
            nexts = "".join(edge[0][0] for edge in top.edges)

    def finish() -> Iterator[tuple]:
        yield from hang(stack[0].depth)
        yield from stack.pop().rows(hot)

    for root, s, n in rows:
        if stack and stack[0].name == root:
            same = stack[0].depth
            while last[same] == s[same]:
                same += 1
            yield from hang(same)
        else:
            if stack:
                yield from finish()
            stack.append(_Node(len(root) - 1, root))
        last, last_n = s, n
    if stack:
        yield from finish()


def trie(sides: DataFrame, n_sides: int) -> DataFrame:
    """Edges of the tries below all roots: ``node, label, child, nexts, n, hot, child_hot``.

    ``label`` holds the letters up to the next branch or the end, ``child`` is
    null at the end of a word, which then has ``n`` occurrences; ``nexts``
    holds the first letters of the child's edges. A root's words are one
    sorted stream; Spark sorts them and spills.
    """
    hot = n_sides // HOT_SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, str, int]]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        names = [f.split()[0] for f in _EDGES.split(", ")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*held, strict=True) if held else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for edge in _edges(rows(), f"{TaskContext.get().partitionId()}.", hot):
            held.append(edge)
            if len(held) == 10_000:
                yield batch()
                held.clear()
        yield batch()

    sorted_sides = sides.repartition("root").sortWithinPartitions("root", "s").select("root", "s", "n")
    return sorted_sides.mapInArrow(run, _EDGES)


def _moves() -> tuple[Column, Column]:
    """Which edges a state can take, and the states that come of it."""

    def letters(start: str, count: str | None = None) -> Column:
        return F.expr(f"substring(s, {start}{f', {count}' if count else ''})")

    here, size = letters("pos + 1", "1"), F.length("label")
    first = F.substring("label", 1, 1)
    leaf = F.col("child").isNull()

    def goes_on(at: str) -> Column:
        """At a leaf the label holds the end; else the child must have an edge for the next letter."""
        return leaf | F.col("nexts").contains(letters(f"{at} + length(label) + 1", "1"))

    can_edit = (F.col("edits") == 0) & (F.col("pos") >= F.col("least")) & (here != _END) & (first != here)
    # of a run of equal letters the last one is left out; from behind, a run that reaches into the first half is
    # left to the search from the front, which also has it below its half
    reaches = F.col("back") & (F.replace(F.expr("substring(s, least, pos - least + 2)"), here, F.lit("")) == "")
    own = letters("pos + 1").startswith(F.col("label")) & goes_on("pos") & ~(leaf & (F.col("edits") == 0))
    replaced = can_edit & (first > here) & letters("pos + 2").startswith(F.expr("substring(label, 2)")) & goes_on("pos")
    left_out = can_edit & ~reaches & letters("pos + 2").startswith(F.col("label")) & goes_on("pos + 1")

    def state(pos: Column, near: Column | None) -> Column:
        known = [F.col(c).alias(c) for c in ("s", "n", "back", "least")]
        edits = F.col("edits") if near is None else F.lit(1)
        near = F.col("near") if near is None else near
        rest = [pos.alias("pos"), F.col("child").alias("node"), F.col("child_hot").alias("hot"), edits.alias("edits"), near.alias("near")]
        return F.struct(*known, *rest, F.col("edge_n").alias("near_n"))

    head, tail = F.expr("substring(s, 1, pos)"), letters("pos + 2")
    made = [
        F.when(own, state(F.col("pos") + size, None)),
        F.when(replaced, state(F.col("pos") + size, F.concat(head, first, tail))),
        F.when(left_out, state(F.col("pos") + 1 + size, F.concat(head, tail))),
    ]
    return own | replaced | left_out, F.inline(F.array_compact(F.array(*made)))


def pairs(listed: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """All pairs of ``listed(word, n)`` that differ by one code point inserted, deleted or
    replaced, each once: ``word, n, near, near_n``. Words are distinct, without blanks and have
    ``least_chars`` code points or more.

    Rounds go on until no state is left: as many as a word has branches. A
    round is one join by node; the edges of hot nodes are few (see HOT_SHARE)
    and broadcast, so no task gets all states of a frequent beginning. The
    rest of the edges stay dealt out by node. Every round is written, so a lost
    executor costs no more than the round.
    """
    spark = listed.sparkSession
    sides = _sides(listed, least_chars)
    edges = kept(trie(sides, 2 * listed.count()).withColumnRenamed("n", "edge_n"), "spelling-trie")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = edges.where(~F.col("hot")).drop("hot").repartition(n_parts, "node").persist(StorageLevel.MEMORY_AND_DISK)
    hot = F.broadcast(edges.where("hot").drop("hot"))
    hot_roots = F.broadcast(edges.where("hot AND substring(node, 1, 1) IN ('<', '>')").select("node", "hot").distinct())
    fits, moves = _moves()
    states = sides.withColumnRenamed("root", "node").join(hot_roots, "node", "left").selectExpr(
        "s", "n", "back", "least", "length(node) - 1 AS pos", "node", "coalesce(hot, false) AS hot",
        "0 AS edits", "CAST(NULL AS STRING) AS near", "CAST(NULL AS BIGINT) AS near_n",
    )
    found = None
    while found is None or not states.isEmpty():
        split = [(states.where("hot"), hot), (states.where("NOT hot"), cold)]
        made = [part.drop("hot", "near_n").join(table, "node").where(fits).select(moves) for part, table in split]
        moved = kept(made[0].union(made[1]), "spelling-states")
        ends = moved.where("node IS NULL")
        found = ends if found is None else found.union(ends)
        states = moved.where("node IS NOT NULL")
    cold.unpersist()

    def word(c: str) -> Column:
        letters = F.rtrim(c)
        return F.when(F.col("back"), F.reverse(letters)).otherwise(letters)

    return found.select(word("s").alias("word"), "n", word("near").alias("near"), "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word reached. Every round doubles the steps;
    counts grow tenfold with each, so there are few."""
    jumps = forms.select("word", F.col("form").alias("root"))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = kept(jumps.join(further, "root", "left"), "spelling-roots")
        jumps = joined.select("word", F.coalesce("_next", "root").alias("root"))
        if joined.where("_next IS NOT NULL").isEmpty():
            return jumps


def variants(listed: DataFrame, least_chars: int = LEAST_CHARS, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``listed(word, n)``.

    The form is the most frequent near word (ties: smallest by code points),
    if it is at least ``ratio`` times as frequent, and the root the last form
    of the chain; a word without a form is its own root. No words, no rows.
    """
    found = kept(pairs(listed, least_chars), "spelling-pairs")
    back = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    near = found.unionByName(back).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    rows = kept(
        listed.join(near, "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast(LONG).alias("n_near"),
            F.when(enough, -F.col("best.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(rows.where("form IS NOT NULL"))
    with_root = rows.join(roots, "word", "left")
    return with_root.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of ``docs(doc_id, text)``; other columns do not matter."""
    return variants(kept(words(docs), "spelling-words"))
