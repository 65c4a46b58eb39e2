"""Rows of a key read in order, with a state that no window frame expresses."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

SENTENCE = re.compile(r"[^.!?]+[.!?]*")


class PackSentences:
    """Packs the sentences of a key's texts, in order, into blocks of at most ``most`` words.

    A block is closed when the next sentence does not fit; a sentence is never
    cut, so a longer one is a block of its own. Where a block ends depends on
    where all blocks before it ended, which takes a state per key. Blocks go
    across rows, and a row may end up in many blocks.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, text: AnalyzeArgument, most: AnalyzeArgument) -> AnalyzeResult:
        schema = StructType().add(key.value, rows.dataType[key.value].dataType).add("block", IntegerType())
        for name in ("first", "last"):
            schema = schema.add(name, rows.dataType[order.value].dataType)
        schema = schema.add("sentences", IntegerType()).add("words", LongType())
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(order.value)])

    def __init__(self) -> None:
        self.block, self.key, self.open = 0, None, None

    def eval(self, row, key: str, order: str, text: str, most: int) -> Iterator[tuple]:
        self.key = row[key]
        for sentence in SENTENCE.findall(row[text] or ""):
            n = len(sentence.split())
            if not n:
                continue
            if self.open and self.open[3] + n > most:
                yield self._close()
            if self.open is None:
                self.open = [row[order], row[order], 0, 0]
            self.open[1] = row[order]
            self.open[2] += 1
            self.open[3] += n

    def _close(self) -> tuple:
        done, self.open = (self.key, self.block, *self.open), None
        self.block += 1
        return done

    def terminate(self) -> Iterator[tuple]:
        if self.open:
            yield self._close()


def pack_sentences(df: DataFrame, key: str, order: str, text: str = "text", most: int = 40) -> DataFrame:
    """``key, block, first, last, sentences, words``: see ``PackSentences``. The rows of a key pass
    through one task in order, one at a time."""
    spark = df.sparkSession
    spark.udtf.register("pack_sentences", F.udtf(PackSentences, useArrow=True))
    rows = df.select(key, order, text)
    return spark.sql(
        f"SELECT * FROM pack_sentences(TABLE({{rows}}), '{key}', '{order}', '{text}', {int(most)})", rows=rows
    )
