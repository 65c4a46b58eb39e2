"""The training corpus in five stages: toxicity, near duplicates, decontamination, mixing, token files.

Rows travel through a stage as one struct beside the columns it reads, so
columns of any other name come back as they were, whatever a stage calls its
own. In every stage a null text is an empty one, a null doc_id a document like
any other (never a copy of another one, as it has no place among them), a
repeated row counts as often as it occurs, and no documents give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.llm import decontaminate, mixing, near_duplicates, token_files, toxicity
from scenetext.llm.common import kept, table


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns a stage reads, and the whole row as ``row``."""
    return docs.select(*columns, F.struct("*").alias("row"))


def toxic_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 stay; the field is fitted to the labelled ones. Each row is
    judged on its own; without toxic labels all stay, without clean ones none."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, tuple(docs.columns)).where(F.col("score") < 0.5).select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more) the smallest doc_id stays, with
    all its rows; texts without words and null doc_ids are linked with nothing."""
    return near_duplicates.dedup(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go, every repeated row of them; without a benchmark all stay."""
    return decontaminate.clean(_packed(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark")).select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; a null source is one of its own. Which of several equal rows
    is taken once more does not matter."""
    return mixing.emit(mixing.mix(_packed(docs, "doc_id", "source", "text"))).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as wavelet matrix files; a row per document, read from them. Equal doc_ids follow one
    another in order of their text, null ones come first; a text without tokens has the end id."""
    return token_files.round_trip(docs)


STAGES = [
    ("toxicity", toxic_text),
    ("near_duplicates", near_duplicate_groups),
    ("decontamination", benchmark_overlap),
    ("mixing", source_mix),
    ("token_files", token_output),
]

# Neither the field nor the tokenizer can be written in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
