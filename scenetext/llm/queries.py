"""The training-data operators as named queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetext.llm import byte_pairs, decontaminate, mixing, near_duplicates, oracle, phrases, pii, quality, repeated_text, secrets, spelling, token_files, toxicity, urls
from scenetext.llm.common import LONG, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id", "size", F.col("source_size").cast(LONG).alias("source_size"), "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query
def op6_quality(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents"))


# The rules every url query starts from.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@query
def op9_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fixed = spark.createDataFrame(list(URL_RULES), "key string, action string")
    listed = urls.tracking_hosts(pages).select("key", F.lit("block").alias("action"))
    return urls.judge(pages, fixed.union(listed))


@query
def op7_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op1_personal_data(spark, sf_dir):
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op5_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items)


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark, sf_dir):
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


@query
def op10_repeated_text(spark, sf_dir):
    return repeated_text.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.group(table(spark, sf_dir, "documents"))


@query
def op13_byte_pairs(spark, sf_dir):
    path = public_tokenizers.path(byte_pairs.RANKS)
    return byte_pairs.digest(byte_pairs.decode(byte_pairs.encode(table(spark, sf_dir, "documents"), path), path))


ORACLE: dict[str, str] = {
    "op2_mixing": oracle.MIXING,
    "op8_near_duplicates": oracle.NEAR_DUPLICATES,
    "op9_url_filters": oracle.url_filters(URL_RULES),
    "op11_collocations": oracle.COLLOCATIONS,
    "op12_spelling_variants": oracle.SPELLING,
}
