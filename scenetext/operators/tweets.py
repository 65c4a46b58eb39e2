"""Messages as JSON lines: parse, pick fields, tokenize."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetext.functions.words import SPACES, tokens
from scenetext.operators.text import first, first_texts

# Only the fields the operators pick: from_json skips everything else in a record.
FIELDS = (
    "lang STRING, "
    "entities STRUCT<hashtags: ARRAY<STRUCT<text: STRING>>>, "
    "user STRUCT<name: STRING, screen_name: STRING, followers_count: BIGINT, description: STRING>"
)
TEXT = "text STRING"
CORRUPT = "_corrupt_record"


def parse(lines: DataFrame, schema: str, line: str = "value", report: bool = False) -> DataFrame:
    """One struct ``j`` per line. A missing field is NULL, and so is every field
    of a broken line; ``report`` adds the text of broken lines as
    ``_corrupt_record`` (and makes Spark parse the full schema)."""
    if not report:
        return lines.select(F.from_json(line, schema).alias("j"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(F.from_json(line, f"{schema}, {CORRUPT} STRING", options).alias("j"))


def tweet_fields(lines: DataFrame, line: str = "value", report: bool = False) -> DataFrame:
    """Language, hashtags and author of every message."""
    picked = [
        "j.lang",
        "j.entities.hashtags",
        "j.user.name",
        "j.user.screen_name",
        "j.user.followers_count",
        "j.user.description",
    ]
    if report:
        picked.append(f"j.{CORRUPT}")
    return parse(lines, FIELDS, line, report).select(*picked)


def tweet_text(lines: DataFrame, line: str = "value") -> DataFrame:
    return parse(lines, TEXT, line).select("j.text")


def documents(lines: DataFrame, line: str = "value") -> DataFrame:
    """Whole documents: ``doc VARIANT`` holds every field of a line, whatever its shape, and
    ``broken`` the text of a line that is no JSON document, or has a key twice; one of the two is NULL."""
    doc = F.try_parse_json(line)
    broken = F.when(doc.isNull(), F.col(line))
    return lines.select(doc.alias("doc"), broken.alias("broken"))


def sorted_json(doc: Column) -> Column:
    """A document on one line, keys sorted at every level, as its variant keeps them."""
    return F.when(F.is_variant_null(doc), "null").otherwise(F.to_json(doc))


def pretty_json(doc: Column, indent: int = 2, ascii_only: bool = True) -> Column:
    """A document over several lines, keys sorted at every level. Only the layout is made in
    Python, from the sorted text, batch by batch."""

    @F.arrow_udf("string")
    def layout(texts: pa.Array) -> pa.Array:
        def spread(text: str) -> str:
            return json.dumps(json.loads(text), indent=indent, ensure_ascii=ascii_only)

        return pa.array([t if t is None else spread(t) for t in texts.to_pylist()], pa.string())

    return layout(sorted_json(doc))


def tweet_tokens(df: DataFrame, keys: Sequence[str] = (), text: str = "text") -> DataFrame:
    """One row ``tok`` per token; with ``keys``, also those and the position ``pos``."""
    split = tokens(F.col(text))
    if keys:
        return df.select(*keys, F.posexplode(split).alias("pos", "tok"))
    return df.select(F.explode(split).alias("tok"))


def first_tokens(df: DataFrame, k: int, key: str, text: str = "text") -> DataFrame:
    """The first ``k`` tokens of all texts in order of the unique ``key``."""
    head = first_texts(df, k, key, text, SPACES)
    return first(tweet_tokens(head, [key], text), k, key, "pos")


def json_numbers(df: DataFrame, column: str, *names: str) -> DataFrame:
    """Named whole-number fields of a JSON object as BIGINT columns in its place."""
    schema = ", ".join(f"`{n}` BIGINT" for n in names)
    parsed = df.withColumn("_j", F.from_json(column, schema))
    return parsed.select(*[c for c in df.columns if c != column], "_j.*")
