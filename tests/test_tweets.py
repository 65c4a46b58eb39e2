import json

from pyspark.sql import functions as F

from scenetext.operators import text as X
from scenetext.operators import tweets as TW

TWEET = {
    "text": "hi",
    "lang": "nl",
    "user": {"screen_name": "u1", "name": "U", "followers_count": 3, "description": None},
    "entities": {"hashtags": [{"text": "a"}, {"text": "b"}]},
    "ignored": {"x": 1},
}


def lines(spark, tmp_path):
    """The lines as a file: a message, an empty line, a broken one, one without user."""
    short = {k: v for k, v in TWEET.items() if k != "user"}
    text = "\n".join([json.dumps(TWEET), "", '{"lang": "nl", "te', json.dumps(short)])
    (tmp_path / "tweets.json").write_text(text + "\n")
    return spark.read.text(str(tmp_path / "tweets.json"))


def test_empty_lines_are_dropped(spark, tmp_path):
    read = lines(spark, tmp_path)
    assert read.count() == 4 and X.nonempty_lines(read).count() == 3


def test_fields(spark, tmp_path):
    got = TW.tweet_fields(X.nonempty_lines(lines(spark, tmp_path)), report=True).collect()
    good = [r for r in got if r["name"]][0]
    assert [h["text"] for h in good["hashtags"]] == ["a", "b"]
    assert (good["lang"], good["screen_name"], good["followers_count"]) == ("nl", "u1", 3)
    broken = [r for r in got if r["_corrupt_record"]]
    assert len(broken) == 1 and broken[0]["hashtags"] is None
    no_user = [r for r in got if not r["name"] and not r["_corrupt_record"]][0]
    assert no_user["lang"] == "nl" and no_user["followers_count"] is None


def test_text(spark, tmp_path, rows):
    got = TW.tweet_text(X.nonempty_lines(lines(spark, tmp_path)))
    assert rows(got) == [("hi",), ("hi",), (None,)]


DOCUMENTS = [
    TWEET,
    {"zzz": [1, 2.5, {"y": True, "x": None}, []], "id": 10**17, "Aa": {"b": {}, "a": "\u00e9 \U0001f600 \"q\" \n"}, "a": -0.25},
    [],
    {"": {"a b": [[["deep"]]]}},
    "text",
    None,
]


def test_whole_documents_print_as_python_prints_them(spark):
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(DOCUMENTS)], "k INT, value STRING")
    read = TW.documents(df)
    assert read.columns == ["doc", "broken"] and read.where("broken IS NOT NULL").isEmpty()
    for ascii_only in (True, False):
        got = read.select(TW.pretty_json(F.col("doc"), ascii_only=ascii_only)).collect()
        want = [json.dumps(d, indent=2, sort_keys=True, ensure_ascii=ascii_only) for d in DOCUMENTS]
        assert [r[0] for r in got] == want
    compact = read.select(TW.sorted_json(F.col("doc"))).first()[0]
    assert json.loads(compact) == TWEET and compact.index('"entities"') < compact.index('"ignored"') < compact.index('"lang"')


def test_broken_lines_are_reported(spark):
    lines = ['{"a": 1', "", "junk", '{"a": 1, "a": 2}', '{"a": 1}']
    got = TW.documents(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    assert [r["broken"] for r in got.collect()] == [*lines[:4], None]
    assert [r[0] for r in got.select(TW.pretty_json(F.col("doc"))).collect()] == [None] * 4 + ['{\n  "a": 1\n}']


def test_json_numbers(spark, rows):
    df = spark.createDataFrame([(1, '{"k": 7}'), (2, "{}"), (3, "junk")], "id INT, props STRING")
    assert rows(TW.json_numbers(df, "props", "k")) == [(1, 7), (2, None), (3, None)]
