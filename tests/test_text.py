import pytest
from pyspark.sql import functions as F

from scenetext.functions import words as W
from scenetext.operators import text as X
from scenetext.operators import tweets as TW

WORDS = ["oak", "elm", "willow", "larch", "chestnut", "yew", "hazel"]

# Fixed value: Shakespeare, sonnet 1.
SONNET = """From fairest creatures we desire increase, That thereby beauty's rose might never die,
But as the riper should by time decease, His tender heir might bear his memory:
But thou contracted to thine own bright eyes, Feed'st thy light's flame with self-substantial fuel,
Making a famine where abundance lies, Thy self thy foe, to thy sweet self too cruel:
Thou that art now the world's fresh ornament, And only herald to the gaudy spring,
Within thine own bud buriest thy content, And, tender churl, mak'st waste in niggarding:
Pity the world, or else this glutton be, To eat the world's due, by the grave and thee."""


def words(spark):
    return spark.createDataFrame([(w,) for w in WORDS], "w STRING")


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id INT, text STRING")


def test_words(spark, rows):
    df = words(spark)
    assert X.total(df).first()["n"] == 7
    assert X.total(X.longer_than(df, 3)).first()["n"] == 4
    assert rows(X.plural(df), "plural") == sorted((w + "s",) for w in WORDS)
    lengths = {r["w"]: r["n"] for r in X.with_length(df).collect()}
    assert [lengths[w] for w in WORDS] == [3, 3, 6, 5, 8, 3, 5]


def test_sentences(spark, rows):
    df = texts(spark, "rain fell all night", "by noon the river had risen again")
    split = X.sentence_words(df)
    assert split.count() == 2
    assert split.orderBy("id").first()["words"] == ["rain", "fell", "all", "night"]
    assert X.words_flat(df).count() == 11


def test_split_follows_python_white_space(spark):
    odd = "a b c\x1cd\u0085e \t\n f​g　"
    got = X.sentence_words(texts(spark, odd, "", "   ")).orderBy("id").collect()
    assert [r["words"] for r in got] == [odd.split(), [], []]


def test_every_space_character_is_listed():
    assert set(W.SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_punctuation(spark):
    df = texts(spark, "string. With. Punctuation?", W.PUNCTUATION)
    got = [r["text"] for r in X.strip_punctuation(df).orderBy("id").collect()]
    assert got == ["string With Punctuation", ""]


def test_sonnet(spark, rows):
    found = X.words(texts(spark, SONNET))
    counts = X.count_by_key(found, "w")
    assert found.count() == 106 and counts.count() == 81
    top = [(r["w"], r["n"]) for r in X.top(counts, 10, "n", "w").collect()]
    assert top[:4] == [("the", 6), ("thy", 5), ("to", 4), ("and", 3)]
    assert top[4:] == [(w, 2) for w in ("but", "by", "his", "might", "own", "self")]
    summed = X.reduce_by_key(found.withColumn("n", F.lit(1)), "w")
    assert rows(summed) == rows(counts)


def test_words_equal_python(spark):
    table = str.maketrans("", "", W.PUNCTUATION)
    found = X.words_in_order(texts(spark, SONNET), ["id"]).orderBy("pos")
    assert [r["w"] for r in found.collect()] == SONNET.translate(table).lower().split()


def test_first_words_skip_texts_without_any(spark):
    df = texts(spark, " ", "...", "a b", "c", "d")
    assert [r["w"] for r in X.first_words(df, 3, "id").collect()] == ["a", "b", "c"]


def test_characters_are_code_points(spark, rows):
    got = X.count_by_key(X.characters(texts(spark, "aé😀a", "")), "c")
    assert rows(got) == sorted([("a", 2), ("é", 1), ("😀", 1)], key=repr)


# One line per form: a text and its tokens.
FORMS = [
    ("waiting for the traaain #monday: :-) :-P <3 -> <--", "waiting|for|the|traaain|#monday|:|:-)|:-P|<3|->|<--"),
    ("@user see https://a.example/x?y=1, (http://b.example/p_(q)) me@b.example", "@user|see|https://a.example/x?y=1|,|(|http://b.example/p_(q)|)|me@b.example"),
    ("www.example.com/a and example.org. Or b.example.net/", "www.example.com/a|and|example.org|.|Or|b.example.net/"),
    ("first.last@mail.example.org wrote", "first.last@mail.example.org|wrote"),
    ("call 555-123-4567 or (555) 123-4567, +1 555 123 4567, 1234567", "call|555-123-4567|or|(555) 123-4567|,|+1 555 123 4567|,|1234567"),
    ("<b>bold</b> <br/> a < b > c", "<b>|bold|</b>|<br/>|a|<|b|>|c"),
    ("Q&amp;A &lt;tag&gt; caf&eacute; &#233;&#xE9; &#128; &nothing; & ;", "Q|&|A|<tag>|café|éé|€|&|;"),
    ("&amp;lt; stays", "&|lt|;|stays"),
    ("wow!!!!!! no......", "wow|!|!|!|no|..."),
    ("#well-known #a-b #x @a_b", "#well-known|#a-b|#|x|@a_b"),
    ("don't re-do 3/4 -2.5 1,000 . . . x", "don't|re-do|3/4|-2.5|1,000|. . .|x"),
    ("", ""),
    ("  \n ", ""),
]


@pytest.mark.parametrize(("text", "want"), FORMS)
def test_token_forms(spark, text, want):
    got = TW.tweet_tokens(texts(spark, text), ["id"]).orderBy("pos").collect()
    assert [r["tok"] for r in got] == [t for t in want.split("|") if t]


def test_very_long_tokens_need_no_deep_stack(spark):
    for text in ("z" * 100_000, "#" + "a" * 100_000, ". " * 50_000, "http://a.example/" + "x(y)" * 20_000, "a.b-" * 20_000, "@" * 50_000):
        assert TW.tweet_tokens(texts(spark, text)).count() > 0


def test_every_named_reference(spark):
    text = "".join(f"&{name};" for name in W.NAMED) + "&#0;&#55296;&#1114112;&#1114111;&#65;&#x1F600;&amp"
    got = texts(spark, text).select(W.decode_references(F.col("text")).alias("t")).first()["t"]
    assert got == "".join(W.NAMED.values()) + "\U0010ffffA😀&amp"


def test_frequent_values_equal_the_ranking_of_all(spark, rows):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") * F.col("id")) % 977))
    df = spark.range(30_000).select(key.alias("w"))
    want = rows(X.top(X.count_by_key(df, "w"), 7, "n", "w"))
    found = X.frequent(df, "w", 7)
    assert rows(found) == want
    # proven: only candidates are counted, behind a join with them
    assert "BroadcastHashJoin" in found._jdf.queryExecution().analyzed().toString() or "Join" in found._jdf.queryExecution().analyzed().toString()
    # too small a sketch proves nothing, so all is counted
    small = X.frequent(df, "w", 7, tracked=16)
    assert rows(small) == want and "Join" not in small._jdf.queryExecution().analyzed().toString()
    even = spark.range(2_000).select(F.col("id").cast("string").alias("w"))
    assert rows(X.frequent(even, "w", 3)) == rows(X.top(X.count_by_key(even, "w"), 3, "n", "w"))
    assert rows(X.frequent(df.limit(0), "w", 3)) == []


def test_token_counts_sum_to_tokens(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toks = TW.tweet_tokens(docs)
    assert X.count_by_key(toks, "tok").agg(F.sum("n")).first()[0] == toks.count()


def test_top_words_are_counted_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = X.count_by_key(X.words(docs), "w")
    assert X.top(counts, 10, "n", "w").exceptAll(counts).count() == 0
