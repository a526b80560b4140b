"""P11-P13, F2, F3, A1-A3, A5, A6, A8, SRC8, SRC9 on literal rows."""

from conftest import rows
from pyspark.sql import functions as F

from logweave.functions import text as tx
from logweave.operators import textstats
from logweave.sources import streams


def test_java_split_semantics(spark):
    df = spark.createDataFrame([(1, ""), (2, "   "), (3, "a b  "), (4, "a  b"), (5, " a")], "id int, v string")
    got = dict(rows(df.select("id", tx.java_split_space("v").alias("w"))))
    assert got == {1: [""], 2: [], 3: ["a", "b"], 4: ["a", "", "b"], 5: ["", "a"]}


def test_clean_words(spark):
    text = "RT @Name: The #Tag is Cool!!  Café   ab abc http://x.com and we"
    df = spark.createDataFrame([(text,)], "t string")
    words = df.select(tx.clean_words("t").alias("w")).first()["w"]
    # '@name' '#tag' 'cool' 'caf' (accent dropped) 'abc' 'httpxcom'; stop words and <=2 chars removed
    assert words == ["@name", "#tag", "cool", "caf", "abc", "httpxcom"]


def test_word_counts_lowercase_after_split(spark):
    df = spark.createDataFrame([("Hello hello  World",), ("",), ("   ",)], "value string")
    got = dict(rows(textstats.word_counts(textstats.words(df))))
    assert got == {"hello": 2, "world": 1, "": 2}   # double space and the empty line give ''


def test_lines_of(spark):
    df = spark.createDataFrame([("a\nb\n",), ("",), ("c\r\nd",)], "text string")
    assert rows(textstats.lines_of(df)) == [("a",), ("b",), ("c",), ("d",)]


def test_lengths_utf16(spark):
    df = spark.createDataFrame([("a\U0001F600",), ("",)], "t string")
    got = rows(df.select(tx.char_length("t"), tx.utf16_length("t")))
    assert got == [(0, 0), (2, 3)]


def test_length_running(spark):
    df = spark.createDataFrame([(0, "aa"), (0, "bbb"), (2, "c"), (3, "dddddd")], "batch int, text string")
    got = rows(textstats.length_running(df, "batch"))
    # batch 0: 2 rows 5 chars avg 2 (5//2), max 3; batch 2: 3 rows 6 chars avg 2; batch 3: 4 rows 12 avg 3 max 6
    assert [(b, tr, tc, a, m) for b, _, _, tr, tc, a, m in got] == [(0, 2, 5, 2, 3), (2, 3, 6, 2, 3), (3, 4, 12, 3, 6)]


def test_take_batches_until(spark):
    data = [(b, i) for b, n in [(0, 600), (1, 400), (2, 1), (3, 5)] for i in range(n)]
    df = spark.createDataFrame(data, "batch int, i int")
    kept = {r[0] for r in textstats.take_batches_until(df, "batch", cap=1000).select("batch").distinct().collect()}
    assert kept == {0, 1, 2}      # 1000 is not past the cap, so batch 2 is still written; then stop
    kept2 = {r[0] for r in textstats.take_batches_until(df, "batch", cap=999).select("batch").distinct().collect()}
    assert kept2 == {0, 1}


def test_response_texts(spark):
    df = spark.createDataFrame([
        (1, '{"data": [{"text": "hi"}, {"id": 3}]}'),     # missing text -> ''
        (2, '{"meta": 1}'),                               # no data
        (3, "{not json"),                                 # invalid
        (4, '{"data": []}'),                              # empty list
    ], "id int, value string")
    assert rows(streams.response_texts(df, keep=["id"]).drop("item_pos")) == [(1, ""), (1, "hi")]


def test_labeled_points(spark):
    df = spark.createDataFrame([("(2,[100000.5,30])",), ("-1.5,1.4",), ("[1.0,2.0]",)], "v string")
    got = df.select(streams.parse_labeled_point("v").alias("p"), streams.parse_vector("v").alias("vec")).collect()
    assert (got[0]["p"]["label"], got[0]["p"]["features"]) == (2.0, [100000.5, 30.0])
    assert (got[1]["p"]["label"], got[1]["p"]["features"]) == (-1.5, [1.4])
    assert got[2]["vec"] == [1.0, 2.0]


def test_top_words_ties(spark):
    df = spark.createDataFrame([("s", w) for w in ["bb", "aa", "cc", "aa", "bb"]], "g string, word string")
    got = rows(textstats.top_words(df, "g", 2))
    assert got == [("s", "aa", 2, 1), ("s", "bb", 2, 2)]


def test_line_count(spark):
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    assert textstats.line_count(df).first()[0] == 2
    assert F is not None
