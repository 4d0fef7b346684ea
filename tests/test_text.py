"""Cleaning, terms and sentiment against plainer forms."""

import random

from conftest import rows
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from colloquy.functions.text import clean_text, clean_word_count, english_stop_words, explode_tokens, tokens_of
from colloquy.operators import terms
from colloquy.operators.sentiment import comment_sentiment, lexicon_flags, sentiment_by
from colloquy.schema import NEGATIVE_WORDS, POSITIVE_WORDS
from tests.test_plan_shape import plan


def stepwise(body):
    text = F.lower(body)
    for pattern in (r"http\S+", r"www\.\S+", r"[^a-z0-9\s]", r"\s+"):
        text = F.regexp_replace(text, pattern, " ")
    return F.trim(text)


def frame(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "id long, body string")


def test_one_pass_cleaning_equals_the_steps(spark):
    pieces = ["http", "http://", "https://", "www.", "www", "WWW.", "a", "b1", ".", "/", " ", "\n", "\t", "\x0b",
              " ", "Ä", "ß", "İ", "K", "é", "'", "漢", "😀", "h", "tt", "p", "xhttpx", "ww"]
    rng = random.Random(7)
    bodies = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(20_000)]
    df = frame(spark, bodies)
    differing = df.filter(~clean_text("body").eqNullSafe(stepwise(F.col("body"))))
    assert differing.take(3) == []


def test_cleaning_examples(spark):
    cases = {
        "see http://a.b/c?d now": "see now",
        "www.x.org": "",
        "end http": "end http",
        "www. gap": "www gap",
        "www.http://x y": "www y",
        "Don't STOP": "don t stop",
        "Grüße 42": "gr e 42",
        None: None,
    }
    got = {r.body: r.c for r in frame(spark, cases).select("body", clean_text("body").alias("c")).collect()}
    assert got == cases


def test_long_runs_do_not_exhaust_the_stack(spark):
    n = 2_000_000
    bodies = ["漢" * n, " " * n, "www." + "a." * n, "http://a " * (n // 10), "x" * n, "www.a " * (n // 10)]
    got = [r.n for r in frame(spark, bodies).select("id", F.length(clean_text("body")).alias("n")).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, n, 0]


def test_whole_texts_are_counted(spark):
    df = frame(spark, ["word " * 300_000]).withColumn("body_clean", clean_text("body"))
    assert df.select(clean_word_count("body_clean")).first()[0] == 300_000
    assert explode_tokens(df, ["id"]).count() == 300_000


def test_clean_word_count_of_nothing_is_zero(spark):
    df = frame(spark, ["", "!!", "a b"]).select("id", clean_word_count(clean_text("body")).alias("n"))
    assert rows(df) == [(0, 0), (1, 0), (2, 2)]


def text_base(spark, sf_dir):
    from checks.registry import text_base as build

    return build(spark, sf_dir)


def mllib_tokens(df):
    split = df.withColumn("all", F.split("body_clean", r"\s+"))
    kept = StopWordsRemover(inputCol="all", outputCol="kept").transform(split)
    exploded = kept.select("id", F.explode("kept").alias("token"))
    return exploded.filter((F.length("token") >= 3) & ~F.col("token").rlike(r"^\d+$"))


def test_terms_equal_the_stop_word_transformer(spark, sf_dir):
    base = text_base(spark, sf_dir).select("id", "body_clean")
    mine = explode_tokens(base, ["id"]).groupBy("id", "token").count()
    theirs = mllib_tokens(base).groupBy("id", "token").count()
    assert mine.exceptAll(theirs).isEmpty() and theirs.exceptAll(mine).isEmpty()


def test_token_array_equals_token_rows(spark, sf_dir):
    base = text_base(spark, sf_dir).select("id", "body_clean")
    arrays = base.select("id", F.explode(tokens_of("body_clean")).alias("token")).groupBy("id", "token").count()
    terms = explode_tokens(base, ["id"]).groupBy("id", "token").count()
    assert arrays.exceptAll(terms).isEmpty() and terms.exceptAll(arrays).isEmpty()


KEYS = ["id", "g"]


def sentiment_frame(spark):
    data = [
        (1, "x", "good good war and 123"),
        (2, "x", "the of and 42 no"),  # no term survives
        (3, "y", "peace love lies table"),
        (4, "y", ""),
        (5, "y", "table chair"),
    ]
    return spark.createDataFrame(data, "id long, g string, body_clean string")


def test_sentiment(spark):
    got = {r.id: tuple(r)[2:] for r in comment_sentiment(sentiment_frame(spark), KEYS).collect()}
    assert got == {1: (2, 1, 3, 1, 0.3333), 3: (2, 1, 4, 1, 0.25), 5: (0, 0, 2, 0, 0.0)}
    summary = {r.g: tuple(r)[1:] for r in sentiment_by(comment_sentiment(sentiment_frame(spark), KEYS), "g").collect()}
    assert summary == {"x": (1, 2.0, 1.0, 1.0, 0.3333), "y": (2, 1.0, 0.5, 0.5, 0.125)}


def test_sentiment_equals_the_grouped_token_rows(spark, sf_dir):
    base = text_base(spark, sf_dir).select("id", F.col("subreddit").alias("g"), "body_clean")
    flagged = lexicon_flags(explode_tokens(base, KEYS))
    plain = flagged.groupBy(*KEYS).agg(
        F.sum("is_positive_token").alias("p"), F.sum("is_negative_token").alias("n"), F.count("*").alias("t")
    )
    mine = comment_sentiment(base, KEYS).select(*KEYS, "positive_token_count", "negative_token_count", "token_count")
    assert mine.count() == plain.count() > 700
    assert mine.exceptAll(plain).isEmpty()


def test_repeated_comments_merge_on_request(spark):
    df = sentiment_frame(spark).filter("id = 1")
    twice = df.unionAll(df)
    assert comment_sentiment(twice, KEYS).count() == 2
    merged = comment_sentiment(twice, KEYS, merge_repeats=True).collect()
    assert [tuple(r)[2:] for r in merged] == [(4, 2, 6, 2, 0.3333)]


def test_lexicon_words_that_are_stop_words_do_not_count(spark):
    df = spark.createDataFrame([(1, "x", "no good")], "id long, g string, body_clean string")
    row = comment_sentiment(df, KEYS, negative=("no", "bad")).first()
    assert (row.positive_token_count, row.negative_token_count, row.token_count) == (1, 0, 1)


def test_fixed_lists(spark):
    assert (len(POSITIVE_WORDS), len(NEGATIVE_WORDS), len(english_stop_words())) == (16, 23, 181)


def test_links_and_numbers_are_looked_for_where_they_can_be(spark):
    """The pattern for links costs twice the plain one; few tokens need a pattern to be told from numbers."""
    df = frame(spark, ["see http://a b", "12 4x x4", "plain"])
    text = plan(df.select(clean_text("body").alias("body_clean")))
    assert "CASE WHEN (Contains(lower(body" in text and "ELSE [^a-z0-9]++ END" in text
    assert ">= :)" in plan(explode_tokens(df.withColumnRenamed("body", "body_clean"), []))
    tokens = df.select(F.explode(tokens_of(F.lit("123 12a a12 :12 ٣٣٣ 1234"), [])).alias("t")).distinct()
    assert rows(tokens) == [("12a",), (":12",), ("a12",), ("٣٣٣",)]


def test_terms_counted_from_pieces_equal_those_of_whole_texts(spark):
    pieces = ["http", "http://a.b/c", "https://", "www.", "WWW.X.org", "Word", "word", "word,", "don't", "THE", "the", "x1", "123", "1234a",
              " ", " ", " ", "\n", "\n\n", "\t", "\r\n", "\x0b", "Grüße", "ß", "İstanbul", "\u212aelvin", "ΣΑΣ", "漢字" * 9, "😀", "ht", "tp",
              "abcdefgh" * 5, "a,b,word;cde/fgh-ijk" * 3, "www.http://x", "end-http"]
    rng = random.Random(11)
    data = [(rng.choice(["a", "b", "c", None]), rng.randint(0, 60), "".join(rng.choices(pieces, k=rng.randint(0, 20)))) for _ in range(4_000)]
    data += [("a", 1, None), ("only", 1, "   "), (None, None, "")]
    df = spark.createDataFrame(data, "g string, many int, body string")
    whole = df.withColumn("body_clean", clean_text("body"))
    few, many = terms.few_groups(df, "g"), terms.few_groups(df, "many")
    assert set(few) == {"a", "b", "c", "only", None} and many is None
    for dim, groups in (("g", few), ("g", None), ("many", many)):
        assert rows(terms.counted_terms(df, dim, groups)) == rows(terms.term_counts(explode_tokens(whole, [dim]), [dim]))
    assert rows(terms.counted_terms(df)) == rows(terms.term_counts(explode_tokens(whole, []), []))
    nothing = df.limit(0)
    assert terms.counted_terms(nothing, "g", terms.few_groups(nothing, "g")).collect() == []
