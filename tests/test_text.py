import pytest
from pyspark.sql import functions as F

from voxstar.functions import text

PYTHON_SPACES = [c for c in range(0x10000) if chr(c).isspace()]


def value(spark, raw, expression):
    return spark.createDataFrame([(raw,)], "t string").select(expression(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw,expression,want", [
    ("don't @joe_b go", text.strip_mentions, "don  go"),
    ("a @[x]^_`\\ b", text.strip_mentions, "a  b"),  # the range A-z spans the marks between the cases
    ("see https://t.co/x y\nnext", text.strip_urls, "see \nnext"),
    ("http://a", text.strip_urls, ""),
    ("#tag @me", text.strip_sigils, "tag me"),
    ("a1#b22", text.strip_digits, "ab"),
    ("  one two\t three four\n", text.tokens, ["one", "two", "three", "four"]),
    ("", text.tokens, []),
    ("".join(f"w{chr(c)}" for c in PYTHON_SPACES), text.tokens, ["w"] * len(PYTHON_SPACES)),
    ("a\u200bb", text.tokens, ["a\u200bb"]),
])
def test_cleaning(spark, raw, expression, want):
    assert value(spark, raw, expression) == want


def test_code_points_keep_surrogate_pairs_whole(spark):
    assert sorted(value(spark, "ab 😀é😀 🙈", text.code_points)) == sorted(["😀", "é", "🙈"])


def test_unique_emojis_are_sorted_members(spark):
    assert value(spark, "🙈 x 😀 😀 ü", lambda c: text.unique_emojis(c, ["😀", "🙈", "🚀"])) == ["😀", "🙈"]


def test_drop_media_posts_and_nulls(frame, rows):
    df = frame("id int, t string", [(1, "Just posted a photo"), (2, "hello"), (3, None), (4, "I Just posted a video")])
    assert rows(text.drop_media_posts(df, "t")) == [(2, "hello")]
    assert rows(text.clean_tweets(frame("id int, t string", [(1, "a1 #b")]), "t", digits=True)) == [(1, "a b")]


def test_effective_text(frame, rows):
    df = frame("id int, ref string, t string, o string",
               [(1, "9", "RT a: x", "orig"), (2, "9", "own", "orig"), (3, None, "RT a: x", "orig"), (4, "9", "rt a", "orig")])
    shown = lambda flag: rows(df.select("id", text.effective_text(F.col("ref"), F.col("t"), F.col("o"), flag)))
    assert shown(False) == [(1, "orig"), (2, "own"), (3, "RT a: x"), (4, "rt a")]
    assert shown(True)[3] == (4, "orig")


def test_occurrence_count(spark):
    assert value(spark, "joy, fear, joy", lambda c: text.occurrence_count(c, "joy")) == 2
    assert value(spark, "a.b", lambda c: text.occurrence_count(c, ".")) == 1


def test_first_reference(spark):
    df = spark.sql("SELECT array(named_struct('type','x','id','7')) AS r UNION ALL SELECT array() UNION ALL SELECT null")
    assert sorted(str(r[0]) for r in df.select(text.first_reference(F.col("r"))).collect()) == ["7", "None", "None"]
