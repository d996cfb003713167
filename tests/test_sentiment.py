import pytest
from pyspark.sql import functions as F

from voxstar import seeds
from voxstar.functions import sentiment
from voxstar.plans import words
from voxstar.plans.events import emotion_sums_by_event

LEXICON = [("love", "joy", 1), ("love", "positive", 1), ("fear", "fear", 1), ("dull", "joy", 0)]


@pytest.mark.parametrize("joined,want", [
    ("joy, fear", 9), ("joy, joy, fear", 1), ("anger", 0), ("unknown", 9), ("positive, negative, trust", 1)])
def test_vote_from_string(spark, joined, want):
    df = spark.createDataFrame([(joined,)], "e string")
    assert df.select(sentiment.vote_from_string(F.col("e"))).first()[0] == want


def test_vote_other_neutral_code(spark):
    df = spark.createDataFrame([("joy, fear",)], "e string")
    assert df.select(sentiment.vote_from_string(F.col("e"), 999)).first()[0] == 999


def test_itemset_sentiment_has_no_neutral(spark):
    df = spark.createDataFrame([(["joy", "fear"],), (["joy", "trust", "fear"],)], "e array<string>")
    assert [r[0] for r in df.select(sentiment.itemset_sentiment(F.col("e"))).collect()] == ["negative", "positive"]


def test_emotion_lists(frame, rows):
    tweets = frame("tweet_id string, tweet_text string",
                   [("1", "love love fear"), ("2", "Love dull none"), ("3", "fear it's @love fear")])
    lexicon = frame("term string, emotion string, association int", LEXICON)
    assoc = words.word_association(tweets, lexicon)
    assert rows(assoc) == sorted([("1", "love", "joy"), ("1", "love", "joy"), ("1", "love", "positive"),
                                  ("1", "love", "positive"), ("1", "fear", "fear"), ("3", "fear", "fear"),
                                  ("3", "fear", "fear")], key=repr)
    assert rows(words.tweet_emotions_all(assoc)) == [("1", "fear, joy, joy, positive, positive"), ("3", "fear, fear")]
    assert rows(words.emotion_distinct_sets(assoc)) == [("1", "fear, joy, positive"), ("3", "fear")]
    assert rows(words.sentiment_vote(assoc)) == [("1", 1), ("3", 0)]
    assert rows(words.vote_texts(tweets, lexicon)) == [("1", 1), ("3", 0)]
    assert rows(words.emotion_counts(tweets, lexicon)) == [("1", "fear", 1), ("1", "joy", 2), ("1", "positive", 2), ("3", "fear", 2)]


def test_options_of_word_association(frame, rows):
    tweets = frame("tweet_id string, tweet_text string", [("1", "LOVE! https://x love"), ("2", "fear.")])
    lexicon = frame("term string, emotion string, association int", LEXICON)
    assert rows(words.word_association(tweets, lexicon).select("tweet_id", "emotion")) == [("1", "joy"), ("1", "positive")]
    assert rows(words.word_association(tweets, lexicon, urls=True)) == []
    both = words.word_association(tweets, lexicon, urls=True, normalise=True)
    assert rows(both.select("tweet_id", "emotion")) == [("1", "joy"), ("1", "positive"), ("2", "fear")]


def test_polarity_covers_all_emotions(spark, rows):
    marks = dict((e, m) for e, _, m in rows(seeds.emotion_polarity(spark)))
    assert sorted(marks) == seeds.EMOTIONS
    assert marks["joy"] == 333 and marks["negative"] == 666


def test_emotion_sums_cover_events_and_emotions(frame, rows):
    """Every event has its row of zeros, and an emotion that nobody listed keeps its counts."""
    shown = frame("tweet_id string, emotion string", [("1", "joy"), ("1", "joy"), ("1", "awe"), ("2", "fear"), ("2", None)])
    facts = frame("tweet_id string, search_id bigint", [("1", 1), ("1", 2), ("2", 1)])
    searches = frame("search_id bigint, event_id int", [(1, 10), (2, 10), (3, 11)])
    events = frame("event_id int, event_name string", [(10, "A"), (11, "B"), (12, "C")])
    got = emotion_sums_by_event(shown, facts, searches, events, ["fear", "joy"])
    assert rows(got, "event", "emotion", "sum") == [
        ("A", "awe", 2), ("A", "fear", 1), ("A", "joy", 2), ("B", "fear", 0), ("B", "joy", 0), ("C", "fear", 0), ("C", "joy", 0)]
