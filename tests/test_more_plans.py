"""Variants of payloads, one evaluation, trees of any depth, terms of several words, the cube of totals."""

import pytest
from pyspark.sql import functions as F

from voxstar.operators.quality import split_valid
from voxstar.plans.associations import phrase_associations, phrase_matches
from voxstar.plans.events import sentiment_cube
from voxstar.plans.geo import hierarchy_paths
from voxstar.sources.payloads import parse_payloads, quarantine, undeclared_fields, variant_payloads


# --- one evaluation

@pytest.fixture
def counted(spark):
    """counted(frame) -> (the frame with a column that counts its evaluated rows, the counter)"""

    def make(frame):
        seen = spark.sparkContext.accumulator(0)

        @F.pandas_udf("long")
        def one(x):
            seen.add(len(x))
            return x * 0 + 1

        return frame.withColumn("one", one(F.lit(1).cast("long") + F.monotonically_increasing_id() * 0)), seen

    return make


def test_split_evaluates_its_input_once(spark, counted, rows):
    frame, seen = counted(spark.range(1000))
    good, bad = split_valid(frame, {"odd": F.col("id") % 2 == 1, "large": F.col("id") > 900})
    assert good.count() == 451 and bad.count() == 549
    assert rows(bad.groupBy("reject_reason").count()) == [("large", 49), ("odd", 500)]
    assert good.columns == ["id", "one"] and bad.columns == ["id", "one", "reject_reason"]
    assert seen.value == 1000


def test_quarantine_evaluates_its_input_once(frame, counted, rows):
    raw, seen = counted(frame("filepath string, value string", [("a", '{"data":[{"id":"1"}]}'), ("b", '{"data":[{"id'), ("c", None)]))
    good, bad = quarantine(parse_payloads(raw.withColumn("value", F.when(F.col("one") == 1, F.col("value")))))
    assert rows(good, "filepath") == [("a",), ("c",)] and rows(bad) == [("b", '{"data":[{"id')]
    assert seen.value == 3


# --- variants

def test_variant_status_and_undeclared_fields(frame, rows):
    raw = frame("filepath string, value string", [
        ("ok", '{"data":[{"id":"1","text":"t","geo":{"place":["x",1]},"score":1.5},{"id":"2"}],"meta":{}}'), ("none", '{"meta":{"result_count":0}}'),
        ("cut", '{"data":[{"id":"3"'), ("list", "[1,2]"), ("number", "7"), ("no id", '{"data":[{"text":"x"}]}'), ("scalar data", '{"data":5}'),
        ("empty", ""), ("null", None), ("empty data", '{"data":[]}')])
    parsed = variant_payloads(raw)
    assert dict(rows(parsed, "filepath", "status")) == {
        "ok": "payload", "none": "payload", "empty data": "payload", "cut": "not json", "empty": "not json", "null": "not json",
        "list": "other shape", "number": "other shape", "no id": "other shape", "scalar data": "other shape"}
    assert rows(undeclared_fields(parsed)) == [("ok", 0, "1", "geo", '{"place":["x",1]}'), ("ok", 0, "1", "score", "1.5")]


# --- trees

def test_paths_of_any_depth_and_cycles(frame, rows):
    nodes = frame("id int, parent_id int, name string", [
        (1, None, "world"), (2, 1, "us"), (3, 2, "texas"), (4, 3, "austin"), (5, 4, "centre"), (6, 99, "lost"),
        (7, 8, "hen"), (8, 7, "egg"), (9, 8, "chick"), (10, 10, "self")])
    assert rows(hierarchy_paths(nodes), "id", "depth", "root", "path") == sorted([
        (1, 0, 1, "world"), (2, 1, 1, "world / us"), (3, 2, 1, "world / us / texas"), (4, 3, 1, "world / us / texas / austin"),
        (5, 4, 1, "world / us / texas / austin / centre"), (6, 0, 6, "lost"),
        *[(i, None, None, None) for i in (7, 8, 9, 10)]], key=repr)
    assert hierarchy_paths(nodes.filter("false")).count() == 0


# --- terms of several words

def test_phrases_match_where_their_words_stand_together(frame, rows):
    tweets = frame("tweet_id string, tweet_text string", [
        ("1", "new york city is #new york"), ("2", "york new"), ("3", "in @new  york\ttoday"), ("4", ""), ("5", "new"), ("6", None)])
    terms = frame("term string", [("new york",), ("york city",), ("new york city",), ("york",), ("is new york",), ("  ",), (None,)])
    assert rows(phrase_matches(tweets, terms)) == sorted([
        ("1", "is new york"), ("1", "new york"), ("1", "new york city"), ("1", "york"), ("1", "york city"), ("2", "york"), ("3", "new york"), ("3", "york")], key=repr)


def test_too_long_terms_are_an_error(frame):
    tweets, terms = frame("tweet_id string, tweet_text string", [("1", "a b c")]), frame("term string", [("a b c",)])
    assert phrase_matches(tweets, terms, longest=3).count() == 1
    with pytest.raises(Exception, match="more than 2 words"):
        phrase_matches(tweets, terms, longest=2).count()


def test_no_token_copies_its_tweet(frame, rows):
    tweets, terms = frame("tweet_id string, tweet_text string", [("1", " ".join(["a b c d e f g"] * 50))]), frame("term string", [("g a b c d e",), ("f g",), ("g b",)])
    found = phrase_matches(tweets, terms)
    assert "transform(_tokens" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == [("1", "f g"), ("1", "g a b c d e")]
    assert rows(phrase_matches(tweets, terms.limit(0).unionByName(frame("term string", [("a",), ("z",)])), longest=1)) == [("1", "a")]


def test_phrase_associations_carry_support_and_polarity(frame, rows):
    tweets = frame("tweet_id string, tweet_text string", [("1", "good morning all"), ("2", "good morning good morning"), ("3", "morning"), ("4", "x")])
    lexicon = frame("term string, emotion string, association int", [
        ("good morning", "joy", 1), ("good morning", "fear", 0), ("morning", "trust", None), ("x", "anger", 1)])
    assert rows(phrase_associations(tweets, lexicon, 0.3)) == [("good morning", 0.5, "joy", 1, 333)]


# --- the cube

def test_cube_adds_up(frame, rows):
    facts = frame("tweet_id string, search_id int", [("a", 1), ("a", 2), ("b", 1), ("c", 2)])
    out = sentiment_cube(
        frame("tweet_id string, sent_id int", [("a", 1), ("b", 0), ("c", 1)]), frame("sent_id int, sentiment_category string", [(1, "P"), (0, "N")]), facts,
        frame("search_id int, event_id int", [(1, 10), (2, 20)]), frame("event_id int, event_name string", [(10, "e"), (20, "f")]),
        frame("category_id int, event_id int, cat_name_id int", [(1, 10, 5), (2, 20, 5), (3, 20, 6)]), frame("name_id int, name_text string", [(5, "x"), (6, "y")]))
    got = {r[:4]: r[4:] for r in rows(out, "level", "sentiment_category", "category_name", "event_name", "tweet_count", F.round("share", 4))}
    assert got[("category and event", "P", "x", "e")] == (1, 0.5) and got[("category and event", "P", "y", "f")] == (2, 1.0)
    assert got[("category", "P", "x", None)] == (3, 0.75) and got[("category", "N", "x", None)] == (1, 0.25)
    assert got[("event", "P", None, "f")] == (4, 1.0) and got[("all", "P", None, None)] == (5, round(5 / 6, 4))
    assert len(got) == 4 + 3 + 3 + 2
