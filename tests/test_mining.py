import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from voxstar.plans import associations, mining


def brute(baskets, level, k):
    n = len(baskets)
    counts = {}
    for basket in baskets:
        for combo in combinations(sorted(set(basket)), k):
            counts[combo] = counts.get(combo, 0) + 1
    return {c: v for c, v in counts.items() if v / n >= level}


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(11)
    items = "abcdefgh"
    return [[i for i in items if rng.random() < 0.15 + 0.1 * items.index(i)] or ["a"] for _ in range(200)]


@pytest.fixture(scope="module")
def txns(spark, baskets):
    long = [(t, i) for t, basket in enumerate(baskets) for i in basket for _ in range(2)]
    return spark.createDataFrame(long, "txn int, item string")


@pytest.mark.parametrize("k", [1, 2, 3, 9])
@pytest.mark.parametrize("mask_items", [12, 3, 0])
def test_itemsets_equal_brute_force(txns, baskets, k, mask_items):
    got = mining.frequent_itemsets(txns, ["txn"], "item", 0.2, k, mask_items=mask_items).collect()
    assert {tuple(r["items"]): r.freq for r in got} == brute(baskets, 0.2, k)
    assert all(r.n_txn == 200 and r.support == r.freq / 200 for r in got)


def test_all_sizes(txns, baskets):
    got = mining.frequent_itemsets(txns, ["txn"], "item", 0.3, None).collect()
    want = {}
    for k in range(1, 9):
        want.update(brute(baskets, 0.3, k))
    assert {tuple(r["items"]): r.freq for r in got} == want


@pytest.mark.parametrize("mask_items", [12, 0])
@pytest.mark.parametrize("k", [1, 2])
def test_itemset_exactly_at_the_threshold_is_kept(frame, mask_items, k):
    rows = [(t, i) for t in range(100) for i in (("a", "b") if t < 7 else ("c",))]
    got = mining.frequent_itemsets(frame("txn int, item string", rows), ["txn"], "item", 0.07, k, mask_items=mask_items)
    assert {tuple(r["items"]) for r in got.collect()} == ({("a",), ("b",), ("c",)} if k == 1 else {("a", "b")})


def test_empty_transactions_count(frame, rows):
    df = frame("txn int, item string", [(1, "a"), (2, None), (3, "b"), (4, None)])
    for mask_items in (12, 0):
        got = mining.frequent_itemsets(df, ["txn"], "item", 0.1, 1, mask_items=mask_items)
        assert rows(got) == [(["a"], 1, 4, 0.25), (["b"], 1, 4, 0.25)]


def test_itemsets_by_group(frame, rows):
    df = frame("e string, txn int, item string", [
        ("x", 1, "joy"), ("x", 1, "trust"), ("x", 2, "joy"), ("y", 1, "joy"), ("y", 1, "fear"), ("y", 2, "fear"), ("z", 1, "joy")])
    got = mining.frequent_itemsets_by(df, "e", ["txn"], "item", ["joy", "trust", "fear"], {"x": 0.5, "y": 0.6}, k=2)
    assert rows(mining.label_itemsets(got), "e", "itemsets", "freq", "support", "sentiment") == [
        ("x", "joy, trust", 1, 0.5, "positive")]
    wide = ["joy", "trust", "fear", *[str(i) for i in range(13)]]  # more than a mask holds
    levels = mining.frequent_itemsets_by(df, "e", ["txn"], "item", wide, {"x": 0.5, "y": 0.6}, k=2)
    assert rows(levels, "e", "items", "freq", "n_txn", "support") == rows(got, "e", "items", "freq", "n_txn", "support")


@pytest.mark.parametrize("k", [1, 3, None])
def test_levels_equal_masks(txns, rows, k):
    grouped = txns.withColumn("g", F.col("txn") % 2)
    masks = mining.frequent_itemsets_by(grouped, "g", ["txn"], "item", list("abcdefgh"), 0.25, k)
    levels = mining.frequent_itemsets_by(grouped, "g", ["txn"], "item", list("abcdefghijklmnop"), 0.25, k)
    names = ("g", "items", "freq", "n_txn", "support")
    assert rows(levels, *names) == rows(masks, *names) != []


def test_stats_and_order(frame, rows):
    df = frame("items array<string>, support double", [(["b"], 0.2), (["a"], 0.2), (["c"], 0.5)])
    assert tuple(mining.support_stats(df.withColumn("g", F.lit(1)), ["g"]).first()) == (1, 0.5, 0.2)
    assert [r["items"] for r in mining.sorted_itemsets(df).collect()] == [["a"], ["b"], ["c"]]
    assert [r["items"] for r in mining.sorted_itemsets(df, False).collect()] == [["c"], ["a"], ["b"]]


def test_indicators(frame, rows):
    df = frame("id int, item string", [(1, "a"), (1, "a"), (1, "b"), (2, "b")])
    matrix = mining.indicator_matrix(df, ["id"], "item", ["a", "b"])
    assert rows(matrix) == [(1, 1, 1), (2, 0, 1)]
    assert rows(mining.indicator_long(matrix, ["id"], ["a", "b"])) == [(1, "a", 1), (1, "b", 1), (2, "a", 0), (2, "b", 1)]


TWEETS = [("1", "😀 so joy 😀"), ("2", "🙈😀"), ("3", "Just posted a 😀"), ("4", "plain"), ("5", None), ("6", "🚀")]


def test_emoji_pipeline(frame, rows):
    """Exploded rows: 1/😀 x2, 2/😀 x2, 2/🙈 null term, 6/🚀 has no name and drops out."""
    tweets = frame("tweet_id string, tweet_text string", TWEETS)
    names = frame("emoji string, name string", [("😀", "grin"), ("🙈", "monkey"), ("🚀", "")])
    dictionary = frame("emoji string, name string, terms array<string>", [("😀", "grin", ["joy", "happy"])])
    lexicon = frame("term string, emotion string, association int",
                    [("joy", "joy", 1), ("joy", "trust", 1), ("happy", "joy", 0)])
    emojis = associations.tweet_emojis(tweets, names)
    assert rows(emojis, "tweet_id", "emoji") == [("1", "😀"), ("2", "😀"), ("2", "🙈")]
    assert len(rows(associations.emoji_terms(emojis, dictionary))) == 5
    assert dict(rows(associations.frequent_emoji(emojis, dictionary))) == {"😀": 0.8, "🙈": 0.2}
    assert dict(rows(associations.frequent_emoji(emojis, dictionary, denominator="tweets", tweets=tweets))) == {
        "😀": 2 / 6, "🙈": 1 / 6}
    got = associations.emoji_associations(tweets, names, dictionary, lexicon)
    assert rows(got, "tweet_id", "emoji", "term", "support", "emotion", "association", "sent_id") == [
        (t, "😀", "joy", 0.8, e, 1, 333) for t in ("1", "2") for e in ("joy", "trust")]
    assert associations.emoji_associations(tweets, names, dictionary, lexicon, min_support=0.9).count() == 0


def test_text_pipeline(frame, rows):
    tweets = frame("tweet_id string, tweet_text string", [
        ("1", "love #love @fear"), ("2", "love https://x fear"), ("3", "none"), ("4", "Just posted a love")])
    lexicon = frame("term string, emotion string, association int", [
        ("love", "joy", 1), ("love", "fear", 0), ("love", "positive", None), ("fear", "fear", 1), ("none", "joy", 0)])
    got = associations.text_associations(tweets, lexicon, 0.3)
    assert [(r.term, round(r.support, 6), r.emotion, r.association, r.sent_id) for r in got.orderBy("term", "emotion").collect()] == [
        ("fear", 0.333333, "fear", 1, 666), ("love", 0.666667, "joy", 1, 333), ("love", 0.666667, "positive", None, 333)]
    upper = associations.text_associations(tweets, lexicon, 0.3, term_extractor=lambda t: F.array(F.lit("fear")))
    assert rows(upper, "term", "support") == [("fear", 1.0)]
    blank = associations.text_associations(tweets, lexicon, 0.3, term_extractor=lambda t: F.array(F.lit("fear"), F.lit("")))
    assert rows(blank, "term", "support") == [("fear", 1.0)]  # an empty term changes no total
