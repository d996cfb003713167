"""Emoji and term associations: how frequent, which emotion, which polarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.functions.text import code_points, drop_media_posts, strip_sigils, strip_urls, tokens
from voxstar.operators.joins import dim_join
from voxstar.seeds import MIN_SUPPORT, emotion_polarity


def tweet_emojis(tweets: DataFrame, names: DataFrame, tweet_id: str = "tweet_id",
                 text: str = "tweet_text") -> DataFrame:
    """(tweet_id, emoji, name): distinct named emoji code points per tweet.

    ``names`` is (emoji, name); a code point without a name drops out.
    """
    kept = drop_media_posts(tweets.select(tweet_id, text), text)
    found = kept.select(F.col(tweet_id).alias("tweet_id"), F.explode(code_points(F.col(text))).alias("emoji"))
    named = names.filter(F.coalesce(F.col("name"), F.lit("")) != "").select("emoji", "name")
    return dim_join(found, named, "emoji")


def emoji_terms(emojis: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(tweet_id, emoji, name, term): dictionary terms by emoji name, a null term without an entry."""
    terms = dictionary.select("name", F.explode_outer("terms").alias("term"))
    return dim_join(emojis, terms, "name", "left")


def frequent_emoji(emojis: DataFrame, dictionary: DataFrame, min_support: float = MIN_SUPPORT,
                   denominator: str = "rows", tweets: DataFrame | None = None) -> DataFrame:
    """(emoji, support).

    ``denominator='rows'`` divides by the (tweet, emoji, term) rows;
    ``'tweets'`` counts tweets and divides by all of ``tweets``. Term rows are
    counted by multiplication, not by expanding them.
    """
    per_emoji = emojis.groupBy("emoji", "name").agg(F.count(F.lit(1)).alias("_tweets"))
    if denominator == "tweets":
        counts = per_emoji.groupBy("emoji").agg(F.sum("_tweets").alias("freq"))
        total = tweets.select(F.count(F.lit(1))).scalar()
    elif denominator != "rows":
        raise ValueError(f"unknown denominator: {denominator}")
    else:
        widths = dictionary.groupBy("name").agg(
            F.sum(F.greatest(F.size(F.coalesce("terms", F.array().cast("array<string>"))), F.lit(1))).alias("_terms"))
        counts = (per_emoji.join(widths, "name", "left").groupBy("emoji")
                  .agg(F.sum(F.col("_tweets") * F.coalesce("_terms", F.lit(1))).alias("freq")))
        total = F.sum("freq").over(Window.partitionBy())  # one row per emoji of the dictionary
    out = counts.select("emoji", (F.col("freq") / total).alias("support"))
    return out.filter(F.col("support") >= min_support)


def emoji_associations(tweets: DataFrame, names: DataFrame, dictionary: DataFrame, lexicon: DataFrame,
                       min_support: float = MIN_SUPPORT, tweet_id: str = "tweet_id",
                       text: str = "tweet_text") -> DataFrame:
    """One row per tweet, frequent emoji, term and associated emotion, with support and polarity mark."""
    emojis = tweet_emojis(tweets, names, tweet_id, text)
    support = frequent_emoji(emojis, dictionary, min_support)
    # everything that follows an emoji is joined among the lookups, so the tweet side meets one join
    terms = names.join(dictionary.select("name", F.explode("terms").alias("term")), "name")
    felt = with_polarity(terms.join(lexicon.filter(F.col("association") == 1), "term")).drop("name")
    lookup = felt.join(support, "emoji")
    return (dim_join(emojis, lookup, "emoji")
            .select("tweet_id", "emoji", "name", "term", "support", "emotion", "association", "sent_id"))


def with_polarity(df: DataFrame) -> DataFrame:
    """Add the polarity mark of each emotion (333 positive, 666 negative)."""
    marks = emotion_polarity(df.sparkSession).select("emotion", "sent_id")
    return df.join(F.broadcast(marks), "emotion", "left")


def default_terms(text):
    """Distinct tokens of a text without ``@``, ``#`` and links."""
    return F.array_distinct(tokens(strip_urls(strip_sigils(text))))


def _felt(counts: DataFrame, total: Column, lexicon: DataFrame, min_support: float) -> DataFrame:
    """Support, emotions and polarity of terms with their numbers of tweets, of ``total``. Rows whose association is 0 drop out, unknown ones stay."""
    frequent = counts.select("term", (F.col("freq") / total).alias("support")).filter(F.col("support") >= min_support)
    felt = frequent.join(lexicon, "term", "left").filter(~F.col("association").eqNullSafe(F.lit(0)))
    return with_polarity(felt).select("term", "support", "emotion", "association", "sent_id")


def text_associations(tweets: DataFrame, lexicon: DataFrame, min_support: float = MIN_SUPPORT,
                      text: str = "tweet_text", term_extractor=default_terms) -> DataFrame:
    """(term, support, emotion, association, sent_id) of lexicon terms frequent across tweets.

    ``term_extractor`` maps a text column to an array of distinct terms; a noun
    phrase tagger can be passed in. Rows whose association is 0 drop out, unknown
    ones stay.
    """
    kept = drop_media_posts(tweets, text)
    found = kept.select(F.explode(term_extractor(F.col(text))).alias("term")).filter(F.col("term") != "")
    vocabulary = lexicon.filter(F.col("association") == 1).select("term").distinct()
    counts = dim_join(found, vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    total = kept.agg(F.count(F.lit(1))).scalar()  # counted apart: a scan of the text column
    return _felt(counts, total, lexicon, min_support)


def phrase_matches(tweets: DataFrame, terms: DataFrame, tweet_id: str = "tweet_id", text: str = "tweet_text",
                   longest: int = 6) -> DataFrame:
    """(tweet_id, term): the terms, of one word or several, whose words stand next to each other in a tweet, each once.

    The terms make a tree of two levels: the first word, and below it the further words of all terms that begin with it. A tweet's
    tokens are walked once; each meets at most one row of the tree, however many terms share its word, and is
    compared with the words that follow it. Rows carry no more than ``longest`` words; a term with more fails the query instead of
    never matching. Terms overlap freely: "new york" and "york city" both stand in "new york city".
    """
    words = F.filter(F.split("term", r"\s+"), lambda w: w != "")
    entries = terms.select("term").distinct().select("term", words.alias("words")).filter(F.size("words") > 0)
    entries = entries.select("term", F.when(F.size("words") > longest, F.raise_error(
        F.concat(F.lit(f"more than {longest} words: "), "term"))).otherwise(F.col("words")).alias("words"))
    tree = entries.groupBy(F.col("words")[0].alias("word")).agg(F.collect_list(F.struct(
        "term", F.slice("words", 2, longest).alias("further"))).alias("below"))
    rows = tweets.select(F.col(tweet_id).alias("tweet_id"), tokens(strip_urls(strip_sigils(F.col(text)))).alias("_tokens"))
    # the tokens beside themselves moved up by one, two, ... places, null beyond the end: a slice per token would copy them all for each
    moved = [F.slice("_tokens", F.lit(n + 1), F.size("_tokens")) for n in range(longest)]
    names = ["word", *(f"_next{n}" for n in range(1, longest))]
    walked = rows.select("tweet_id", F.arrays_zip(*moved).alias("_at")).select("tweet_id", F.inline("_at").alias(*names))
    further = F.array(*names[1:]).cast("array<string>")
    met = dim_join(walked, tree, "word").select("tweet_id", "below", further.alias("next"))
    fitting = F.filter("below", lambda e: F.slice(F.col("next"), F.lit(1), F.size(e["further"])) == e["further"])
    return met.select("tweet_id", F.explode(F.transform(fitting, lambda e: e["term"])).alias("term")).distinct()


def phrase_associations(tweets: DataFrame, lexicon: DataFrame, min_support: float = MIN_SUPPORT, tweet_id: str = "tweet_id",
                        text: str = "tweet_text", longest: int = 6) -> DataFrame:
    """``text_associations`` for lexicons whose terms may have several words; ``tweet_id`` tells tweets apart."""
    kept = drop_media_posts(tweets, text)
    found = phrase_matches(kept, lexicon.filter(F.col("association") == 1), tweet_id, text, longest)
    return _felt(found.groupBy("term").agg(F.count(F.lit(1)).alias("freq")), F.lit(kept.count()), lexicon, min_support)
