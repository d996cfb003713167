"""Text to emotion rows, emotion sets and sentiment votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxstar.functions.sentiment import emotion_score, vote
from voxstar.functions.text import strip_mentions, strip_urls, tokens
from voxstar.operators.joins import dim_join
from voxstar.seeds import NEUTRAL


def active_lexicon(lexicon: DataFrame) -> DataFrame:
    """(term, emotion) pairs that are associated."""
    return lexicon.filter(F.col("association") == 1).select("term", "emotion")


def token_rows(tweets: DataFrame, tweet_id: str = "tweet_id", text: str = "tweet_text",
               urls: bool = False, normalise: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(tweet_id, term[, keep]): one row per token occurrence.

    ``urls`` removes links first, ``normalise`` lower-cases and trims
    punctuation; both are off because stored results are built without them.
    """
    clean = F.col(text)
    if urls:
        clean = strip_urls(clean)
    clean = strip_mentions(clean)
    words = tokens(clean)
    if normalise:
        words = F.filter(F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^\W+|\W+$", "")),
                         lambda w: w != "")
    return tweets.select(F.col(tweet_id).alias("tweet_id"), *(keep or []), F.explode(words).alias("term"))


def word_association(tweets: DataFrame, lexicon: DataFrame, tweet_id: str = "tweet_id",
                     text: str = "tweet_text", urls: bool = False, normalise: bool = False,
                     keep: list[str] | None = None) -> DataFrame:
    """(tweet_id, term, emotion[, keep]): one row per token occurrence and associated emotion.

    The token side is never shuffled while the lexicon fits the broadcast limit.
    """
    words = token_rows(tweets, tweet_id, text, urls, normalise, keep)
    return (dim_join(words, active_lexicon(lexicon), "term")
            .select("tweet_id", "term", "emotion", *(keep or [])))


def emotion_counts(tweets: DataFrame, lexicon: DataFrame, tweet_id: str = "tweet_id",
                   text: str = "tweet_text") -> DataFrame:
    """(tweet_id, emotion, n) straight from texts: at most one row per emotion of the lexicon."""
    return (word_association(tweets, lexicon, tweet_id, text)
            .groupBy("tweet_id", "emotion").agg(F.count(F.lit(1)).alias("n")))


def tweet_emotions_all(associations: DataFrame) -> DataFrame:
    """(tweet_id, emotions_all): every emotion of a tweet with repeats, sorted and ', '-joined.

    Repeats are counted before they are regrouped, so a tweet's state holds one
    entry per emotion however long its text is.
    """
    counts = associations.groupBy("tweet_id", "emotion").agg(F.count(F.lit(1)).cast("int").alias("n"))
    runs = F.array_sort(F.collect_list(F.struct("emotion", "n")))
    spelled = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["emotion"], r["n"])))
    return counts.groupBy("tweet_id").agg(F.array_join(spelled, ", ").alias("emotions_all"))


def emotion_distinct_sets(associations: DataFrame) -> DataFrame:
    """(tweet_id, emotion): the sorted distinct emotions of a tweet, ', '-joined."""
    found = F.array_sort(F.collect_set("emotion"))
    return associations.groupBy("tweet_id").agg(F.array_join(found, ", ").alias("emotion"))


def sentiment_vote(associations: DataFrame, neutral: int = NEUTRAL) -> DataFrame:
    """(tweet_id, sent_id): majority of positive over negative emotions, repeats counted."""
    scored = associations.groupBy("tweet_id").agg(F.sum(emotion_score(F.col("emotion"))).alias("_score"))
    return scored.select("tweet_id", vote(F.col("_score"), neutral).alias("sent_id"))


def vote_texts(tweets: DataFrame, lexicon: DataFrame, tweet_id: str = "tweet_id",
               text: str = "tweet_text", neutral: int = NEUTRAL) -> DataFrame:
    """``sentiment_vote`` of ``word_association`` in one step.

    The lexicon is reduced to one summed score per term first, so a token meets
    one row and the shuffle carries one (id, score) pair per tweet and task.
    """
    scores = (active_lexicon(lexicon).groupBy("term")
              .agg(F.sum(emotion_score(F.col("emotion"))).alias("_term_score")))
    words = token_rows(tweets, tweet_id, text)
    scored = (dim_join(words, scores, "term")
              .groupBy("tweet_id").agg(F.sum("_term_score").alias("_score")))
    return scored.select("tweet_id", vote(F.col("_score"), neutral).alias("sent_id"))
