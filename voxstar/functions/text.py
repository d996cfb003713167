"""Text cleaning and tokenising, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values: patterns and texts that decide results --------------------
URL_TAIL = r"https?://[^\n]*"          # a link and the rest of its line
MENTION = r"['@][A-z0-9]+"             # also eats what follows an apostrophe
SIGILS = "@#"
DIGITS_AND_HASHES = r"\d*#*"
MEDIA_POST = "Just posted a"
RETWEET_PREFIX = "RT%"
WHITESPACE = r"(?U)[\s\x1C-\x1F]+"     # Unicode white space and the four separator controls
# ------------------------------------------------------------------------------


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_TAIL, "")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "")


def strip_sigils(text: Column) -> Column:
    return F.translate(text, SIGILS, "")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, DIGITS_AND_HASHES, "")


def tokens(text: Column) -> Column:
    """Whitespace tokens of a text, empty strings removed."""
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")


def drop_media_posts(df: DataFrame, text: str) -> DataFrame:
    """Rows without any null whose text is not a bare media post."""
    return df.dropna("any").filter(~F.col(text).contains(MEDIA_POST))


def clean_tweets(df: DataFrame, text: str, digits: bool = False) -> DataFrame:
    """Media posts dropped; ``digits`` also strips digits and hash signs."""
    kept = drop_media_posts(df, text)
    return kept.withColumn(text, strip_digits(F.col(text))) if digits else kept


def code_points(text: Column) -> Column:
    """Distinct code points of a text that are neither Latin letters nor white space."""
    rest = F.regexp_replace(text, r"[A-Za-z\s]+", "")
    return F.array_distinct(F.regexp_extract_all(rest, F.lit("((?s).)"), F.lit(1)))


def unique_emojis(text: Column, emoji: list[str]) -> Column:
    """Sorted distinct members of a given emoji list found in a text."""
    wanted = F.array(*[F.lit(e) for e in sorted(set(emoji))])
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("((?s).)"), F.lit(1)))
    return F.array_sort(F.array_intersect(found, wanted))


def effective_text(retweet_id: Column, tweet: Column, retweet_text: Column, ignore_case: bool = False) -> Column:
    """The original's text for a retweet, else the tweet's own."""
    prefix = tweet.ilike(RETWEET_PREFIX) if ignore_case else tweet.like(RETWEET_PREFIX)
    return F.when(retweet_id.isNotNull() & prefix, retweet_text).otherwise(tweet)


def occurrence_count(text: Column, part: str) -> Column:
    """How often a plain substring occurs."""
    return F.size(F.split(text, F.lit("\\Q" + part + "\\E"), -1)) - 1


def first_reference(referenced: Column) -> Column:
    """Id of the first referenced post, by field name; null without references."""
    return F.try_element_at(referenced, F.lit(1)).getField("id")
