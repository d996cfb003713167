"""Registered queries: text cleaning, emotions, sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstar.functions import sentiment, text
from voxstar.plans import associations, words
from voxstar.seeds import EMOTIONS
from voxstar.suite import standins as s


def _assoc(spark, sf):
    return words.word_association(s.texts(spark, sf), s.lexicon(spark, sf))


def _assoc_clean(spark, sf):
    linked = s.texts(spark, sf).withColumn("tweet_text", F.concat("tweet_text", F.lit(" https://t.co/x that thereon")))
    return words.word_association(linked, s.lexicon(spark, sf), urls=True, normalise=True)


def _cleaned(expression, suffix=None, prefix=None):
    def run(spark, sf):
        raw = F.col("tweet_text")
        if suffix:
            raw = F.concat(raw, F.lit(suffix))
        if prefix:
            raw = F.concat(F.lit(prefix), raw)
        out = expression(raw)
        return s.texts(spark, sf).select("tweet_id", F.length(out).cast("long").alias("length"), F.md5(out).alias("digest"))
    return run


def _cleaned_sql(expression):
    return f"""WITH {s.TEXTS_SQL}, out AS (SELECT tweet_id, {expression} AS t FROM texts)
    SELECT tweet_id, CAST(length(t) AS BIGINT) AS length, md5(t) AS digest FROM out"""


def _token_counts(spark, sf):
    return s.texts(spark, sf).select("tweet_id", F.size(text.tokens(F.col("tweet_text"))).cast("long").alias("tokens"))


def _occurrences(spark, sf):
    sets = words.tweet_emotions_all(_assoc(spark, sf))
    return sets.select("tweet_id", *[text.occurrence_count(F.col("emotions_all"), e).cast("long").alias(e) for e in EMOTIONS])


def _media(spark, sf):
    """German texts go missing, and a leading "The" becomes the media phrase."""
    posts = s.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("tweet_id"),
        F.when(F.col("lang") != "de", F.regexp_replace("text", "^The", text.MEDIA_POST)).alias("tweet_text"))
    return text.clean_tweets(posts, "tweet_text").select("tweet_id", F.md5("tweet_text").alias("digest"))


def _emojis(spark, sf):
    found = associations.tweet_emojis(s.texts(spark, sf), s.emoji_names(spark, sf))
    return found.groupBy("tweet_id").agg(F.array_join(F.array_sort(F.collect_set("emoji")), "").alias("emojis"))


def _emoji_column(spark, sf):
    out = text.unique_emojis(F.col("tweet_text"), ["é", "ñ", "ü", "#", "@"])
    return s.texts(spark, sf).select("tweet_id", F.array_join(out, " ").alias("emojis"))


QUERIES = {
    "word_association": (
        _assoc,
        f"WITH {s.ASSOC_SQL} SELECT tweet_id, term, emotion FROM assoc"),
    "word_association_normalised": (
        _assoc_clean,
        f"""WITH {s.LEXICON_SQL}, {s.TEXTS_SQL},
        clean AS (SELECT tweet_id, regexp_replace(regexp_replace(tweet_text || ' https://t.co/x that thereon',
            'https?://[^\\n]*', '', 'g'), '[''@][A-z0-9]+', '', 'g') AS t FROM texts),
        tok AS (SELECT tweet_id, regexp_replace(lower(unnest(string_split_regex(t, '\\s+'))), '^\\W+|\\W+$', '', 'g') AS term FROM clean)
        SELECT tweet_id, tok.term, emotion FROM tok JOIN lexicon l ON l.term = tok.term AND association = 1"""),
    "strip_urls": (
        _cleaned(text.strip_urls, suffix=" see https://t.co/x y\nnext"),
        _cleaned_sql("regexp_replace(tweet_text || ' see https://t.co/x y' || chr(10) || 'next', 'https?://[^\\n]*', '', 'g')")),
    "strip_mentions": (
        _cleaned(text.strip_mentions, prefix="don't @joe_b go "),
        _cleaned_sql("regexp_replace('don''t @joe_b go ' || tweet_text, '[''@][A-z0-9]+', '', 'g')")),
    "strip_sigils": (
        _cleaned(text.strip_sigils),
        _cleaned_sql("replace(replace(tweet_text, '@', ''), '#', '')")),
    "strip_digits": (
        _cleaned(text.strip_digits),
        _cleaned_sql("regexp_replace(tweet_text, '[0-9#]+', '', 'g')")),
    "token_counts": (
        _token_counts,
        f"""WITH {s.TEXTS_SQL} SELECT tweet_id, CAST(len(list_filter(string_split_regex(tweet_text, '\\s+'),
            lambda w: w <> '')) AS BIGINT) AS tokens FROM texts"""),
    "drop_media_posts": (
        _media,
        """WITH posts AS (SELECT CAST(doc_id AS VARCHAR) AS tweet_id, regexp_replace(text, '^The', 'Just posted a') AS t
            FROM documents WHERE lang <> 'de')
        SELECT tweet_id, md5(t) AS digest FROM posts WHERE t NOT LIKE '%Just posted a%'"""),
    "unique_emojis": (
        _emojis,
        f"WITH {s.EMOJI_SQL} SELECT tweet_id, string_agg(emoji, '' ORDER BY ascii(emoji)) AS emojis FROM tweet_emojis GROUP BY tweet_id"),
    "unique_emojis_listed": (
        _emoji_column,
        f"""WITH {s.TEXTS_SQL} SELECT tweet_id, array_to_string(list_filter(['#', '@', 'é', 'ñ', 'ü'],
            lambda e: contains(tweet_text, e)), ' ') AS emojis FROM texts"""),
    "tweet_emotions_all": (
        lambda spark, sf: words.tweet_emotions_all(_assoc(spark, sf)),
        f"WITH {s.ASSOC_SQL} SELECT tweet_id, string_agg(emotion, ', ' ORDER BY emotion) AS emotions_all FROM assoc GROUP BY tweet_id"),
    "emotion_distinct_sets": (
        lambda spark, sf: words.emotion_distinct_sets(_assoc(spark, sf)),
        f"""WITH {s.ASSOC_SQL}, d AS (SELECT DISTINCT tweet_id, emotion FROM assoc)
        SELECT tweet_id, string_agg(emotion, ', ' ORDER BY emotion) AS emotion FROM d GROUP BY tweet_id"""),
    "emotion_occurrences": (
        _occurrences,
        f"WITH {s.ASSOC_SQL} SELECT tweet_id, " + ", ".join(
            f"count(*) FILTER (emotion = '{e}') AS {e}" for e in EMOTIONS) + " FROM assoc GROUP BY tweet_id"),
    "sentiment_vote": (
        lambda spark, sf: words.sentiment_vote(_assoc(spark, sf)),
        f"WITH {s.VOTES_SQL} SELECT tweet_id, sent_id FROM votes"),
    "sentiment_vote_texts": (
        lambda spark, sf: words.vote_texts(s.texts(spark, sf), s.lexicon(spark, sf)),
        f"WITH {s.VOTES_SQL} SELECT tweet_id, sent_id FROM votes"),
    "sentiment_vote_listed": (
        lambda spark, sf: words.tweet_emotions_all(_assoc(spark, sf)).select(
            "tweet_id", sentiment.vote_from_string(F.col("emotions_all"), neutral=999).alias("sentiment")),
        f"WITH {s.VOTES_SQL} SELECT tweet_id, CASE sent_id WHEN 9 THEN 999 ELSE sent_id END AS sentiment FROM votes"),
}
