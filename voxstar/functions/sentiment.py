"""Emotion sets and polarity votes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxstar.seeds import NEGATIVE, NEGATIVE_EMOTIONS, NEUTRAL, POSITIVE, POSITIVE_EMOTIONS


def emotion_score(emotion: Column) -> Column:
    """+1 for a positive emotion, -1 for a negative one, 0 for any other word."""
    return (F.when(emotion.isin(POSITIVE_EMOTIONS), F.lit(1))
            .when(emotion.isin(NEGATIVE_EMOTIONS), F.lit(-1)).otherwise(F.lit(0)))


def vote(score: Column, neutral: int = NEUTRAL) -> Column:
    """Sentiment code of a summed score."""
    return (F.when(score > 0, F.lit(POSITIVE)).when(score == 0, F.lit(neutral))
            .otherwise(F.lit(NEGATIVE)))


def list_score(emotions: Column) -> Column:
    """Summed score of an array of emotions, repeats counted."""
    return F.aggregate(emotions, F.lit(0), lambda total, e: total + emotion_score(e))


def vote_from_string(joined: Column, neutral: int = NEUTRAL) -> Column:
    """Sentiment code of a ', '-joined emotion list."""
    return vote(list_score(F.split(joined, ", ")), neutral)


def itemset_sentiment(emotions: Column) -> Column:
    """positive when positive emotions outnumber negative ones, else negative; no neutral."""
    return F.when(list_score(emotions) > 0, F.lit("positive")).otherwise(F.lit("negative"))
