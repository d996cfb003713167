"""Sentiment against tweet counts: grouped counts, point-biserial correlation, trend line."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxstar.functions.stats import correlation, correlation_p_value
from voxstar.operators.joins import dim_join
from voxstar.plans.events import captured_per_event
from voxstar.seeds import NEUTRAL


def keyword_sentiment_counts(assignment: DataFrame, tweet_data: DataFrame, searches: DataFrame,
                             events: DataFrame, event: str | None = None, neutral: int = NEUTRAL) -> DataFrame:
    """(event_name, keyword, sentiment, tweets); neutral left out, absent pairs not filled."""
    chosen = events if event is None else events.filter(F.col("event_name") == event)
    voted = assignment.filter(F.col("sent_id") != neutral)
    captured = captured_per_event(tweet_data, searches, ["keyword"])
    placed = dim_join(captured, chosen.select("event_id", "event_name"), "event_id")
    return (placed.join(voted, "tweet_id")
            .groupBy("event_name", "keyword", F.col("sent_id").alias("sentiment"))
            .agg(F.sum("captures").alias("tweets")))


def point_biserial(counts: DataFrame, by: list[str], binary: str = "sentiment", value: str = "tweets") -> DataFrame:
    """Correlation of a 0/1 column with a number per group, and its p-value, both to 4 places."""
    moments = counts.groupBy(*by).agg(correlation(binary, value).alias("_r"),
                                      F.count(F.lit(1)).alias("n"))
    return moments.select(*by, "n", F.round("_r", 4).alias("correlation"),
                          F.round(correlation_p_value("_r", "n"), 4).alias("p_value"))


def trend(counts: DataFrame, by: list[str], x: str = "sentiment", y: str = "tweets") -> DataFrame:
    """Least-squares line of ``y`` over ``x`` per group; null when ``x`` is constant."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    fit = counts.groupBy(*by).agg(F.var_pop(x).alias("_v"), F.covar_pop(x, y).alias("_c"),
                                  F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    slope = F.when(F.col("_v") > 0, F.col("_c") / F.nullif(F.col("_v"), F.lit(0.0)))
    return fit.select(*by, F.round(slope, 4).alias("slope"),
                      F.round(F.col("_y") - slope * F.col("_x"), 4).alias("intercept"))
