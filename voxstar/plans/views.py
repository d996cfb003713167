"""The warehouse views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxstar.functions.text import effective_text
from voxstar.operators.joins import dim_join, skew_join


def vw_us_cities(cities: DataFrame) -> DataFrame:
    """Cities with a US state; unknown states drop out with their null."""
    return cities.filter(F.col("state_id") != 0)


def vw_cat_events(category: DataFrame, cat_name: DataFrame, events: DataFrame) -> DataFrame:
    """One row per event with its category names in category order.

    The joined list is one value, so an event's names meet in one task whatever the plan.
    """
    bridge = category.withColumnRenamed("cat_name_id", "name_id")
    named = dim_join(dim_join(bridge, cat_name, "name_id"),
                     events, "event_id")
    names = F.transform(F.array_sort(F.collect_list(F.struct("category_id", "name_text"))), lambda s: s["name_text"])
    return named.groupBy("event_id").agg(
        F.min("category_id").alias("category_id"),
        F.array_join(names, ", ").alias("categories"),
        F.any_value("event_name").alias("event_name"))


def vw_tweet_text(tweet_text: DataFrame, ignore_case: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(tweet_id, tweet_text[, keep]): a retweet shows its original's text."""
    shown = effective_text(F.col("retweet_id"), F.col("tweet"), F.col("retweet_text"), ignore_case)
    return tweet_text.select("tweet_id", shown.alias("tweet_text"), *(keep or []))


def vw_tweets(tweet_data: DataFrame, searches: DataFrame, cat_events: DataFrame, texts: DataFrame,
              **skew) -> DataFrame:
    """Fact rows with search keyword, event, categories and shown text.

    Lookups are joined first; the text side is shuffled once on tweet id, with
    much-captured tweets split by fact id.
    """
    found = dim_join(tweet_data, searches.select("search_id", "keyword", "event_id"), "search_id")
    placed = dim_join(found, cat_events.select("event_id", "categories", "event_name"), "event_id")
    row_id = ["data_id"] if "data_id" in tweet_data.columns else ["author_id", "search_id", "created_at"]
    joined = skew_join(placed, texts, ["tweet_id"], "inner", row_id, counted=tweet_data, **skew)
    return joined.select("author_id", F.col("created_at").alias("tweet_created"), "tweet_id",
                         F.col("keyword").alias("keyword_search"), "categories", "event_name", "tweet_text")
