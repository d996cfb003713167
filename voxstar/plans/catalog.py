"""Temporary views over the store, so warehouse SQL runs with ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxstar.plans.views import vw_cat_events, vw_tweet_text, vw_tweets, vw_us_cities
from voxstar.plans.words import emotion_distinct_sets, tweet_emotions_all
from voxstar.schemas import TABLES
from voxstar.sources.tables import Store


def warehouse_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The stored queries of the warehouse, over given tables."""
    cat_events = vw_cat_events(tables["category"], tables["cat_name"], tables["events"])
    texts = vw_tweet_text(tables["tweet_text"])
    return {
        "vw_us_cities": vw_us_cities(tables["cities"]),
        "vw_cat_events": cat_events,
        "vw_tweet_text": texts,
        "vw_tweets": vw_tweets(tables["tweet_data"], tables["searches"], cat_events, texts),
        "vw_tweet_emotions_all": tweet_emotions_all(tables["word_association"]),
        "vw_emotion_distinct_sets": emotion_distinct_sets(tables["word_association"]),
    }


def register(store: Store) -> list[str]:
    """Register every table and view of a store by name; returns the names."""
    tables = {name: store.read(name) for name in TABLES if not name.startswith("vw_")}
    frames = {**tables, **warehouse_views(tables)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)
