"""Emotions and sentiments by event and news category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.operators.joins import dim_join, skew_join
from voxstar.seeds import EMOTIONS


def captured_per_event(tweet_data: DataFrame, searches: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(tweet_id, event_id[, extra], captures): how often each tweet was captured.

    A tweet found by k searches counts k times. Counting first leaves one row per
    tweet and event, so later joins on tweet id meet no hot key.
    """
    found = dim_join(tweet_data.select("tweet_id", "search_id"),
                     searches.select("search_id", "event_id", *(extra or [])), "search_id")
    return found.groupBy("tweet_id", "event_id", *(extra or [])).agg(F.count(F.lit(1)).alias("captures"))


def emotions_by_event(emotion_sets: DataFrame, tweet_data: DataFrame, searches: DataFrame,
                      events: DataFrame, **skew) -> DataFrame:
    """One row per captured tweet with its emotion set, keyword, event name and the id of the capture."""
    row_id = [c for c in ("data_id",) if c in tweet_data.columns] or ["search_id"]
    placed = dim_join(dim_join(tweet_data.select("tweet_id", "search_id", *[c for c in row_id if c != "search_id"]),
                               searches.select("search_id", "keyword", "event_id"), "search_id"),
                      events.select("event_id", "event_name"), "event_id")
    facts = placed.select("tweet_id", *row_id, "keyword", "event_name")
    return (skew_join(facts, emotion_sets, ["tweet_id"], "inner", row_id, counted=tweet_data, **skew)
            .select(*row_id, "tweet_id", *[c for c in emotion_sets.columns if c != "tweet_id"], "keyword", "event_name"))


def _voted_categories(assignment: DataFrame, sentiment_category: DataFrame, tweet_data: DataFrame, searches: DataFrame,
                      events: DataFrame, category: DataFrame, cat_name: DataFrame) -> DataFrame:
    """(event_id, event_name, sentiment_category, category_name, captures): captured votes of each event under each of its categories.

    Captures are summed per (event, sentiment) before the category fan-out, which then runs on a handful of rows.
    """
    captured = captured_per_event(tweet_data, searches)
    voted = (captured.join(assignment, "tweet_id").groupBy("event_id", "sent_id")
             .agg(F.sum("captures").alias("captures")))
    bridge = category.select("event_id", F.col("cat_name_id").alias("name_id")).join(cat_name, "name_id")
    return (voted.join(sentiment_category, "sent_id").join(events, "event_id")
            .join(bridge.select("event_id", F.col("name_text").alias("category_name")), "event_id"))


def sentiment_by_category(assignment: DataFrame, sentiment_category: DataFrame, tweet_data: DataFrame,
                          searches: DataFrame, events: DataFrame, category: DataFrame, cat_name: DataFrame,
                          by_event: bool = False) -> DataFrame:
    """Tweet counts per sentiment and news category (and event).

    A tweet counts once per capture and category of its event.
    """
    named = _voted_categories(assignment, sentiment_category, tweet_data, searches, events, category, cat_name)
    keys = ["sentiment_category", "category_name", *(["event_name"] if by_event else [])]
    return named.groupBy(*keys).agg(F.sum("captures").alias("tweet_count"))


#: What a row of ``sentiment_cube`` sums up, by its grouping id: a bit per column that is summed over.
CUBE_LEVELS = {0: "category and event", 1: "category", 2: "event", 3: "all"}


def sentiment_cube(assignment: DataFrame, sentiment_category: DataFrame, tweet_data: DataFrame, searches: DataFrame,
                   events: DataFrame, category: DataFrame, cat_name: DataFrame) -> DataFrame:
    """(level, sentiment_category, category_name, event_name, tweet_count, share): all totals from one pass over the star join.

    The levels are (category and event), category, event and all; a column summed over is null. ``tweet_count`` adds category
    counts, so a tweet counts once per capture and category of its event on every level. ``share`` is the sentiment's part of its
    level's cell.
    """
    named = _voted_categories(assignment, sentiment_category, tweet_data, searches, events, category, cat_name)
    sums = named.groupingSets(
        [["sentiment_category", "category_name", "event_name"], ["sentiment_category", "category_name"],
         ["sentiment_category", "event_name"], ["sentiment_category"]], "sentiment_category", "category_name", "event_name").agg(
        F.sum("captures").alias("tweet_count"), F.grouping_id().alias("_level"))
    names = F.create_map(*[F.lit(x) for pair in CUBE_LEVELS.items() for x in pair])
    cell = Window.partitionBy("_level", "category_name", "event_name")
    return sums.select(names[F.col("_level").cast("int")].alias("level"), "sentiment_category", "category_name", "event_name", "tweet_count",
                       (F.col("tweet_count") / F.sum("tweet_count").over(cell)).alias("share"))


def sentiment_totals(counts: DataFrame, by: list[str] | None = None, condition: Column | None = None,
                     part: Column | None = None) -> DataFrame:
    """Category counts summed again: over all events, those that meet ``condition``, or apart by ``part`` in one pass."""
    rows = counts if condition is None else counts.filter(condition)
    keys = [*(by or ["sentiment_category"]), *([] if part is None else [part.alias("part")])]
    return rows.groupBy(*keys).agg(F.sum("tweet_count").alias("tweet_count"))


def lexicon_emotions(lexicon: DataFrame) -> list[str]:
    """The emotions a lexicon names: a handful, whatever the number of its terms."""
    return sorted(r[0] for r in lexicon.select("emotion").dropna().distinct().collect())


def emotion_sums_by_event(associations: DataFrame, tweet_data: DataFrame, searches: DataFrame,
                          events: DataFrame, emotions: list[str] | None = None) -> DataFrame:
    """(event, emotion, sum): captured tweets showing each emotion.

    Every event of ``events`` has a row for each of ``emotions`` (the ten of the seed unless given), 0 where no captured tweet shows it;
    an emotion that is not listed has rows where it occurs.
    """
    shown = associations.select("tweet_id", "emotion").dropna().distinct()
    captured = captured_per_event(tweet_data, searches)
    sums = (captured.join(shown, "tweet_id").groupBy("event_id", "emotion").agg(F.sum("captures").alias("sum")))
    listed = F.array(*[F.lit(name) for name in emotions or EMOTIONS])
    cells = events.select("event_id", F.explode(listed).alias("emotion"))
    named = events.select("event_id", F.col("event_name").alias("event"))
    return (cells.join(sums, ["event_id", "emotion"], "full_outer").join(named, "event_id")
            .select("event", "emotion", F.coalesce("sum", F.lit(0)).alias("sum")))


def union_events(parts: list[DataFrame]) -> DataFrame:
    """Stack finished per-event results. To compute all events, group by event instead: one pass for all."""
    return reduce(lambda a, b: a.unionByName(b), parts)
