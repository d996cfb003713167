"""Declared schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql.types import StructType

PAYLOAD_DDL = """
data array<struct<
  id: string, author_id: string, created_at: string, text: string,
  conversation_id: string, lang: string, source: string, in_reply_to_user_id: string,
  referenced_tweets: array<struct<type: string, id: string>>,
  public_metrics: struct<like_count: bigint, quote_count: bigint, reply_count: bigint, retweet_count: bigint>,
  entities: struct<mentions: array<struct<start: int, end: int, username: string, id: string>>>>>,
includes struct<
  users: array<struct<id: string, name: string, username: string, created_at: string, location: string,
    description: string, verified: boolean, protected: boolean, url: string, pinned_tweet_id: string,
    profile_image_url: string,
    public_metrics: struct<followers_count: bigint, following_count: bigint, listed_count: bigint, tweet_count: bigint>>>,
  tweets: array<struct<id: string, author_id: string, created_at: string, text: string,
    referenced_tweets: array<struct<type: string, id: string>>>>>,
errors array<struct<value: string, detail: string, title: string, resource_type: string,
  parameter: string, resource_id: string, type: string, section: string>>,
meta struct<newest_id: string, oldest_id: string, result_count: int, next_token: string>,
_corrupt_record string
"""

# Star schema, one DDL string per table.
TABLES = {
    "regions": "reg_id int, region string",
    "divisions": "div_id int, division string, reg_id int",
    "us_states": "state_id int, state string, state_abbr string, div_id int",
    "cities": "city string, city_ascii string, lat double, lng double, country string, iso2 string, "
              "iso3 string, state_province string, capital string, population double, city_id int, state_id int",
    "events": "event_id int, event_name string",
    "cat_name": "name_id int, name_text string",
    "category": "category_id int, event_id int, cat_name_id int",
    "search_dates": "search_date_id bigint, search_start date, search_end date",
    "searches": "search_id bigint, keyword string, search_date_id bigint, event_id int",
    "users": "author_id string, created_at date, location string, description string, followers_count bigint, "
             "following_count bigint, listed_count bigint, tweet_count bigint, verified boolean",
    "tweet_text": "tweet_id string, tweet string, retweet_id string, retweet_text string",
    "tweet_data": "data_id bigint, author_id string, created_at date, tweet_id string, search_id bigint",
    "word_association": "wa_id bigint, tweet_id string, term string, emotion string",
    "sentiment_category": "sent_id int, sentiment_category string",
    "sentiment_category_assignment": "tweet_id string, sent_id int",
    "author_location": "author_id string, state_id int",
    "vw_cat_events": "category_id int, event_id int, categories string, event_name string",
    "run_log": "run_date timestamp, load_type string, comment string, filepath string",
}

LEXICON_DDL = "term string, emotion string, association int"
POPULATION_DDL = "state string, pop bigint"
WORLD_CITIES_DDL = ("city string, city_ascii string, lat double, lng double, country string, iso2 string, "
                    "iso3 string, admin_name string, capital string, population double, id int")


def payload_schema() -> StructType:
    return StructType.fromDDL(PAYLOAD_DDL)


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])
