"""The star schema as derived from the shared test tables, for Spark and for SQL.

``documents`` play the captured texts, ``documents.source`` the search keyword,
``documents.lang`` the event; labelled documents of good quality were captured a
second time by a search of their own. The lexicon and the emoji dictionary come
from the words of ``benchmark``, users from ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxstar import seeds
from voxstar.functions.text import code_points, tokens
from voxstar.sources.tables import keyword_terms

EMOTIONS = seeds.EMOTIONS
LANG_EVENT = {"en": 3000, "es": 3001, "fr": 3002, "de": 3003}
LABEL_EVENT = 3004
LATER = 500  # a search's second window: texts of more than 2,000 characters were captured again in it


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select(F.col("doc_id").cast("string").alias("tweet_id"), F.col("text").alias("tweet_text"))


def lexicon_words(spark, sf) -> DataFrame:
    words = table(spark, sf, "benchmark").select(F.explode(tokens(F.lower("text"))).alias("term"))
    return words.filter(F.length("term") > 3).distinct()


def lexicon(spark, sf) -> DataFrame:
    """Two emotions per word; the second is associated for words of even length only."""
    emotions = F.array(*[F.lit(e) for e in EMOTIONS])
    pick = lambda n: F.element_at(emotions, (n % 10 + 1).cast("int"))
    pairs = F.array(
        F.struct(pick(F.ascii("term") + F.length("term")).alias("emotion"), F.lit(1).alias("association")),
        F.struct(pick(F.ascii(F.right("term", F.lit(1))) + F.length("term")).alias("emotion"), (1 - F.length("term") % 2).alias("association")))
    return (lexicon_words(spark, sf).select("term", F.inline(pairs))
            .groupBy("term", "emotion").agg(F.max("association").alias("association")))


LEXICON_SQL = f"""
words AS (SELECT DISTINCT lower(w) AS term
          FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS w FROM benchmark) WHERE length(w) > 3),
lexicon AS (
  SELECT term, emotion, CAST(max(association) AS INTEGER) AS association FROM (
    SELECT term, ({EMOTIONS!r})[1 + (ascii(term) + length(term)) % 10] AS emotion, 1 AS association FROM words
    UNION ALL
    SELECT term, ({EMOTIONS!r})[1 + (ascii(right(term, 1)) + length(term)) % 10], 1 - length(term) % 2 FROM words)
  GROUP BY term, emotion)"""

TEXTS_SQL = "texts AS (SELECT CAST(doc_id AS VARCHAR) AS tweet_id, text AS tweet_text FROM documents)"

# one row per token occurrence and associated emotion
ASSOC_SQL = f"""{LEXICON_SQL}, {TEXTS_SQL},
tokens AS (SELECT tweet_id, unnest(string_split_regex(
             regexp_replace(tweet_text, '[''@][A-z0-9]+', '', 'g'), '\\s+')) AS term FROM texts),
assoc AS (SELECT tweet_id, t.term, emotion FROM tokens t JOIN lexicon l ON l.term = t.term AND association = 1)"""


def _quoted(names):
    return ", ".join(f"'{n}'" for n in names)


SCORE_SQL = (f"CASE WHEN emotion IN ({_quoted(seeds.POSITIVE_EMOTIONS)}) THEN 1 "
             f"WHEN emotion IN ({_quoted(seeds.NEGATIVE_EMOTIONS)}) THEN -1 ELSE 0 END")

VOTES_SQL = f"""{ASSOC_SQL},
votes AS (SELECT tweet_id, CASE WHEN s > 0 THEN 1 WHEN s = 0 THEN 9 ELSE 0 END AS sent_id
          FROM (SELECT tweet_id, sum({SCORE_SQL}) AS s FROM assoc GROUP BY tweet_id))"""


def tweet_data(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    base = docs.select(
        F.col("doc_id").alias("data_id"), F.col("source").alias("author_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("n_chars") % 365).cast("int")).alias("created_at"),
        F.col("doc_id").cast("string").alias("tweet_id"),
        (_event_of("lang") * 1000 + F.substring("source", 4, 9).cast("long")).alias("search_id"))
    again = table(spark, sf, "labels").filter("quality = 1").select(
        (F.col("doc_id") + 1000000000000).alias("data_id"), F.lit("labels").alias("author_id"),
        F.lit("2016-01-01").cast("date").alias("created_at"), F.col("doc_id").cast("string").alias("tweet_id"),
        F.lit(LABEL_EVENT * 1000).cast("long").alias("search_id"))
    later = base.join(docs.filter("n_chars > 2000").select(F.col("doc_id").alias("data_id")), "data_id", "left_semi")
    later = later.withColumns({"data_id": F.col("data_id") + 2000000000000, "search_id": F.col("search_id") + LATER})
    return base.unionByName(again).unionByName(later)


def _event_of(lang: str):
    event = F.lit(None).cast("long")
    for value, event_id in LANG_EVENT.items():
        event = F.when(F.col(lang) == value, F.lit(event_id).cast("long")).otherwise(event)
    return event


def searches(spark, sf) -> DataFrame:
    found = table(spark, sf, "documents").select("source", "lang").distinct().select(
        (_event_of("lang") * 1000 + F.substring("source", 4, 9).cast("long")).alias("search_id"),
        F.col("source").alias("keyword"), _event_of("lang").cast("int").alias("event_id"))
    found = found.unionByName(found.withColumn("search_id", F.col("search_id") + LATER))
    label = spark.range(1).select(F.lit(LABEL_EVENT * 1000).cast("long").alias("search_id"),
                                  F.lit("labels").alias("keyword"), F.lit(LABEL_EVENT).alias("event_id"))
    return found.unionByName(label)


_EVENT_CASE = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_EVENT.items()) + " END"
_values = lambda rows: ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)

STAR_SQL = f"""
events_dim(event_id, event_name) AS (VALUES {_values(enumerate(seeds.EVENTS, seeds.EVENT_SEED))}),
cat_name(name_id, name_text) AS (VALUES {_values(enumerate(seeds.CAT_NAMES, seeds.CAT_NAME_SEED))}),
category(category_id, event_id, cat_name_id) AS (
  VALUES {_values((i, *c) for i, c in enumerate(seeds.CATEGORY, seeds.CATEGORY_SEED))}),
sentiment_category(sent_id, sentiment_category) AS (VALUES {_values(seeds.SENTIMENT_CATEGORY)}),
tweet_data AS (
  SELECT doc_id AS data_id, source AS author_id,
         CAST(DATE '2015-01-01' + CAST(n_chars % 365 AS INTEGER) AS DATE) AS created_at,
         CAST(doc_id AS VARCHAR) AS tweet_id,
         {_EVENT_CASE} * 1000 + CAST(substr(source, 4) AS BIGINT) AS search_id FROM documents
  UNION ALL
  SELECT doc_id + 1000000000000, 'labels', DATE '2016-01-01', CAST(doc_id AS VARCHAR), {LABEL_EVENT * 1000}
  FROM labels WHERE quality = 1
  UNION ALL
  SELECT doc_id + 2000000000000, source, CAST(DATE '2015-01-01' + CAST(n_chars % 365 AS INTEGER) AS DATE), CAST(doc_id AS VARCHAR),
         {_EVENT_CASE} * 1000 + {LATER} + CAST(substr(source, 4) AS BIGINT) FROM documents WHERE n_chars > 2000),
searches AS (
  SELECT DISTINCT {_EVENT_CASE} * 1000 + w + CAST(substr(source, 4) AS BIGINT) AS search_id,
         source AS keyword, {_EVENT_CASE} AS event_id FROM documents, (VALUES (0), ({LATER})) windows(w)
  UNION ALL SELECT {LABEL_EVENT * 1000}, 'labels', {LABEL_EVENT})"""


# --- emoji stand-ins: the accented letters of the benchmark words ------------------

UNNAMED, UNLISTED = "ß", "ó"  # a code point without a name, and one without dictionary terms


def emoji_names(spark, sf) -> DataFrame:
    letters = lexicon_words(spark, sf).select(F.explode(code_points(F.col("term"))).alias("emoji"))
    letters = letters.filter(F.ascii("emoji") > 127).distinct()
    name = F.when(F.col("emoji") == UNNAMED, F.lit("")).otherwise(F.concat(F.lit("letter "), F.ascii("emoji").cast("string")))
    return letters.select("emoji", name.alias("name"))


def emoji_dictionary(spark, sf) -> DataFrame:
    by_letter = lexicon_words(spark, sf).select(F.explode(code_points(F.col("term"))).alias("emoji"), "term")
    listed = (by_letter.filter((F.ascii("emoji") > 127) & (F.col("emoji") != UNLISTED))
              .groupBy("emoji").agg(F.array_sort(F.collect_set("term")).alias("keywords")))
    return (listed.join(emoji_names(spark, sf), "emoji")
            .select("emoji", "name", keyword_terms(F.col("keywords")).alias("terms")))


EMOJI_SQL = f"""{LEXICON_SQL}, {TEXTS_SQL},
letters AS (SELECT DISTINCT term, c FROM (SELECT term, unnest(string_split(term, '')) AS c FROM words) WHERE ascii(c) > 127),
emoji_names AS (SELECT DISTINCT c AS emoji, CASE WHEN c = '{UNNAMED}' THEN '' ELSE 'letter ' || ascii(c) END AS name FROM letters),
emoji_dict AS (SELECT name, list_sort(list(term))[2:] AS terms
               FROM letters JOIN emoji_names ON emoji = c WHERE c <> '{UNLISTED}' GROUP BY name),
tweet_emojis AS (
  SELECT DISTINCT tweet_id, emoji, name
  FROM (SELECT tweet_id, unnest(string_split(tweet_text, '')) AS c FROM texts WHERE tweet_text NOT LIKE '%Just posted a%')
  JOIN emoji_names ON emoji = c WHERE name <> ''),
emoji_rows AS (
  SELECT tweet_id, e.emoji, e.name, u.term FROM tweet_emojis e
  LEFT JOIN (SELECT name, unnest(CASE WHEN len(terms) > 0 THEN terms ELSE [NULL] END) AS term FROM emoji_dict) u ON u.name = e.name),
emoji_support AS (
  SELECT emoji, count(*) * 1.0e0 / (SELECT count(*) FROM emoji_rows) AS support FROM emoji_rows GROUP BY emoji
  HAVING count(*) * 1.0e0 / (SELECT count(*) FROM emoji_rows) >= 0.005)"""


# --- users with free-text locations --------------------------------------------------

_STATE_NAMES = [(i, code, name.title()) for i, (code, name, _) in enumerate(seeds.US_STATES, 1)]


def users(spark, sf) -> DataFrame:
    states = seeds.literal_frame(spark, "state_id int, code string, title string", _STATE_NAMES)
    named = table(spark, sf, "customer").withColumn("state_id", F.col("c_nationkey") + 1).join(F.broadcast(states), "state_id")
    code, title, segment = F.col("code"), F.col("title"), F.col("c_mktsegment")
    location = (F.when(segment == "AUTOMOBILE", F.concat(F.lit("Springfield, "), code))
                .when(segment == "BUILDING", F.concat(title, F.lit(", USA")))
                .when(segment == "FURNITURE", F.concat(F.lit("Lake City "), code))
                .when(segment == "HOUSEHOLD", F.concat(F.lit("New Town, "), code, F.lit(", USA")))
                .when(F.col("c_acctbal") > 5000, F.concat(F.lit("Boston,"), code))
                .when(F.col("c_acctbal") > 2500, title)
                .otherwise(F.lit("London, UK")))
    return named.select(F.col("c_custkey").cast("string").alias("author_id"), location.alias("location"))


USERS_SQL = f"""
states(state_id, code, title) AS (VALUES {_values(_STATE_NAMES)}),
codes(code, title) AS (SELECT code, title FROM states UNION ALL SELECT 'DC', 'District of Columbia'),
users AS (SELECT CAST(c_custkey AS VARCHAR) AS author_id, CASE
    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Springfield, ' || code
    WHEN c_mktsegment = 'BUILDING' THEN title || ', USA'
    WHEN c_mktsegment = 'FURNITURE' THEN 'Lake City ' || code
    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'New Town, ' || code || ', USA'
    WHEN c_acctbal > 5000 THEN 'Boston,' || code
    WHEN c_acctbal > 2500 THEN title ELSE 'London, UK' END AS location
  FROM customer JOIN states ON state_id = c_nationkey + 1),
stripped AS (SELECT author_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    location, ', USA$', ''), '^.*, ([A-Z]{{2}})$', '\\1'), '^.* ([A-Z]{{2}})$', '\\1'), '.*, ', ''),
    '^.*,([A-Z]{{2}})$', '\\1') AS place FROM users),
located AS (SELECT author_id, coalesce(c.code, place) AS state_abbr FROM stripped LEFT JOIN codes c ON c.title = place
            WHERE coalesce(c.code, place) IN (SELECT code FROM codes))"""


def us_states(spark) -> DataFrame:
    return seeds.seed_tables(spark)["us_states"]
