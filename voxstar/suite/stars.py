"""Registered queries: views, star joins, category and event counts, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstar import seeds
from voxstar.functions.text import effective_text
from voxstar.operators.joins import full_outer_keyed
from voxstar.operators.keys import fix_rows
from voxstar.plans import correlation, events, views, words
from voxstar.suite import standins as s


def _assoc(spark, sf):
    return words.word_association(s.texts(spark, sf), s.lexicon(spark, sf))


def _votes(spark, sf):
    return words.vote_texts(s.texts(spark, sf), s.lexicon(spark, sf))


def _star(spark, sf):
    dims = seeds.seed_tables(spark)
    return {"tweet_data": s.tweet_data(spark, sf), "searches": s.searches(spark, sf), "events": dims["events"]}, dims


def _by_category(by_event):
    def run(spark, sf):
        star, dims = _star(spark, sf)
        return events.sentiment_by_category(_votes(spark, sf), dims["sentiment_category"], **star,
                                            category=dims["category"], cat_name=dims["cat_name"], by_event=by_event)
    return run


def _by_category_sql(by_event):
    """Captures per event and vote first; a category then adds up the events it is listed for."""
    shown = ", event_name" if by_event else ""
    return f"""WITH {s.VOTES_SQL}, {s.STAR_SQL},
    found AS (SELECT event_id, sent_id, count(*) AS n FROM searches, tweet_data, votes
      WHERE tweet_data.search_id = searches.search_id AND votes.tweet_id = tweet_data.tweet_id GROUP BY ALL),
    labels(sent_id, label) AS (VALUES (1, 'POSITIVE'), (9, 'NEUTRAL'), (0, 'NEGATIVE')),
    listed AS (SELECT event_id, list(name_text) AS names FROM category, cat_name WHERE name_id = cat_name_id GROUP BY event_id),
    spread AS (SELECT label, event_id, n, unnest(names) AS category_name FROM found JOIN listed USING (event_id) JOIN labels USING (sent_id))
    SELECT label AS sentiment_category, category_name{shown}, sum(n)::BIGINT AS tweet_count
    FROM spread LEFT JOIN events_dim USING (event_id) GROUP BY ALL"""


def _cube(spark, sf):
    star, dims = _star(spark, sf)
    cube = events.sentiment_cube(_votes(spark, sf), dims["sentiment_category"], **star, category=dims["category"], cat_name=dims["cat_name"])
    return cube.withColumn("share", F.round("share", 8))


_CUBE_SQL = f"""WITH by_event AS ({_by_category_sql(True)}),
levels AS (
  SELECT 'category and event' AS level, * FROM by_event
  UNION ALL BY NAME SELECT 'category' AS level, sentiment_category, category_name, sum(tweet_count)::BIGINT AS tweet_count FROM by_event GROUP BY ALL
  UNION ALL BY NAME SELECT 'event' AS level, sentiment_category, event_name, sum(tweet_count)::BIGINT AS tweet_count FROM by_event GROUP BY ALL
  UNION ALL BY NAME SELECT 'all' AS level, sentiment_category, sum(tweet_count)::BIGINT AS tweet_count FROM by_event GROUP BY ALL)
SELECT *, round(tweet_count / sum(tweet_count) OVER (PARTITION BY level, category_name, event_name), 8) AS share FROM levels"""


def _totals(spark, sf):
    part = F.when(F.col("event_name") == "SAME SEX MARRIAGE", "one").otherwise("rest")
    return events.sentiment_totals(_by_category(True)(spark, sf), part=part)


def _sums(spark, sf):
    star, _ = _star(spark, sf)
    return events.emotion_sums_by_event(_assoc(spark, sf), **star, emotions=events.lexicon_emotions(s.lexicon(spark, sf)))


def _emotions_by_event(spark, sf):
    star, _ = _star(spark, sf)
    return events.emotions_by_event(words.emotion_distinct_sets(_assoc(spark, sf)), **star, hot_rows=1).drop("data_id")


def _counts(spark, sf, event=None):
    star, _ = _star(spark, sf)
    return correlation.keyword_sentiment_counts(_votes(spark, sf), **star, event=event)


def _union(spark, sf):
    """Per-event results of one pass, one event after the other."""
    counts = fix_rows(_counts(spark, sf))
    return events.union_events([counts.filter(F.col("event_name") == name) for name in seeds.EVENTS])


COUNTS_SQL = f"""{s.VOTES_SQL}, {s.STAR_SQL},
counts AS (SELECT event_name, keyword, sent_id AS sentiment, count(*) AS tweets
  FROM votes v JOIN tweet_data td ON td.tweet_id = v.tweet_id JOIN searches s ON s.search_id = td.search_id
  JOIN events_dim e ON e.event_id = s.event_id WHERE sent_id <> 9 GROUP BY event_name, keyword, sent_id)"""

# closed finite sums of the t distribution, by parity of the degrees of freedom
P_SQL = """CASE WHEN n <= 2 OR r IS NULL THEN NULL WHEN df % 2 = 0 THEN
  1 - sin(th) * list_sum(list_transform(range(0, CAST(df / 2 AS BIGINT)), lambda j:
      exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * pow(cos(th), 2 * j)))
 ELSE 1 - 2 / pi() * (th + CASE WHEN df = 1 THEN 0 ELSE sin(th) * list_sum(list_transform(range(0, CAST((df - 1) / 2 AS BIGINT)), lambda j:
      exp(lgamma(j + 1) - lgamma(j + 1.5)) * sqrt(pi()) / 2 * pow(cos(th), 2 * j + 1))) END) END"""


def _conversation_texts(spark, sf):
    c = s.table(spark, sf, "conversations")
    ident = lambda turn: F.concat_ws("-", "conv_id", turn)
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("retweet_text"))
    tweet = F.when(F.col("role") == "assistant", F.concat(F.lit("RT @user: "), "text")).otherwise(F.col("text"))
    return c.join(before, ["conv_id", "turn"], "left").select(
        ident(F.col("turn")).alias("tweet_id"), tweet.alias("tweet"),
        F.when(F.col("turn") > 0, ident(F.col("turn") - 1)).alias("retweet_id"), "retweet_text")


def _shown(spark, sf):
    return views.vw_tweet_text(_conversation_texts(spark, sf)).select("tweet_id", F.md5("tweet_text").alias("digest"))


def _shown_ignoring_case(spark, sf):
    lowered = _conversation_texts(spark, sf).withColumn("tweet", F.lower("tweet"))
    shown = effective_text(F.col("retweet_id"), F.col("tweet"), F.col("retweet_text"), ignore_case=True)
    return lowered.select("tweet_id", F.md5(shown).alias("digest"))


TALK_SQL = """talk AS (SELECT c.conv_id || '-' || c.turn AS tweet_id,
    CASE WHEN c.role = 'assistant' THEN 'RT @user: ' || c.text ELSE c.text END AS tweet,
    CASE WHEN c.turn > 0 THEN c.conv_id || '-' || (c.turn - 1) END AS retweet_id, b.text AS retweet_text
  FROM conversations c LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - 1)"""


def _outer(spark, sf):
    c = s.table(spark, sf, "conversations")
    tweets = c.select(
        F.concat_ws("-", "conv_id", "turn").alias("tweet_id"),
        F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", F.col("turn") - 1)).alias("rt_id"))
    originals = c.select(F.concat_ws("-", "conv_id", "turn").alias("rt_id"), F.md5("text").alias("rt_digest"))
    return full_outer_keyed(tweets, originals, ["rt_id"], ["tweet_id"]).select("tweet_id", "rt_id", "rt_digest")


def _cat_events(spark, sf):
    """Orders as events, their lines as the category bridge, parts as category names."""
    orders, lines, parts = (s.table(spark, sf, name) for name in ("orders", "lineitem", "part"))
    return views.vw_cat_events(
        lines.select((F.col("l_linenumber") * F.lit(1000000000).cast("long") + F.col("l_partkey")).alias("category_id"),
                     F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("cat_name_id")),
        parts.select(F.col("p_partkey").alias("name_id"), F.col("p_name").alias("name_text")),
        orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("event_name")))


def _tweets(spark, sf):
    star, dims = _star(spark, sf)
    shown = views.vw_tweet_text(s.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("tweet_id"), F.col("text").alias("tweet"), F.lit(None).cast("string").alias("retweet_id"),
        F.lit(None).cast("string").alias("retweet_text")))
    view = views.vw_tweets(star["tweet_data"], star["searches"],
                           views.vw_cat_events(dims["category"], dims["cat_name"], dims["events"]), shown)
    return view.withColumn("tweet_text", F.md5("tweet_text"))


QUERIES = {
    "vw_cat_events": (
        _cat_events,
        """WITH c AS (SELECT l_linenumber * 1000000000::BIGINT + l_partkey AS category_id, l_orderkey AS event_id, p_name, o_orderpriority
          FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey)
        SELECT event_id, min(category_id) AS category_id, string_agg(p_name, ', ' ORDER BY category_id, p_name) AS categories,
          min(o_orderpriority) AS event_name FROM c GROUP BY event_id"""),
    "vw_tweet_text": (
        _shown,
        f"""WITH {TALK_SQL} SELECT tweet_id, md5(CASE WHEN retweet_id IS NOT NULL AND tweet LIKE 'RT%'
        THEN retweet_text ELSE tweet END) AS digest FROM talk"""),
    "vw_tweet_text_ignore_case": (
        _shown_ignoring_case,
        f"""WITH {TALK_SQL} SELECT tweet_id, md5(CASE WHEN retweet_id IS NOT NULL AND lower(tweet) ILIKE 'RT%'
        THEN retweet_text ELSE lower(tweet) END) AS digest FROM talk"""),
    "vw_tweets": (
        _tweets,
        f"""WITH {s.TEXTS_SQL}, {s.STAR_SQL},
        cat_events AS (SELECT c.event_id, string_agg(name_text, ', ' ORDER BY category_id) AS categories, min(event_name) AS event_name
          FROM category c JOIN cat_name ON name_id = cat_name_id JOIN events_dim e ON e.event_id = c.event_id GROUP BY c.event_id)
        SELECT author_id, created_at AS tweet_created, td.tweet_id, keyword AS keyword_search, categories, event_name,
               md5(tweet_text) AS tweet_text
        FROM tweet_data td JOIN searches s ON s.search_id = td.search_id JOIN cat_events ce ON ce.event_id = s.event_id
        JOIN texts t ON t.tweet_id = td.tweet_id"""),
    "retweet_outer_join": (
        _outer,
        """WITH t AS (SELECT conv_id || '-' || turn AS tweet_id, CASE WHEN turn > 0 THEN conv_id || '-' || (turn - 1) END AS rt_id
          FROM conversations),
        o AS (SELECT conv_id || '-' || turn AS id, md5(text) AS rt_digest FROM conversations)
        SELECT tweet_id, coalesce(rt_id, id) AS rt_id, rt_digest FROM t FULL JOIN o ON rt_id = id"""),
    "sentiment_by_category": (_by_category(False), _by_category_sql(False)),
    "sentiment_by_category_event": (_by_category(True), _by_category_sql(True)),
    "sentiment_cube": (_cube, _CUBE_SQL),
    "sentiment_totals": (
        _totals,
        f"""WITH counts AS ({_by_category_sql(True)})
        SELECT CASE WHEN event_name = 'SAME SEX MARRIAGE' THEN 'one' ELSE 'rest' END AS part, sentiment_category,
               CAST(sum(tweet_count) AS BIGINT) AS tweet_count FROM counts GROUP BY 1, 2"""),
    "emotions_by_event": (
        _emotions_by_event,
        f"""WITH {s.ASSOC_SQL}, {s.STAR_SQL}, d AS (SELECT DISTINCT tweet_id, emotion FROM assoc),
        sets AS (SELECT tweet_id, string_agg(emotion, ', ' ORDER BY emotion) AS emotion FROM d GROUP BY tweet_id)
        SELECT td.tweet_id, emotion, keyword, event_name FROM sets JOIN tweet_data td ON td.tweet_id = sets.tweet_id
        JOIN searches s ON s.search_id = td.search_id JOIN events_dim e ON e.event_id = s.event_id"""),
    "emotion_sums_by_event": (
        _sums,
        f"""WITH {s.ASSOC_SQL}, {s.STAR_SQL}, d AS (SELECT DISTINCT tweet_id, emotion FROM assoc),
        sums AS (SELECT event_name, emotion, count(*) AS n FROM d JOIN tweet_data td ON td.tweet_id = d.tweet_id
          JOIN searches s ON s.search_id = td.search_id JOIN events_dim e ON e.event_id = s.event_id GROUP BY 1, 2)
        SELECT e.event_name AS event, m.emotion, coalesce(n, 0) AS sum
        FROM events_dim e CROSS JOIN (SELECT DISTINCT emotion FROM lexicon) m
        LEFT JOIN sums ON sums.event_name = e.event_name AND sums.emotion = m.emotion"""),
    "keyword_sentiment_counts": (
        _counts,
        f"WITH {COUNTS_SQL} SELECT event_name, keyword, sentiment, tweets FROM counts"),
    "union_events": (
        _union,
        f"WITH {COUNTS_SQL} SELECT event_name, keyword, sentiment, tweets FROM counts"),
    "point_biserial": (
        lambda spark, sf: correlation.point_biserial(_counts(spark, sf), ["event_name"]),
        f"""WITH {COUNTS_SQL}, m AS (SELECT event_name, count(*) AS n,
          CASE WHEN stddev_pop(sentiment) > 0 AND stddev_pop(tweets) > 0 THEN corr(sentiment, tweets) END AS r FROM counts GROUP BY event_name),
        a AS (SELECT *, n - 2 AS df, atan(abs(r) / sqrt(1 - r * r)) AS th FROM m)
        SELECT event_name, n, round(r, 4) AS correlation, round({P_SQL}, 4) AS p_value FROM a"""),
    "trend": (
        lambda spark, sf: correlation.trend(_counts(spark, sf), ["event_name"]),
        f"""WITH {COUNTS_SQL} SELECT event_name, round(CASE WHEN var_pop(sentiment) > 0 THEN regr_slope(tweets, sentiment) END, 4) AS slope,
        round(CASE WHEN var_pop(sentiment) > 0 THEN regr_intercept(tweets, sentiment) END, 4) AS intercept FROM counts GROUP BY event_name"""),
}
