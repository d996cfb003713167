"""Registered queries: itemsets, indicator matrices, term and emoji associations."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstar import seeds
from voxstar.functions.text import tokens
from voxstar.operators.paging import top_n
from voxstar.plans import associations, events, mining, words
from voxstar.suite import standins as s

TYPES = ["click", "error", "purchase", "signup", "view"]
TXN = ["user_id", "day"]


def _txns(spark, sf):
    return s.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")


TXN_SQL = """b AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, day FROM b))"""

def _k_sql(k):
    """Counts of the k-sets: each further item is joined on the transaction and follows the one before."""
    names = " || ', ' || ".join(f"t{i}.event_type" for i in range(k))
    joins = "".join(f" JOIN b t{i} ON t{i}.user_id = t0.user_id AND t{i}.day = t0.day AND t{i}.event_type > t{i - 1}.event_type" for i in range(1, k))
    return f"SELECT {names} AS items, {k} AS k, count(*) AS freq FROM b t0{joins} GROUP BY 1"


K_SQL = {k: _k_sql(k) for k in range(1, 6)}


def _sets_sql(sizes, level):
    union = " UNION ALL ".join(K_SQL[k] for k in sizes)
    return f"""{TXN_SQL}, f(items, k, freq) AS ({union}),
    sets AS (SELECT items, k, freq, freq * 1.0e0 / n AS support FROM f CROSS JOIN n WHERE freq * 1.0e0 / n >= {level})"""


def _flat(itemsets):
    return itemsets.select(F.array_join("items", ", ").alias("items"), "freq", F.round("support", 8).alias("support"))


def _itemsets(k, level, **options):
    return lambda spark, sf: _flat(mining.frequent_itemsets(_txns(spark, sf), TXN, "event_type", level, k, **options))


def _itemsets_sql(k, level):
    return f"WITH {_sets_sql([k], level)} SELECT items, freq, round(support, 8) AS support FROM sets"


def _itemset_sentiment(spark, sf):
    """Event types read as emotions: two of the five count as positive, one as neither."""
    emotion = F.col("event_type")
    for value, feeling in FEELINGS.items():
        emotion = F.when(F.col("event_type") == value, F.lit(feeling)).otherwise(emotion)
    felt = _txns(spark, sf).withColumn("event_type", emotion)
    labelled = mining.label_itemsets(mining.frequent_itemsets(felt, TXN, "event_type", 0.001, 3))
    return labelled.select("itemsets", "freq", "sentiment")


FEELINGS = {"click": "joy", "error": "anger", "purchase": "trust", "signup": "fear", "view": "sadness"}
_FEEL_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEELINGS.items()) + " END"


def _support_stats(spark, sf):
    sets = mining.frequent_itemsets(_txns(spark, sf), TXN, "event_type", 0.001, None)
    stats = mining.support_stats(sets.withColumn("k", F.size("items")), ["k"])
    return stats.select("k", F.round("max_support", 8).alias("max_support"), F.round("median_support", 8).alias("median_support"))


LEVELS = {**seeds.EVENT_SUPPORT}


def _by_event(spark, sf):
    dims = seeds.seed_tables(spark)
    assoc = words.word_association(s.texts(spark, sf), s.lexicon(spark, sf))
    placed = events.emotions_by_event(assoc.select("tweet_id", "emotion").distinct(), s.tweet_data(spark, sf),
                                      s.searches(spark, sf), dims["events"])
    sets = mining.frequent_itemsets_by(placed, "event_name", ["data_id"], "emotion", seeds.EMOTIONS, LEVELS, 3)
    return mining.label_itemsets(sets).select("event_name", "itemsets", "freq", F.round("support", 8).alias("support"), "sentiment")


def _by_event_sql():
    level = "CASE event_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEVELS.items()) + " END"
    score = " + ".join("CASE WHEN {0} IN ({1}) THEN 1 ELSE -1 END".format(
        c, ", ".join(f"'{e}'" for e in seeds.POSITIVE_EMOTIONS)) for c in ("e1", "e2", "e3"))
    return f"""WITH {s.ASSOC_SQL}, {s.STAR_SQL},
    d AS (SELECT DISTINCT data_id, event_name, emotion FROM assoc a JOIN tweet_data td ON td.tweet_id = a.tweet_id
      JOIN searches s ON s.search_id = td.search_id JOIN events_dim e ON e.event_id = s.event_id),
    n AS (SELECT event_name, count(*) AS n FROM (SELECT DISTINCT data_id, event_name FROM d) GROUP BY 1),
    f AS (SELECT x.event_name, x.emotion AS e1, y.emotion AS e2, z.emotion AS e3, count(*) AS freq FROM d x
      JOIN d y ON y.data_id = x.data_id AND y.emotion > x.emotion
      JOIN d z ON z.data_id = x.data_id AND z.emotion > y.emotion
      GROUP BY ALL)
    SELECT f.event_name, e1 || ', ' || e2 || ', ' || e3 AS itemsets, freq, round(freq * 1.0e0 / n, 8) AS support,
           CASE WHEN {score} > 0 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM f JOIN n ON n.event_name = f.event_name WHERE freq * 1.0e0 / n >= {level.replace('event_name', 'f.event_name')}"""


def _matrix(spark, sf):
    return mining.indicator_matrix(_txns(spark, sf), TXN, "event_type", TYPES)


_MATRIX_SQL = "SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(
    f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS \"{t}\"" for t in TYPES) + " FROM events GROUP BY ALL"


def _text_assoc(spark, sf):
    return associations.text_associations(s.texts(spark, sf), s.lexicon(spark, sf))


def _rounded(df):
    return df.withColumn("support", F.round("support", 8))


TEXT_ASSOC_SQL = f"""{s.LEXICON_SQL}, {s.TEXTS_SQL},
kept AS (SELECT tweet_id, regexp_replace(replace(replace(tweet_text, '@', ''), '#', ''), 'https?://[^\\n]*', '', 'g') AS t
  FROM texts WHERE tweet_text NOT LIKE '%Just posted a%'),
present AS (SELECT DISTINCT tweet_id, unnest(string_split_regex(t, '\\s+')) AS term FROM kept),
supports AS (SELECT term, count(*) * 1.0e0 / (SELECT count(*) FROM kept) AS support FROM present
  WHERE term IN (SELECT term FROM lexicon WHERE association = 1) GROUP BY term),
text_assoc AS (SELECT p.term, support, emotion, association,
    CASE WHEN emotion IN ({", ".join(f"'{e}'" for e in seeds.POSITIVE_EMOTIONS)}) THEN 333 ELSE 666 END AS sent_id
  FROM supports p JOIN lexicon l ON l.term = p.term WHERE support >= 0.005 AND association <> 0)"""


def _phrases(spark, sf):
    """The stand-in lexicon with the first two and three words of every benchmark passage, and pairs of words within it."""
    words = tokens(F.col("text"))
    items = s.table(spark, sf, "benchmark").select(words.alias("w"))
    runs = F.array(F.slice("w", 1, 2), F.slice("w", 1, 3), F.slice("w", 4, 2))
    phrases = items.select(F.explode(F.transform(runs, lambda r: F.array_join(r, " "))).alias("term")).distinct()
    emotion = F.element_at(F.array(*[F.lit(e) for e in s.EMOTIONS]), (F.length("term") % 10 + 1).cast("int"))
    lexicon = s.lexicon(spark, sf).select("term", "emotion", "association").unionByName(
        phrases.select("term", emotion.alias("emotion"), F.lit(1).alias("association")))
    return associations.phrase_associations(s.texts(spark, sf), lexicon, min_support=0.001)


_PHRASES_SQL = f"""WITH {s.LEXICON_SQL}, {s.TEXTS_SQL},
items AS (SELECT list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS w FROM benchmark),
phrases AS (SELECT DISTINCT unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' '), array_to_string(w[4:5], ' ')]) AS term FROM items),
terms AS (SELECT term, emotion, association FROM lexicon
  UNION ALL SELECT term, ({s.EMOTIONS!r})[1 + length(term) % 10], 1 FROM phrases),
kept AS (SELECT tweet_id, list_filter(string_split_regex(regexp_replace(replace(replace(tweet_text, '@', ''), '#', ''), 'https?://[^\n]*', '', 'g'), '\\s+'),
    lambda w: w <> '') AS t FROM texts WHERE tweet_text NOT LIKE '%Just posted a%'),
grams AS (SELECT DISTINCT tweet_id, array_to_string(t[i:i + k], ' ') AS term FROM kept, unnest(range(1, len(t) + 1)) a(i), (VALUES (0), (1), (2)) b(k)
  WHERE i + k <= len(t)),
supports AS (SELECT term, count(*) * 1.0e0 / (SELECT count(*) FROM kept) AS support FROM grams
  WHERE term IN (SELECT term FROM terms WHERE association = 1) GROUP BY term)
SELECT p.term, round(support, 8) AS support, emotion, association,
  CASE WHEN emotion IN ({", ".join(f"'{e}'" for e in seeds.POSITIVE_EMOTIONS)}) THEN 333 ELSE 666 END AS sent_id
FROM supports p JOIN terms l ON l.term = p.term WHERE support >= 0.001 AND association <> 0"""


def _emoji_assoc(spark, sf):
    return _rounded(associations.emoji_associations(s.texts(spark, sf), s.emoji_names(spark, sf),
                                                    s.emoji_dictionary(spark, sf), s.lexicon(spark, sf)))


def _frequent_emoji(denominator):
    def run(spark, sf):
        tweets = s.texts(spark, sf)
        found = associations.tweet_emojis(tweets, s.emoji_names(spark, sf))
        return _rounded(associations.frequent_emoji(found, s.emoji_dictionary(spark, sf), denominator=denominator, tweets=tweets))
    return run


def _terms(spark, sf):
    used = words.token_rows(s.texts(spark, sf)).select("term")
    return used.intersect(words.active_lexicon(s.lexicon(spark, sf)).select("term"))


def _terms_unused(spark, sf):
    known = words.active_lexicon(s.lexicon(spark, sf)).select("term")
    return known.distinct().join(words.token_rows(s.texts(spark, sf)).select("term").distinct(), "term", "left_anti")


SUPPLIERS = [f"s{i:02}" for i in range(20)]


def _wide(spark, sf):
    """Baskets of twenty items: the supplier classes of an order's lines, apart by return flag."""
    lines = s.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", F.concat(F.lit("s"), F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0")).alias("supplier"))
    sets = mining.frequent_itemsets_by(lines, "l_returnflag", ["l_orderkey"], "supplier", SUPPLIERS, 0.01, None)
    return sets.select("l_returnflag", F.array_join("items", ", ").alias("items"), "freq", F.round("support", 8).alias("support"))


_WIDE_SQL = """WITH b AS (SELECT DISTINCT l_returnflag AS g, l_orderkey AS o, 's' || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') AS i FROM lineitem),
n AS (SELECT g, count(DISTINCT o) AS n FROM b GROUP BY g),
f AS (SELECT g, i AS items, count(*) AS freq FROM b GROUP BY ALL
  UNION ALL SELECT x.g, x.i || ', ' || y.i, count(*) FROM b x JOIN b y ON y.g = x.g AND y.o = x.o AND y.i > x.i GROUP BY ALL
  UNION ALL SELECT x.g, x.i || ', ' || y.i || ', ' || z.i, count(*) FROM b x JOIN b y ON y.g = x.g AND y.o = x.o AND y.i > x.i
    JOIN b z ON z.g = x.g AND z.o = x.o AND z.i > y.i GROUP BY ALL)
SELECT f.g AS l_returnflag, items, freq, round(freq * 1.0e0 / n, 8) AS support FROM f JOIN n USING (g) WHERE freq * 1.0e0 / n >= 0.01"""


QUERIES = {
    "frequent_itemsets_by_wide": (_wide, _WIDE_SQL),
    "frequent_itemsets_k1": (_itemsets(1, 0.005), _itemsets_sql(1, 0.005)),
    "frequent_itemsets_k2": (_itemsets(2, 0.005), _itemsets_sql(2, 0.005)),
    "frequent_itemsets_k3": (_itemsets(3, 0.005), _itemsets_sql(3, 0.005)),
    "frequent_itemsets_tree": (_itemsets(3, 0.005, mask_items=2), _itemsets_sql(3, 0.005)),
    "frequent_itemsets_counted": (_itemsets(1, 0.005, mask_items=2), _itemsets_sql(1, 0.005)),
    "frequent_itemsets_by_event": (_by_event, _by_event_sql()),
    "itemset_sentiment": (
        _itemset_sentiment,
        f"""WITH b AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, {_FEEL_CASE} AS event_type FROM events),
        f(itemsets, k, freq) AS ({K_SQL[3]}), n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, day FROM b))
        SELECT itemsets, freq, CASE WHEN len(list_filter(string_split(itemsets, ', '), lambda e: e IN ('joy', 'trust'))) > 1
            THEN 'positive' ELSE 'negative' END AS sentiment FROM f CROSS JOIN n WHERE freq * 1.0e0 / n >= 0.001"""),
    "support_stats": (
        _support_stats,
        f"""WITH {_sets_sql([1, 2, 3, 4, 5], 0.001)}
        SELECT k, round(max(support), 8) AS max_support, round(median(support), 8) AS median_support FROM sets GROUP BY k"""),
    "indicator_matrix": (_matrix, _MATRIX_SQL),
    "indicator_long": (
        lambda spark, sf: mining.indicator_long(_matrix(spark, sf), TXN, TYPES),
        f"UNPIVOT ({_MATRIX_SQL}) ON {', '.join(TYPES)} INTO NAME item VALUE present"),
    "text_associations": (
        lambda spark, sf: _rounded(_text_assoc(spark, sf)),
        f"WITH {TEXT_ASSOC_SQL} SELECT term, round(support, 8) AS support, emotion, association, sent_id FROM text_assoc"),
    "phrase_associations": (lambda spark, sf: _rounded(_phrases(spark, sf)), _PHRASES_SQL),
    "top_support": (
        lambda spark, sf: top_n(_rounded(_text_assoc(spark, sf)), 20, F.col("support").desc(), "term", "emotion"),
        f"""WITH {TEXT_ASSOC_SQL} SELECT term, round(support, 8) AS support, emotion, association, sent_id FROM text_assoc
        ORDER BY support DESC, term, emotion LIMIT 20"""),
    "frequent_emoji": (
        _frequent_emoji("rows"),
        f"WITH {s.EMOJI_SQL} SELECT emoji, round(support, 8) AS support FROM emoji_support"),
    "frequent_emoji_tweets": (
        _frequent_emoji("tweets"),
        f"""WITH {s.EMOJI_SQL}, f AS (SELECT emoji, count(*) * 1.0e0 / (SELECT count(*) FROM texts) AS support FROM tweet_emojis GROUP BY emoji)
        SELECT emoji, round(support, 8) AS support FROM f WHERE support >= 0.005"""),
    "emoji_terms": (
        lambda spark, sf: associations.emoji_terms(
            associations.tweet_emojis(s.texts(spark, sf), s.emoji_names(spark, sf)), s.emoji_dictionary(spark, sf))
        .select("tweet_id", "emoji", "name", "term"),
        f"WITH {s.EMOJI_SQL} SELECT tweet_id, emoji, name, term FROM emoji_rows"),
    "emoji_associations": (
        _emoji_assoc,
        f"""WITH {s.EMOJI_SQL} SELECT tweet_id, r.emoji, r.name, r.term, round(support, 8) AS support, emotion, association,
            CASE WHEN emotion IN ({", ".join(f"'{e}'" for e in seeds.POSITIVE_EMOTIONS)}) THEN 333 ELSE 666 END AS sent_id
        FROM emoji_rows r JOIN emoji_support p ON p.emoji = r.emoji JOIN lexicon l ON l.term = r.term AND association = 1"""),
    "term_intersection": (
        _terms,
        f"""WITH {s.ASSOC_SQL} SELECT term FROM tokens INTERSECT SELECT term FROM lexicon WHERE association = 1"""),
    "term_difference": (
        _terms_unused,
        f"""WITH {s.ASSOC_SQL} SELECT term FROM lexicon WHERE association = 1 EXCEPT SELECT term FROM tokens"""),
}
