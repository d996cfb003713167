"""Registered queries that go through lookup files: tables are written as the files the library reads, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstar.functions.text import code_points, tokens
from voxstar.operators import quality
from voxstar.plans import associations
from voxstar.session import fresh_dir
from voxstar.sources import tables
from voxstar.suite import sets, standins as s


def _csv(spark, df, label):
    path = fresh_dir(spark, label)
    df.write.option("header", True).csv(path)
    return path


def _lexicon(spark, sf):
    return tables.read_lexicon(spark, _csv(spark, s.lexicon(spark, sf), "lexicon"))


def _cities(spark, sf):
    c = s.table(spark, sf, "customer")
    text = F.lit(None).cast("string")
    sheet = c.select(F.col("c_name").alias("city"), F.col("c_name").alias("city_ascii"), F.col("c_acctbal").alias("lat"),
                     (-F.col("c_acctbal")).alias("lng"), F.lit("A, B").alias("country"), F.lit("AB").alias("iso2"), text.alias("iso3"),
                     F.col("c_mktsegment").alias("admin_name"), text.alias("capital"), F.col("c_nationkey").cast("double").alias("population"),
                     F.col("c_custkey").cast("int").alias("id"))
    return tables.read_cities(spark, _csv(spark, sheet, "cities")).drop("city_ascii")


_STATES = {0: ("Texas", "TX"), 1: ("Ohio", "OH"), 2: ("District of Columbia", "DC"), 3: ("New Hampshire", "NH")}


def _population(spark, sf):
    names = F.element_at(F.array(*[F.lit(n) for n, _ in _STATES.values()]), (F.col("c_nationkey") % 4 + 1).cast("int"))
    counted = s.table(spark, sf, "customer").groupBy(names.alias("State")).agg(F.sum("c_custkey").alias("Pop"))
    return tables.read_population(spark, _csv(spark, counted, "population"))


def _emoji(spark, sf):
    """One JSON object, as the dictionary file is; it has an entry per letter."""
    letters = s.lexicon_words(spark, sf).select(F.explode(code_points(F.col("term"))).alias("emoji"), "term").distinct()
    entries = letters.groupBy("emoji").agg(F.array_sort(F.collect_set("term")).alias("keywords"))
    path = fresh_dir(spark, "emoji")
    entries.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("emoji", "keywords")))).alias("value")).write.text(path)
    return tables.read_emoji_dict(spark, path).select("emoji", F.explode("terms").alias("term"))


def _export(spark, sf):
    """One JSON array of row objects, as exports are; it has a row per search."""
    rows = s.searches(spark, sf).select(F.col("search_id").alias("SEARCH_ID"), F.col("keyword").alias("KEYWORD"),
                                        F.lit(1000).cast("long").alias("SEARCH_DATE_ID"), F.col("event_id").alias("EVENT_ID"))
    path = fresh_dir(spark, "export")
    rows.agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")).write.text(path)
    return tables.read_export(spark, path, "searches")


def _unknown_associations(spark, sf):
    unknown = F.when((F.col("association") == 0) & (F.length("term") % 5 == 0), F.lit(None)).otherwise(F.col("association"))
    return associations.text_associations(s.texts(spark, sf), s.lexicon(spark, sf).withColumn("association", unknown)) \
        .withColumn("support", F.round("support", 8))


def _own_terms(spark, sf):
    """Another extractor: lower-cased tokens and the tokens' beginnings, some of them empty."""
    def extract(text):
        found = tokens(F.lower(text))
        return F.array_distinct(F.concat(found, F.transform(found, lambda t: F.substring(t, 5, 6))))
    return associations.text_associations(s.texts(spark, sf), s.lexicon(spark, sf), term_extractor=extract) \
        .withColumn("support", F.round("support", 8))


def _run_dates(spark, sf):
    tagged = quality.tag_rejects(s.table(spark, sf, "orders"), {"dear": F.col("o_totalprice") > 250000})
    log = quality.audit(tagged, "INITIAL", "ORDERS", "o_orderstatus")
    return log.select("filepath", (F.datediff(F.current_timestamp(), "run_date") == 0).alias("today"))


QUERIES = {
    "lexicon_file": (_lexicon, f"WITH {s.LEXICON_SQL} SELECT term, emotion, association FROM lexicon"),
    "cities_file": (_cities, """SELECT c_name AS city, c_acctbal AS lat, -c_acctbal AS lng, 'A, B' AS country, 'AB' AS iso2, NULL AS iso3,
        c_mktsegment AS admin_name, NULL AS capital, c_nationkey::DOUBLE AS population, c_custkey::INT AS id FROM customer"""),
    "population_file": (_population, """SELECT ['TX', 'OH', 'DC', 'NH'][1 + c_nationkey % 4] AS state, sum(c_custkey)::BIGINT AS pop
        FROM customer GROUP BY 1"""),
    "emoji_file": (_emoji, f"""WITH {s.LEXICON_SQL}, l AS (SELECT DISTINCT term, c FROM (SELECT term, unnest(string_split(term, '')) AS c FROM words) WHERE NOT regexp_matches(c, '[A-Za-z]'))
        SELECT c AS emoji, unnest(list_sort(list(term))[2:]) AS term FROM l GROUP BY c"""),
    "export_file": (_export, f"WITH {s.STAR_SQL} SELECT search_id, keyword, 1000 AS search_date_id, event_id FROM searches"),
    "text_associations_unknown": (_unknown_associations, "WITH " + sets.TEXT_ASSOC_SQL.replace(
        "text_assoc AS (", """guessed AS (SELECT term, emotion, CASE WHEN association = 0 AND length(term) % 5 = 0 THEN NULL ELSE association END AS association
          FROM lexicon), text_assoc AS (""").replace("JOIN lexicon l ON l.term = p.term", "JOIN guessed l ON l.term = p.term").replace(
        "association <> 0", "association IS DISTINCT FROM 0") + " SELECT term, round(support, 8) AS support, emotion, association, sent_id FROM text_assoc"),
    "text_associations_own_terms": (_own_terms, f"""WITH {s.LEXICON_SQL}, {s.TEXTS_SQL},
        kept AS (SELECT tweet_id, string_split_regex(lower(tweet_text), '\\s+') AS t FROM texts WHERE tweet_text NOT LIKE '%Just posted a%'),
        found AS (SELECT DISTINCT tweet_id, term FROM (SELECT tweet_id, unnest(t) AS term FROM kept
          UNION ALL SELECT tweet_id, substr(x, 5, 6) FROM (SELECT tweet_id, unnest(t) AS x FROM kept))),
        supports AS (SELECT term, count(*) * 1.0e0 / (SELECT count(*) FROM kept) AS support FROM found
          WHERE term IN (SELECT term FROM lexicon WHERE association = 1) GROUP BY term)
        SELECT l.term, round(support, 8) AS support, emotion, association,
          CASE WHEN emotion IN ('anticipation', 'joy', 'surprise', 'trust', 'positive') THEN 333 ELSE 666 END AS sent_id
        FROM supports p JOIN lexicon l ON l.term = p.term WHERE support >= 0.005 AND association <> 0"""),
    "audit_run_dates": (_run_dates, "SELECT DISTINCT o_orderstatus AS filepath, true AS today FROM orders"),
}
