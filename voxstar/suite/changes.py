"""Registered queries: deletions along keys, changes of stored rows, loads side by side, streams with bounded state."""

from __future__ import annotations

from functools import reduce
from threading import Thread

from pyspark.sql import functions as F

from voxstar import seeds
from voxstar.operators.cascade import ForeignKey, cascade, remaining
from voxstar.plans.changes import correct_rows, delete_rows
from voxstar.plans.loads import initial_load, secondary_load, seed_load
from voxstar.session import fresh_dir, stored
from voxstar.sources.tables import Store
from voxstar.streaming.state import STATE_STORE, cap_pages_stream, dedupe_within, drain
from voxstar.suite import captures, keyed, standins as s

TRADE_KEYS = [
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
]
_FIRST = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
          "orders": "o_orderkey", "lineitem": "l_orderkey"}


def _cascade(spark, sf):
    """Region 1, the smallest parts and the orders in progress go, and all that refers to them."""
    tables = {name: s.table(spark, sf, name) for name in _FIRST}
    doomed = {"region": F.col("r_regionkey") == 1, "part": F.col("p_size") <= 2, "orders": F.col("o_orderstatus") == "P"}
    left = remaining(cascade(tables, TRADE_KEYS, doomed))
    return reduce(lambda a, b: a.unionByName(b), [
        rows.select(F.lit(name).alias("table_name"), F.col(_FIRST[name]).cast("long").alias("key"),
                    (F.col("l_linenumber") if name == "lineitem" else F.lit(0)).cast("long").alias("line")) for name, rows in left.items()])


_CASCADE_SQL = """WITH region_ AS (SELECT * FROM region WHERE r_regionkey <> 1),
nation_ AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region_)),
customer_ AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation_)),
supplier_ AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation_)),
part_ AS (SELECT * FROM part WHERE p_size > 2),
orders_ AS (SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IN (SELECT c_custkey FROM customer_)),
lineitem_ AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders_) AND l_suppkey IN (SELECT s_suppkey FROM supplier_)
  AND l_partkey IN (SELECT p_partkey FROM part_))
""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {k}::BIGINT AS key, {'l_linenumber' if t == 'lineitem' else '0'}::BIGINT AS line FROM {t}_" for t, k in _FIRST.items())


def _derived(spark, sf):
    store = captures._loaded(spark, sf)
    secondary_load(store, s.lexicon(spark, sf), "derive")
    return store


def _delete_event(spark, sf):
    """What is left of facts and votes once an event's searches are deleted with their event row."""
    store = _derived(spark, sf)
    seed_load(store)
    delete_rows(store, {"events": F.col("event_name") == seeds.EVENTS[3003 - seeds.EVENT_SEED]}, "delete")
    facts = store.read("tweet_data").join(store.read("searches"), "search_id").groupBy("event_id").agg(
        F.count("*").alias("facts"), F.countDistinct("tweet_id").alias("tweets"))
    votes = store.read("sentiment_category_assignment").join(store.read("tweet_data"), "tweet_id").join(store.read("searches"), "search_id")
    return facts.join(votes.groupBy("event_id").agg(F.count("*").alias("votes")), "event_id", "left").select(
        "event_id", "facts", "tweets", F.coalesce("votes", F.lit(0)).alias("votes"))


def _correct_cities(spark, sf):
    """Cities stored by two loads; the listed ones lose their state, in the partitions that hold them."""
    store = Store(spark, fresh_dir(spark, "store"))
    cities = keyed._cities(spark, sf)
    for part in range(2):
        batch = store.new_batch()
        store.write("cities", cities.filter(F.coalesce(F.col("city_id"), F.lit(0)) % 2 == part), batch)
        store.commit(batch, f"cities {part}")
    correct_rows(store, "cities", "city_id", keyed._FIXES, "state_id", 0)
    return keyed._city_columns(store.read("cities"))


def _parallel_loads(spark, sf):
    """The captures of two halves loaded by two threads at once: every fact once, ids without a gap."""
    store, raw, failed = Store(spark, fresh_dir(spark, "store")), stored(captures._raw(spark, sf), "captured"), []

    def run(half):
        try:
            initial_load(store, raw.filter(F.pmod(F.xxhash64("filepath"), F.lit(2)) == half), f"half {half}")
        except Exception as error:
            failed.append(error)

    threads = [Thread(target=run, args=(half,)) for half in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]
    facts = store.read("tweet_data")
    ids = facts.agg(F.min("data_id").alias("first_id"), F.max("data_id").alias("last_id"), F.countDistinct("data_id").alias("ids")).first()
    found = facts.join(store.read("searches"), "search_id").join(store.read("search_dates"), "search_date_id")
    return found.select("tweet_id", "author_id", "keyword", "event_id", "search_start",
                        *[F.lit(n).cast("long").alias(c) for c, n in ids.asDict().items()])


_PARALLEL_SQL = f"""WITH {captures._POSTS_SQL}
SELECT CAST(doc_id AS VARCHAR) AS tweet_id, author AS author_id, translate(source, '0123456789', 'abcdefghij') AS keyword, event_id,
  CAST(DATE '2015-01-01' + CAST(doc_id // {captures.PAGE} AS INTEGER) AS DATE) AS search_start, 5000 AS first_id,
  4999 + count(*) OVER () AS last_id, count(*) OVER () AS ids
FROM posts JOIN events_of USING (lang)"""

#: Days that arrive together, and how long a key is remembered.
_DAYS, _SPAN = 5, "5 days"
_CHUNKS = 6


def _arrivals(spark, sf, make):
    """Run ``make(stream)`` over the events as they arrive, a stretch of days a time, each run going on where the last one ended."""
    events = s.table(spark, sf, "events")
    source, target, checkpoint = (fresh_dir(spark, n) for n in ("arrivals", "drained", "progress"))
    chunk = F.floor((F.dayofmonth("ts") - 1) / _DAYS)
    for n in range(_CHUNKS):
        sent = make(events.withColumn("ts", F.col("ts").cast("timestamp")), chunk, n)
        sent.write.mode("append").parquet(source)
        yield spark.readStream.schema(sent.schema).parquet(source), target, checkpoint


def _sent(events, chunk, n):
    """What arrives with stretch n: its events, every third once more, every seventh of five stretches ago again, every eleventh of four ago late."""
    own = events.filter(chunk == n).select("event_id", "user_id", "ts")
    twice = own.filter("event_id % 3 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    again = (events.filter(chunk == n - 5).filter("event_id % 7 = 0").select("event_id", "user_id", "ts")
             .withColumn("ts", F.col("ts") + F.make_interval(days=F.lit(5 * _DAYS))))
    late = events.filter(chunk == n - 4).filter("event_id % 11 = 0").select((-F.col("event_id") - 1).alias("event_id"), "user_id", "ts")
    return own.unionByName(twice).unionByName(again).unionByName(late)


def _dedupe_window(spark, sf):
    for stream, target, checkpoint in _arrivals(spark, sf, _sent):
        drain(dedupe_within(stream, ["event_id", "user_id"], "ts", _SPAN), target, checkpoint)
    return spark.read.schema("event_id long, user_id long, ts timestamp").parquet(target).groupBy("event_id", "user_id").agg(F.count("*").alias("kept"))


def _stream_cap(spark, sf):
    make = lambda events, chunk, n: keyed.page_rows(events.filter(chunk == n))
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        for stream, target, checkpoint in _arrivals(spark, sf, make):
            capped = cap_pages_stream(stream, ["event_type", "day"], "event_id", 100)
            drain(capped, target, checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(capped.schema).parquet(target)


QUERIES = {
    "cascade_graph": (_cascade, _CASCADE_SQL),
    "store_delete_event": (_delete_event, f"""WITH {s.LEXICON_SQL}, {captures._POSTS_SQL},
tokens AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '[''@][A-z0-9]+', '', 'g'), '\\s+')) AS term FROM posts),
voted AS (SELECT DISTINCT doc_id FROM tokens t JOIN lexicon l ON l.term = t.term AND association = 1)
SELECT event_id, count(*) AS facts, count(DISTINCT p.doc_id) AS tweets, count(v.doc_id) AS votes
FROM posts p JOIN events_of USING (lang) LEFT JOIN voted v ON v.doc_id = p.doc_id WHERE event_id <> 3003 GROUP BY event_id"""),
    "store_correct_cities": (_correct_cities, keyed.QUERIES["city_correction"][1]),
    "parallel_loads": (_parallel_loads, _PARALLEL_SQL),
    "stream_dedupe_window": (_dedupe_window, f"""SELECT event_id, user_id,
        1 + (event_id % 7 = 0 AND (day(ts) - 1) // {_DAYS} + 5 < {_CHUNKS})::BIGINT AS kept FROM events"""),
    "stream_page_cap": (_stream_cap, keyed.QUERIES["page_cap"][1]),
}
