"""Initial and secondary loads into the star-schema store."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from voxstar.operators.keys import correct, fix_rows, number_fixed, resolve_id, tag_exists, tag_first, upsert_dim
from voxstar.operators.quality import REASON, load_counts, tag_rejects, unquotable
from voxstar.plans.geo import author_location, build_cities
from voxstar.plans.views import vw_tweet_text
from voxstar.plans.words import sentiment_vote, word_association
from voxstar.seeds import CITY_CORRECTIONS, DATA_SEED, SEARCH_DATE_SEED, SEARCH_SEED, WORD_SEED, seed_tables
from voxstar.sources.payloads import parse_payloads, payload_items, with_search_meta
from voxstar.sources.tables import CAPTURE, DERIVATION, SEED, STORED_KEYS, StaleCommit, Store, key_bucket

INITIAL, SECONDARY = "INITIAL", "SECONDARY"
NO_ROWS = "no rows"  # marks a file that brought a table nothing
ORDER = ["filepath", "pos"]
FACT_KEY = STORED_KEYS["tweet_data"]
#: How often a load that another one overtook starts again before it gives up.
ATTEMPTS = 3


def _opens_key(df: DataFrame, stored: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Mark (``_opens``) the rows that are first of their key and not stored yet.

    Only first rows are looked up in the stored table, and those are unique per
    key, so the look-up meets no hot key.
    """
    tagged = tag_first(df, keys, order, "_first")
    known = stored.select(*keys, F.lit(True).alias("_stored"))
    firsts = tagged.filter("_first").join(known, keys, "left")
    others = tagged.filter("NOT _first").withColumn("_stored", F.lit(None).cast("boolean"))
    return (firsts.unionByName(others)
            .withColumn("_opens", F.col("_first") & F.col("_stored").isNull())
            .drop("_first", "_stored"))


def _opens_kept(store: Store, name: str, batch_id: int, df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """``_opens_key`` for rows that carry much: only keys, order and ``item``, the rows' own number, are shuffled for it.

    What it found is kept as the numbers of the rows that open a key and of those that do not; the fewer of the two are joined to
    the rows, by broadcast while they are few. A load that is all new or all known joins nothing.
    """
    found = _opens_key(df.select("item", *keys, *ORDER), stored, keys, ORDER).select("item", "_opens")
    counts = dict(store.keep(name, found, batch_id, "_opens").groupBy("_opens").count().collect())
    fewer = counts.get(True, 0) < counts.get(False, 0)
    if not counts.get(fewer):
        return df.withColumn("_opens", F.lit(not fewer))
    numbers = store.kept_part(name, batch_id, f"_opens={str(fewer).lower()}", "item long").withColumn("_listed", F.lit(True))
    return df.join(numbers, "item", "left").withColumn("_opens", F.col("_listed").isNotNull() == F.lit(fewer)).drop("_listed")


def users_load(users: DataFrame, stored: DataFrame, quoting: bool = False) -> DataFrame:
    """Users of a load, each row with its reject reason or null."""
    rows = _opens_key(users, stored, ["author_id"], ORDER)
    rules = {"missing key": F.col("author_id").isNull()}
    if quoting:
        rules["both quote kinds"] = unquotable("location", "description")
    return tag_rejects(rows, {**rules, "duplicate key": ~F.col("_opens")}).drop("_opens")


def texts_load(rows: DataFrame, quoting: bool = False) -> DataFrame:
    """Texts of a load, marked ``_opens`` where they open their key, each row with its reject reason or null."""
    rules = {"missing key": F.col("tweet_id").isNull()}
    if quoting:
        rules["both quote kinds"] = unquotable("tweet", "retweet_text")
    return tag_rejects(rows, {**rules, "duplicate key": ~F.col("_opens")}).drop("_opens")


def facts_load(facts: DataFrame, stored: DataFrame, users: DataFrame, texts: DataFrame) -> DataFrame:
    """Facts of a load (with search_id), each row with its reject reason or null.

    A fact needs a loaded author and text. (tweet, author, search) is its natural
    key, so loading a file again adds nothing.
    """
    rows = _opens_key(facts, stored, FACT_KEY, ORDER)
    rows = tag_exists(rows, users, "author_id", "author_id", "_author", unique=True)
    rows = tag_exists(rows, texts, "tweet_id", "tweet_id", "_text", unique=True)
    rules = {"missing key": F.col("tweet_id").isNull() | F.col("author_id").isNull(),
             "unknown author": ~F.col("_author"), "unknown text": ~F.col("_text"),
             "duplicate key": ~F.col("_opens")}
    return tag_rejects(rows, rules).drop("_opens", "_author", "_text")


def number_accepted(tagged: DataFrame, id_column: str, start: int, order: list[str] | None = None) -> DataFrame:
    """Dense ids for the accepted rows, in ``order`` if given; rejected rows get none."""
    placed = tagged.repartitionByRange(*order).sortWithinPartitions(*order) if order else tagged
    fixed = fix_rows(placed)
    accepted = number_fixed(fixed.filter(F.col(REASON).isNull()), id_column, start)
    return accepted.unionByName(fixed.filter(F.col(REASON).isNotNull()), allowMissingColumns=True)


def cities_load(world: DataFrame, us_states: DataFrame, stored: DataFrame) -> DataFrame:
    """Cities with their state, each row with its reject reason or null.

    The listed cities, whose province shares a state's name by accident, lose their state.
    """
    built = correct(build_cities(world, us_states), "city_id", CITY_CORRECTIONS, "state_id", 0)
    rows = _opens_key(built, stored, ["city_id"], ["city", "lat", "lng", "state_id"])
    return tag_rejects(rows, {"missing key": F.col("city_id").isNull(),
                              "duplicate key": ~F.col("_opens")}).drop("_opens")


def _dimension_log(files: DataFrame, created: DataFrame, known: DataFrame) -> list[DataFrame]:
    """Audit rows of the dimension upserts: a search window once, with the first file that brought it, and each file's search."""
    window = ["search_start", "search_end"]
    first = files.groupBy(*window).agg(F.min("filepath").alias("filepath")).join(created.select(*window), window)
    log = lambda df, comment: df.select(F.current_timestamp().alias("run_date"), F.lit(INITIAL).alias("load_type"),
                                        comment.alias("comment"), "filepath")
    return [log(first, F.format_string("SEARCH_DATES: '%s','%s'", F.col("search_start").cast("string"), F.col("search_end").cast("string"))),
            log(known, F.format_string("SEARCHES: '%s', '%s', '%s'", "keyword", "search_date_id", "event_id"))]


def _file_log(store: Store, labels: dict[str, str], batch_id: int, files: DataFrame) -> DataFrame:
    """Audit rows of a load's tables, one per table and file, "0 LOADED, 0 SKIPPED" where a file brought none; one pass over all tables."""
    tried = reduce(lambda a, b: a.unionByName(b), [
        store.attempted(table, batch_id).withColumn("label", F.lit(label)) for table, label in labels.items()])
    named = F.explode(F.array(*[F.lit(label) for label in labels.values()])).alias("label")
    idle = files.select("filepath", named).withColumn(REASON, F.lit(NO_ROWS))
    counts = load_counts(tried.unionByName(idle), ["label", "filepath"], nothing=NO_ROWS)
    return counts.select(F.current_timestamp().alias("run_date"), F.lit(INITIAL).alias("load_type"),
                         F.format_string("%s: %d LOADED, %d SKIPPED", "label", "loaded", "skipped").alias("comment"), "filepath")


def together(*steps: Callable[[], object]) -> list:
    """Run steps that do not need each other at the same time; each is a Spark job of its own. All end before a failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(step)) for step in steps]
        wait(running)
        return [r.result() for r in running]


def _counted_log(store: Store, load_type: str, path: str | None, counts: dict[str, tuple[int, int]]) -> list[DataFrame]:
    """Audit rows of tables derived as a whole, from the counts taken while they were written; nothing for a table without rows."""
    row = lambda label, loaded, skipped: store.spark.range(1).select(
        F.current_timestamp().alias("run_date"), F.lit(load_type).alias("load_type"),
        F.lit(f"{label}: {loaded} LOADED, {skipped} SKIPPED").alias("comment"), F.lit(path).cast("string").alias("filepath"))
    return [row(label, *n) for label, n in counts.items() if any(n)]


def _finish(store: Store, logs: list[DataFrame], batch_id: int, load_key: str, kind: str, **marks) -> DataFrame:
    """Write a load's audit rows, then commit it."""
    if logs:
        store.write("run_log", reduce(lambda a, b: a.unionByName(b), logs), batch_id)
    store.commit(batch_id, load_key, kind, **marks)
    return store.read("run_log", batch_id)


def loaded_once(store: Store, load_key: str | None, run: Callable[[Store, int, str], DataFrame]) -> DataFrame:
    """Run a load on a snapshot; start again on a new one when another load was committed meanwhile.

    What a failed or overtaken attempt wrote is removed. A finished ``load_key`` is skipped.
    """
    for attempt in range(ATTEMPTS):
        batch_id = store.new_batch()
        key = load_key or f"load-{batch_id}"
        if store.has(key):
            return store.read("run_log").limit(0)
        try:
            return run(store.snapshot(), batch_id, key)
        except BaseException as failure:
            if store.commits().filter(F.col("batch_id") == batch_id).isEmpty():
                store.discard(batch_id)
            if not isinstance(failure, StaleCommit) or attempt == ATTEMPTS - 1:
                raise


def seed_load(store: Store, world: DataFrame | None = None) -> None:
    """Write the seeded dimensions, and the cities if given, once."""
    def run(snapshot: Store, batch_id: int, load_key: str) -> DataFrame:
        dims = seed_tables(store.spark)
        for table, rows in dims.items():
            snapshot.write(table, rows, batch_id)
        if world is not None:
            snapshot.write("cities", cities_load(world, dims["us_states"], snapshot.read("cities")), batch_id)
        return _finish(snapshot, [], batch_id, load_key, SEED)

    loaded_once(store, "seed", run)


def initial_load(store: Store, raw: DataFrame, load_key: str | None = None, quoting: bool = False) -> DataFrame:
    """Load captured payloads (filepath, value); returns the run_log rows of the load.

    Order: users, texts, search windows, searches, facts, log. The payloads are
    parsed once into user, text, fact and file rows, and later steps read what
    earlier ones wrote: a lost executor never repeats a finished step. Stored keys are looked up in the buckets that the load's
    own keys fall into. A finished ``load_key`` is skipped, and a load overtaken by another starts again.
    """
    return loaded_once(store, load_key, lambda snapshot, batch_id, key: _initial(snapshot, raw, batch_id, key, quoting))


def _initial(store: Store, raw: DataFrame, batch_id: int, load_key: str, quoting: bool) -> DataFrame:
    parsed = payload_items(with_search_meta(parse_payloads(raw))).withColumn("item", F.monotonically_increasing_id())
    items = store.keep("captures", parsed, batch_id, "kind")
    part = lambda kind, *more: items.filter(F.col("kind") == kind).select(*more, "filepath", f"{kind}.*")
    users, texts, facts, files = part("user"), part("text", "item"), part("fact"), part("file")
    unnamed = F.col("event_id").isNull() | F.col("search_start").isNull() | F.col("search_end").isNull()
    tagged = tag_rejects(files, {"unreadable": F.col("corrupt").isNotNull(), "file name": unnamed})
    bad = tagged.filter(F.col(REASON).isNotNull())
    files = tagged.filter(F.col(REASON).isNull()).select("filepath", "search_start", "search_end", "keyword", "event_id").distinct()
    # the buckets of all keys of the load, in one pass: at most KEY_BUCKETS numbers each
    buckets = {f"{kind}.{key}": F.collect_set(key_bucket([f"{kind}.{key}"])) for kind, key in (
        ("user", "author_id"), ("text", "tweet_id"), ("fact", "author_id"), ("fact", "tweet_id"))}
    touched = dict(zip(buckets, items.agg(*[F.array_sort(found).alias(str(i)) for i, found in enumerate(buckets.values())]).first()))

    def load_users():
        store.write("users", users_load(users, store.known("users", touched=touched["user.author_id"]), quoting), batch_id)
        store.write_keys("users", batch_id)

    def load_texts():
        known = store.known("tweet_text", touched=touched["text.tweet_id"])
        store.write("tweet_text", texts_load(_opens_kept(store, "text_opens", batch_id, texts, known, ["tweet_id"]), quoting), batch_id)
        store.write_keys("tweet_text", batch_id)

    def load_searches():
        window, search = ["search_start", "search_end"], ["keyword", "search_date_id", "event_id"]
        stored_dates, stored_searches = store.read("search_dates"), store.read("searches")
        _, new_dates = upsert_dim(stored_dates, files, window, "search_date_id", SEARCH_DATE_SEED)
        store.write("search_dates", new_dates, batch_id)
        dates = stored_dates.unionByName(store.read("search_dates", batch_id))
        dated = resolve_id(files, dates, window, "search_date_id")
        _, new_searches = upsert_dim(stored_searches, dated, search, "search_id", SEARCH_SEED)
        store.write("searches", new_searches, batch_id)
        searches = stored_searches.unionByName(store.read("searches", batch_id))
        return fix_rows(resolve_id(dated, searches, search, "search_id"))

    *_, known = together(load_users, load_texts, lambda: store.write(
        "payload", bad.select("filepath", F.col("corrupt").alias("payload"), REASON), batch_id), load_searches)

    # fixed, because the check of the facts reads them four times, and each copy of their plan takes memory of the driver
    found = fix_rows(facts.join(known.select("filepath", "search_id"), "filepath"))
    own = lambda table: store.read(table, batch_id).select(*STORED_KEYS[table])
    judged = facts_load(found, store.known("tweet_data", touched=touched["fact.tweet_id"]),
                        store.known("users", touched=touched["fact.author_id"]).unionByName(own("users")),
                        store.known("tweet_text", touched=touched["fact.tweet_id"]).unionByName(own("tweet_text")))
    first = store.next_id("data_id", DATA_SEED)
    loaded, _ = store.write("tweet_data", number_accepted(judged, "data_id", first, ORDER), batch_id)

    refused = bad.select(F.current_timestamp().alias("run_date"), F.lit(INITIAL).alias("load_type"),
                         F.concat(F.lit("FILE REJECTED: "), REASON).alias("comment"), "filepath")
    logs = [*_dimension_log(files, store.read("search_dates", batch_id), known), refused,
            _file_log(store, {"users": "USERS", "tweet_text": "TEXT", "tweet_data": "TWEET_DATA"}, batch_id, files)]
    together(lambda: store.write_keys("tweet_data", batch_id),
             lambda: store.write("run_log", reduce(lambda a, b: a.unionByName(b), logs), batch_id))
    log = _finish(store, [], batch_id, load_key, CAPTURE, next_ids={"data_id": first + loaded})
    for name in ("captures", "text_opens"):
        store.drop(name, batch_id)
    return log


def _newly_captured(store: Store, table: str, key: str) -> DataFrame:
    """Rows of a parent table to derive from now, marked ``_fact`` when a fact refers to them.

    These are the rows of loads not derived from yet, and older rows whose first
    fact came with those loads. Older partitions are only read when there are any.
    """
    new_facts = store.read_captured("tweet_data", derived=False).select(key)
    arrived = tag_exists(store.read_captured(table, derived=False), new_facts, key, key, "_fact")
    if not store.derived_to():
        return arrived
    late = (new_facts.distinct().join(arrived.select(key), key, "left_anti")
            .join(store.read_captured("tweet_data", derived=True).select(key).distinct(), key, "left_anti"))
    if late.isEmpty():
        return arrived
    waited = store.read_captured(table, derived=True).join(late, key, "left_semi").withColumn("_fact", F.lit(True))
    return arrived.unionByName(waited)


def secondary_load(store: Store, lexicon: DataFrame, load_key: str | None = None,
                   us_states: DataFrame | None = None) -> DataFrame:
    """Word associations, sentiment votes and author states of the captures not derived from yet.

    A tweet or author is derived once, with the load that brings its first fact;
    rows without a fact are rejected. Returns the run_log rows of the load.
    """
    return loaded_once(store, load_key, lambda snapshot, batch_id, key: _secondary(snapshot, lexicon, batch_id, key, us_states))


def _secondary(store: Store, lexicon: DataFrame, batch_id: int, load_key: str, us_states: DataFrame | None) -> DataFrame:
    states = us_states if us_states is not None else seed_tables(store.spark)["us_states"]
    source, first = "VW_TWEET_TEXT", store.next_id("wa_id", WORD_SEED)

    def load_words():
        shown = vw_tweet_text(_newly_captured(store, "tweet_text", "tweet_id"), keep=["_fact"])
        words = tag_rejects(word_association(shown, lexicon, keep=["_fact"]), {"unknown tweet": ~F.col("_fact")})
        made = store.write("word_association", number_accepted(words.withColumn("filepath", F.lit(source)), "wa_id", first), batch_id)
        return made, store.write("sentiment_category_assignment", sentiment_vote(store.read("word_association", batch_id)), batch_id)

    def load_places():
        users = _newly_captured(store, "users", "author_id")
        places = tag_rejects(author_location(users, states, keep=["_fact"]), {"unknown author": ~F.col("_fact")})
        return store.write("author_location", places, batch_id)

    (words, votes), places = together(load_words, load_places)
    logs = [*_counted_log(store, SECONDARY, source, {"WORD_ASSOCIATION": words}),
            *_counted_log(store, SECONDARY, None, {"TWEET_SENT_CAT": votes, "AUTHOR_LOCATION": places})]
    return _finish(store, logs, batch_id, load_key, DERIVATION, covers_to=store.version, next_ids={"wa_id": first + words[0]})
