"""Deletions and corrections of stored rows: touched partitions are written anew, one commit makes the change visible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxstar.operators.cascade import GONE, ForeignKey, cascade, deleted_counts
from voxstar.operators.keys import correct
from voxstar.plans.loads import loaded_once
from voxstar.session import stored
from voxstar.sources.tables import REWRITE, Store

DELETE, CORRECT = "DELETE", "CORRECTION"

#: The foreign keys of the warehouse, all deleting along. Facts hold a tweet and an author more than once.
SCHEMA_KEYS = [
    ForeignKey("divisions", "reg_id", "regions", "reg_id"),
    ForeignKey("us_states", "div_id", "divisions", "div_id"),
    ForeignKey("category", "event_id", "events", "event_id"),
    ForeignKey("category", "cat_name_id", "cat_name", "name_id"),
    ForeignKey("searches", "search_date_id", "search_dates", "search_date_id"),
    ForeignKey("searches", "event_id", "events", "event_id"),
    ForeignKey("tweet_data", "author_id", "users", "author_id"),
    ForeignKey("tweet_data", "tweet_id", "tweet_text", "tweet_id"),
    ForeignKey("tweet_data", "search_id", "searches", "search_id"),
    ForeignKey("word_association", "tweet_id", "tweet_data", "tweet_id", unique=False),
    ForeignKey("sentiment_category_assignment", "sent_id", "sentiment_category", "sent_id"),
    ForeignKey("sentiment_category_assignment", "tweet_id", "tweet_data", "tweet_id", unique=False),
    ForeignKey("author_location", "author_id", "tweet_data", "author_id", unique=False),
    ForeignKey("author_location", "state_id", "us_states", "state_id"),
]


def _logged(store: Store, load_type: str, counts: DataFrame, label: str, batch_id: int) -> None:
    """One run_log row per changed table."""
    rows = counts.select(F.current_timestamp().alias("run_date"), F.lit(load_type).alias("load_type"),
                         F.format_string(f"%s: %d {label}", F.upper("table_name"), "n").alias("comment"), F.lit(None).cast("string").alias("filepath"))
    store.write("run_log", rows, batch_id)


def delete_rows(store: Store, doomed: dict[str, Column], load_key: str | None = None) -> DataFrame:
    """Delete the rows that ``doomed`` picks by table, and along the foreign keys all that refers to them; returns the run_log rows.

    A deleted key is free again: a later load of the same files brings its rows back. A deletion that another load overtakes starts
    again on what that one left.
    """
    def run(snapshot: Store, batch_id: int, key: str) -> DataFrame:
        names = {*doomed, *(k.child for k in SCHEMA_KEYS), *(k.parent for k in SCHEMA_KEYS)}
        marked = cascade({n: snapshot.read_placed(n) for n in names}, SCHEMA_KEYS, doomed)
        replaces = []
        for name, rows in marked.items():
            touched = stored(rows.filter(GONE).select("batch_id").distinct(), f"touched-{name}")
            kept = rows.filter(~F.col(GONE)).drop(GONE).join(touched, "batch_id", "left_semi")
            replaces += snapshot.rewrite(name, kept, touched)
        _logged(snapshot, DELETE, deleted_counts(marked).filter("deleted > 0").withColumnRenamed("deleted", "n"), "DELETED", batch_id)
        snapshot.commit(batch_id, key, REWRITE, replaces=replaces)
        return snapshot.read("run_log", batch_id)

    return loaded_once(store, load_key, run)


def correct_rows(store: Store, table: str, key: str, ids: list, column: str, value, load_key: str | None = None) -> DataFrame:
    """Set ``column`` to ``value`` in the stored rows whose ``key`` is listed; returns the run_log rows.

    Only the partitions that hold such a row are written, rows that have the value already change nothing.
    """
    def run(snapshot: Store, batch_id: int, load_key: str) -> DataFrame:
        rows = snapshot.read_placed(table)
        wrong = rows.filter(F.col(key).isin(ids) & ~F.col(column).eqNullSafe(F.lit(value)))
        touched = stored(wrong.groupBy("batch_id").agg(F.count("*").alias("n")), "touched")
        replaces = snapshot.rewrite(table, correct(rows.join(touched, "batch_id", "left_semi"), key, ids, column, value), touched)
        counts = touched.agg(F.sum("n").alias("n")).filter("n > 0").select(F.lit(table).alias("table_name"), "n")
        _logged(snapshot, CORRECT, counts, "CORRECTED", batch_id)
        snapshot.commit(batch_id, load_key, REWRITE, replaces=replaces)
        return snapshot.read("run_log", batch_id)

    return loaded_once(store, load_key, run)
