"""Captured search payloads: scan, file-name metadata, flattening, quarantine."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxstar.functions.text import first_reference
from voxstar.schemas import payload_schema
from voxstar.seeds import event_dim
from voxstar.session import stored

# fixed value: <event>/<keyword>_<start>_<end>.json
FILE_NAME = r"([^/]+)/([A-Za-z_]+)_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]{4}-[0-9]{2}-[0-9]{2})\.json$"


def scan_payloads(spark: SparkSession, root: str) -> DataFrame:
    """(filepath, value): one row per payload file below ``root``/<event>/."""
    files = spark.read.option("pathGlobFilter", "*.json").text(os.path.join(root, "*"), wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("filepath"), "value")


def stream_payloads(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """The streaming form of ``scan_payloads``."""
    reader = spark.readStream.option("pathGlobFilter", "*.json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.text(os.path.join(root, "*"), wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("filepath"), "value")


def parse_payloads(raw: DataFrame) -> DataFrame:
    """Parse (filepath, value) with the declared schema; bad files keep only ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return (raw.withColumn("_p", F.from_json("value", payload_schema(), options))
            .select("filepath", "_p.*"))


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    return parse_payloads(scan_payloads(spark, root))


def quarantine(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable payloads, files that do not parse), from one parse kept in the shared folder, readable and broken ones apart."""
    kept = stored(payloads.withColumn("_broken", F.col("_corrupt_record").isNotNull()), "quarantine", by="_broken")
    good = kept.filter("NOT _broken").select(*[c for c in payloads.columns if c != "_corrupt_record"])
    return good, kept.filter("_broken").select("filepath", "_corrupt_record")


NOT_JSON, OTHER_SHAPE, PAYLOAD = "not json", "other shape", "payload"


def variant_payloads(raw: DataFrame) -> DataFrame:
    """(filepath, status, payload): files parsed to VARIANT, so fields that no schema declares survive.

    ``status`` tells a file that is no JSON (null payload) from JSON of another shape: a search answer is an object whose ``data`` is an
    array of objects with an id, or absent next to ``meta`` when nothing was found.
    """
    parsed = raw.select("filepath", F.try_parse_json("value").alias("payload"))
    posts = F.try_variant_get("payload", "$.data", "array<variant>")
    # a cast of what is no such array gives null
    shaped = F.forall(posts, lambda p: F.try_variant_get(p, "$.id", "string").isNotNull())
    empty = F.try_variant_get("payload", "$.data", "variant").isNull() & F.try_variant_get("payload", "$.meta", "map<string,variant>").isNotNull()
    status = (F.when(F.col("payload").isNull(), NOT_JSON)
              .when(F.coalesce(shaped, F.lit(False)) | F.coalesce(empty, F.lit(False)), PAYLOAD).otherwise(OTHER_SHAPE))
    return parsed.select("filepath", status.alias("status"), "payload")


def undeclared_fields(payloads: DataFrame) -> DataFrame:
    """(filepath, pos, tweet_id, field, value): fields of captured posts that the declared schema has no place for, values as JSON.

    ``payloads`` are rows of ``variant_payloads``; files that are no payload give nothing.
    """
    declared = payload_schema()["data"].dataType.elementType.names
    posts = payloads.filter(F.col("status") == PAYLOAD).select(
        "filepath", F.posexplode(F.variant_get("payload", "$.data", "array<variant>")).alias("pos", "post"))
    fields = F.map_filter(F.variant_get("post", "$", "map<string,variant>"), lambda k, v: ~k.isin(declared))
    found = posts.select("filepath", "pos", F.variant_get("post", "$.id", "string").alias("tweet_id"), F.explode(fields).alias("field", "_value"))
    return found.select("filepath", "pos", "tweet_id", "field", F.to_json("_value").alias("value"))


def file_meta(path: Column) -> dict[str, Column]:
    """Event tag, keyword and search window held in a file path; null when it has another form."""
    part = lambda i: F.nullif(F.regexp_extract(path, FILE_NAME, i), F.lit(""))
    return {"event_tag": part(1), "keyword": part(2),
            "search_start": F.to_date(part(3)), "search_end": F.to_date(part(4))}


def with_search_meta(payloads: DataFrame) -> DataFrame:
    """Add the file-name metadata and the event id of its tag."""
    named = payloads.withColumns(file_meta(F.col("filepath")))
    events = event_dim(payloads.sparkSession).select("event_tag", "event_id")
    return named.join(F.broadcast(events), "event_tag", "left")


def _day(stamp: Column) -> Column:
    """UTC day of an ISO stamp ending in Z, whatever the session time zone."""
    return F.substring(stamp, 1, 10).try_cast("date")


def _users() -> Column:
    """Array of the included users, in payload order."""
    def one(u, i):
        counts = u["public_metrics"]
        return F.struct(
            i.alias("pos"), u["id"].alias("author_id"), _day(u["created_at"]).alias("created_at"),
            u["location"].alias("location"), u["description"].alias("description"),
            *[counts[c].alias(c) for c in ("followers_count", "following_count", "listed_count", "tweet_count")],
            u["verified"].alias("verified"))
    return F.transform("includes.users", one)


def _texts() -> Column:
    """Array of the tweets with the text of the post they refer to, then the originals nothing refers to.

    A payload carries its own originals, so this full outer match runs inside the
    payload row and moves no data. Unreferenced originals have no tweet id.
    """
    null = F.lit(None).cast("string")
    originals = F.coalesce(F.col("includes.tweets"), F.array())
    tweets = F.coalesce(F.col("data"), F.array())
    refs = F.transform(tweets, lambda t: first_reference(t["referenced_tweets"]))

    def matched(t):
        ref = first_reference(t["referenced_tweets"])
        hit = F.filter(originals, lambda o: o["id"] == ref)
        return F.struct(t["id"].alias("tweet_id"), t["text"].alias("tweet"), ref.alias("retweet_id"),
                        F.try_element_at(hit, F.lit(1))["text"].alias("retweet_text"))

    def orphan(o):
        return F.struct(null.alias("tweet_id"), null.alias("tweet"), null.alias("retweet_id"), o["text"].alias("retweet_text"))

    alone = F.filter(originals, lambda o: ~F.coalesce(F.array_contains(refs, o["id"]), F.lit(False)))
    rows = F.concat(F.transform(tweets, matched), F.transform(alone, orphan))
    return F.transform(rows, lambda t, i: F.struct(i.alias("pos"), *[t[c].alias(c) for c in (
        "tweet_id", "tweet", "retweet_id", "retweet_text")]))


def _facts() -> Column:
    """Array of author, day and id of the captured tweets."""
    return F.transform("data", lambda d, i: F.struct(
        i.alias("pos"), d["author_id"].alias("author_id"), _day(d["created_at"]).alias("created_at"), d["id"].alias("tweet_id")))


def payload_users(payloads: DataFrame) -> DataFrame:
    """One row per included user."""
    return payloads.select("filepath", F.inline(_users()))


def payload_texts(payloads: DataFrame) -> DataFrame:
    """One row per tweet with its original's text, and per original nothing refers to."""
    return payloads.select("filepath", F.inline(_texts()))


def payload_facts(payloads: DataFrame) -> DataFrame:
    """One row per captured tweet: author, day, tweet id."""
    return payloads.select("filepath", F.inline(_facts()))


def payload_items(payloads: DataFrame) -> DataFrame:
    """(filepath, kind, user, text, fact, file): every row a load needs, from one parse.

    A payload with its metadata becomes one row per user, text and fact, and one
    row for the file itself. Unreadable or misnamed files give the file row only.
    Rows stay post-sized, where nested payload rows would make readers hold
    thousands of whole payloads at a time.
    """
    usable = (F.col("_corrupt_record").isNull() & F.col("event_id").isNotNull()
              & F.col("search_start").isNotNull() & F.col("search_end").isNotNull())
    file = F.struct(*[F.col(c) for c in ("event_id", "keyword", "search_start", "search_end")],
                    F.col("_corrupt_record").alias("corrupt"))
    fields = {"user": _users(), "text": _texts(), "fact": _facts(), "file": F.array(file)}
    columns = [F.when(usable, F.coalesce(v, F.array())) if k != "file" else v for k, v in fields.items()]
    held = payloads.select("filepath", *[c.alias(k) for k, c in zip(fields, columns)])
    types = {k: held.schema[k].dataType.elementType for k in fields}

    def wrapped(kind):
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("kind"), *[
            (x if k == kind else F.lit(None)).cast(types[k]).alias(k) for k in fields]))

    every = F.concat(*[F.coalesce(wrapped(k), F.array()) for k in fields])
    return held.select("filepath", F.inline(every))


def payload_errors(payloads: DataFrame) -> DataFrame:
    """References the service could not return (deleted or hidden)."""
    e = payloads.select("filepath", F.posexplode("errors").alias("pos", "e"))
    return e.select("filepath", "pos", "e.*")


def payload_pages(payloads: DataFrame) -> DataFrame:
    """Result counts announced by each payload."""
    return payloads.select("filepath", "meta.result_count", "meta.next_token")
