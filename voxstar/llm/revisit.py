"""Resolve not-modified revisits of web captures to the full responses they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.llm.staging import checkpointed, stored

#: Fixed values. Fields of a not-modified answer that never replace a stored response's: they describe the body or the connection.
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that do not name another page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without a closing slash, sorted query without tracking, no scheme or fragment."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, "^([^/?]*)", 1)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, "^[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.split(F.regexp_extract(plain, "^[^?]*\\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(tag: Column) -> Column:
    """Entity tags compare weakly."""
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id``, ``url_key``, ``captured``, ``status``, ``response_id``, ``headers``.

    ``records`` has record_id, url, captured (timestamp), kind (``response`` or ``revisit``), digest and headers
    (map of lower-case names). A revisit belongs to the latest response of its canonical URL captured strictly earlier; of
    several at one time, the one with the greatest record_id. Status:

    * ``resolved``: the validators agree. Entity tags decide if both have one, else last-modified if both have one, else the
      payload digest. Headers are the response's, with every field of the revisit put over it except NOT_MERGED.
    * ``mismatch``: an earlier response exists and its validators differ, or nothing can be compared; no headers.
    * ``unresolved``: no earlier response, or the url or time is null.

    Null headers count as none. Rows that repeat are resolved alike, an empty table gives no rows, other columns are not
    read, other kinds are ignored.

    Records are range-partitioned by (key, time), so a URL with a third of all captures spreads over many tasks. Each task carries the
    last response along; the few keys that run on from one partition to the next get theirs from a table with one row per key
    and partition.
    """
    none = F.create_map().cast("map<string,string>")
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "captured", (F.col("kind") == "response").alias("full"), "digest",
        F.coalesce("headers", none).alias("headers"))
    placed = F.col("url_key").isNotNull() & F.col("captured").isNotNull()
    # at one time revisits come first: a response of that time is not earlier
    ranged = checkpointed(rows.where(placed).repartitionByRange("url_key", "captured", "full", "record_id")
                          .withColumn("pid", F.spark_partition_id()))
    body = F.when(F.col("full"), F.struct("record_id", "digest", "headers"))
    inside = (Window.partitionBy("pid", "url_key").orderBy("captured", "full", "record_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("found", F.last(body, ignorenulls=True).over(inside)).where(~F.col("full"))

    place = F.struct("captured", "record_id")
    ends = (ranged.groupBy("url_key", "pid")
            .agg(F.max_by(body, F.when(F.col("full"), place)).alias("last")))
    spans = ranged.groupBy("url_key").agg(F.min("pid").alias("low"), F.max("pid").alias("high")).where("low < high")
    earlier = Window.partitionBy("url_key").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(ends.join(spans.select("url_key"), "url_key").withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
                     .where("carried is not null").select("pid", "url_key", "carried"), "carried")
    joined = local.join(carried, ["pid", "url_key"], "left").withColumn("found", F.coalesce("found", "carried"))
    lost = rows.where(~placed & ~F.col("full")).withColumn("found", F.lit(None).cast(joined.schema["found"].dataType))

    columns = ("record_id", "url_key", "captured", "digest", "headers", "found")
    every = joined.select(*columns).unionByName(lost.select(*columns))
    old = F.col("found.headers")
    same_tag = _tag(F.col("headers")["etag"]) == _tag(old["etag"])
    same_date = F.col("headers")["last-modified"] == old["last-modified"]
    agree = F.coalesce(same_tag, same_date, F.col("digest") == F.col("found.digest"), F.lit(False))
    update = F.map_filter("headers", lambda name, _: ~name.isin(*NOT_MERGED))
    merged = F.map_concat(F.map_filter(old, lambda name, _: ~F.map_contains_key(update, name)), update)
    has = F.col("found").isNotNull()
    return every.select(
        "record_id", "url_key", "captured",
        F.when(~has, "unresolved").when(agree, "resolved").otherwise("mismatch").alias("status"),
        F.when(has & agree, F.col("found.record_id")).alias("response_id"),
        F.when(has & agree, merged).alias("headers"))
