"""Incremental ingest: new payload files into the star-schema store."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from voxstar.operators.keys import assign_ids
from voxstar.plans.loads import initial_load
from voxstar.session import CODEC
from voxstar.sources.files import LISTING_DDL, list_files, listed, publish, read_files, tasks_reach
from voxstar.sources.payloads import stream_payloads
from voxstar.sources.tables import Store

_BROADCAST, _BROADCAST_SEEN = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


#: More than the times by which a stored table grows as a broadcast: keys of texts 22 times their Parquet, searches 38 times.
_HELD = 64


def _broadcasts_seen(own: SparkSession) -> None:
    """Let sizes met at run time decide on broadcasts in a stream's own session.

    Plans know stored tables by their compressed size alone, a small part of what their rows take in the driver's memory, so a plan
    broadcasts only what stays below the limit uncompressed, too.
    """
    limit = own._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if own.conf.get(_BROADCAST_SEEN, None) is None:
        own.conf.set(_BROADCAST_SEEN, str(limit))
    own.conf.set(_BROADCAST, str(limit // _HELD if limit > 0 else limit))


def load_batch(store: Store, quoting: bool = False, name: str | None = None,
               prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body: one load per micro-batch, skipped when already committed.

    A load is keyed by the stream's id, which its checkpoint keeps, and the epoch: another source or a new checkpoint starts
    keys of its own, so its batches are never taken for loaded ones. ``name`` stands in outside a stream. ``prepare``
    turns a batch into (filepath, value) rows.
    """
    narrowed = []

    def run(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        stream = query or name
        if not stream:
            raise ValueError("no stream id to key the load by")
        if query and not narrowed:  # a stream works in a session of its own
            narrowed.append(query)
            _broadcasts_seen(batch.sparkSession)
        initial_load(Store(batch.sparkSession, store.root), prepare(batch) if prepare else batch, f"{stream}/{epoch}", quoting)
    return run


def ingest_stream(raw: DataFrame, store: Store, checkpoint: str, quoting: bool = False,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Drain all new (filepath, value) rows and stop.

    The stream keeps no keys in its state: repeats of earlier loads are found by
    joining the stored tables, so history is unlimited.
    """
    return (raw.writeStream.foreachBatch(load_batch(store, quoting, prepare=prepare))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _note_arrivals(spark: SparkSession, root: str, noted: str, marks: str, max_files: int | None) -> list[str]:
    """Write the payload files not noted by a marked chunk yet to ``noted``, a chunk for each micro-batch, oldest first; returns the
    chunks' names in order."""
    found = list_files(spark, root, ".json")
    if listed(spark, f"{marks}/*"):
        earlier = spark.read.schema(f"{LISTING_DDL}, chunk string").parquet(noted)
        marked = spark.read.text(marks).select(F.col("value").alias("chunk"))
        found = found.join(earlier.join(marked, "chunk", "left_semi").select("path"), "path", "left_anti")
    place = F.lit(0)
    if max_files:
        found, place = assign_ids(found, "_place", 0, ["modified", "path"]), F.floor(F.col("_place") / F.lit(max_files))
    columns = [f.split()[0] for f in LISTING_DDL.split(", ")]
    chunk = f"r{uuid.uuid4().hex}"
    (found.select(*columns, F.format_string(f"{chunk}-%020d", place.cast("long")).alias("chunk"))
     .write.mode("append").parquet(noted, partitionBy="chunk", compression=CODEC))
    return [path.rsplit("=", 1)[1] for path in listed(spark, f"{noted}/chunk={chunk}-*")]


def ingest_files(spark: SparkSession, root: str, store: Store, checkpoint: str,
                 max_files: int | None = None) -> None:
    """Load the payload files below ``root`` not loaded before, and wait until done.

    On local and network disks tasks list the folders, and the names go to the checkpoint folder in chunks, one for each micro-batch.
    The stream is of marks, a file for each chunk, published one after the other; a batch's tasks open the files of its chunk. The
    driver holds no payload file's name, where Spark's file source keeps and plans them all there. That source still serves other
    file systems, glob patterns and checkpoints it began.
    """
    noted, marks = f"{checkpoint}/noted", f"{checkpoint}/marks"
    marked = bool(listed(spark, f"{marks}/*"))
    if not tasks_reach(spark, root) or (not marked and listed(spark, f"{checkpoint}/metadata")):
        ingest_stream(stream_payloads(spark, root, max_files), store, checkpoint).awaitTermination()
        return

    def payloads(batch: DataFrame) -> DataFrame:
        own = batch.sparkSession
        return read_files(own.read.schema(LISTING_DDL).parquet(*[f"{noted}/chunk={r['value']}" for r in batch.collect()]))

    def drain() -> None:
        arrived = spark.readStream.option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d").text(marks)
        ingest_stream(arrived, store, checkpoint, prepare=payloads).awaitTermination()

    if marked:  # what an earlier run left unfinished
        drain()
    for chunk in _note_arrivals(spark, root, noted, marks, max_files):
        publish(spark, f"{marks}/{chunk}", chunk)
        drain()
