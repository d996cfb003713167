"""Streams with bounded state: repeats within a time span, page caps that go on from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from voxstar.shipping import ship

#: transformWithState needs a store that holds more than one kind of state per key.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def drain(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to Parquet below ``target``, wait and stop. State and progress live in ``checkpoint``, so the next run goes on."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dedupe_within(stream: DataFrame, keys: list[str], event_time: str, span: str) -> DataFrame:
    """Drop a row whose key was seen within ``span`` before; state holds the keys of about that span only, however long the stream runs.

    A key that comes again after its span is a new one. Rows that are older than the greatest event time of earlier batches by more than
    ``span`` are late and dropped, known key or not. Rows without an event time or with a null key are dropped: nothing could ever
    forget the first, and null keys are no repeats of each other.
    """
    given = stream.dropna(subset=[event_time, *keys])
    return given.withWatermark(event_time, span).dropDuplicatesWithinWatermark(keys)


class _PageCap(StatefulProcessor):
    """Per window, how many results have been fetched; pages beyond the cap are left."""

    def __init__(self, page: str, count: str, max_count: int, ttl_ms: int | None):
        self.page, self.count, self.max_count, self.ttl_ms = page, count, max_count, ttl_ms

    def init(self, handle) -> None:
        self.fetched = handle.getValueState("fetched", "total long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total = self.fetched.get()[0] if self.fetched.exists() else 0
        room = self.max_count - total
        if room > 0:
            first = self._first_pages(rows, room)
            before = total + first[self.count].cumsum().shift(fill_value=0)
            kept = first[before < self.max_count].assign(fetched_before=before[before < self.max_count].astype("int64"))
            self.fetched.update((int(total + kept[self.count].sum()),))
            yield kept
        else:
            for _ in rows:  # a full window's further pages are read and left
                pass

    def _first_pages(self, rows: Iterator[pd.DataFrame], room: int) -> pd.DataFrame:
        """The pages that could still be fetched, by number: each brings a result at least, so no more than ``room``."""
        held: pd.DataFrame | None = None
        for part in rows:
            part = part[part[self.count].fillna(0) > 0]
            held = part if held is None else pd.concat([held, part])
            held = held.nsmallest(room, self.page, keep="first")
        return held.sort_values(self.page, kind="stable")

    def close(self) -> None:
        pass


def cap_pages_stream(pages: DataFrame, window: list[str], page: str, max_count: int, count: str = "result_count",
                     ttl_ms: int | None = None) -> DataFrame:
    """``operators.paging.cap_pages`` over a stream: the running total of each window is kept from batch to batch.

    A window's pages must arrive in order of their numbers, as a capture fetches them; inside a batch they may lie anyhow. The total
    includes what the last page brought beyond the cap. A task holds at most ``max_count`` pages of a window, whatever the batch brings. ``ttl_ms``
    forgets a window so long after its last page. Pages without results fetch nothing and are not returned. Needs STATE_STORE.
    """
    ship(pages.sparkSession)
    schema = StructType([*pages.schema, StructField("fetched_before", LongType())])
    return pages.groupBy(*window).transformWithStateInPandas(
        _PageCap(page, count, max_count, ttl_ms), schema, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
