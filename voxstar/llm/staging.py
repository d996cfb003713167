"""Cut lineage through the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from voxstar.session import fresh_dir, shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a file of a packed checkpoint, about.
_ROWS = 1 << 16


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of frames made and run in here when they have run, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the session's shared folder; Spark removes it with the frame."""
    shared_dir(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()  # a frame of its own: the setting holds from when one is made


def packed(df: DataFrame, rows: int = 0) -> DataFrame:
    """Like ``checkpointed``, in as many files as about ``rows`` rows need and one for each core at least, not one for each partition.

    For narrow rows: a shuffle may deal a few of them to hundreds of partitions, and on a local disk Hadoop starts two programs for each
    file, each of them for a moment a second copy of the executor.
    """
    return checkpointed(df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // _ROWS))))


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """A table written as Parquet in the shared folder and read again, so that Spark knows its size when it plans a join."""
    path = fresh_dir(df.sparkSession, label)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
