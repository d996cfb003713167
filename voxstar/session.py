"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Of Parquet in the shared folder and in the store; texts take half the room that Spark's default leaves them.
CODEC = "zstd"


def build_session(master: str, app: str = "voxstar", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and no web page."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` decides. Only a local session that sets none gets
    a folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="voxstar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows written once as Parquet in the shared folder, apart ``by`` a column if given, and read back."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path, partitionBy=by, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
