"""Primary keys, foreign keys, surrogate ids and dimension upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.operators.joins import dealt_anew
from voxstar.session import shared_dir


def _ordered(order: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key.

    ``row_number() = 1`` plans as a window group limit: each map task keeps one
    row per key before the shuffle, so a hot key ships one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_ordered(order)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedupe_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last row per key (the value a later write leaves behind)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_ordered(order, descending=True)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def tag_first(df: DataFrame, keys: list[str], order: list[str], flag: str = "is_first",
              salts: int | None = None) -> DataFrame:
    """Mark the first row of every key and keep all rows.

    Rows are ranked inside (key, salt), the winning salt per key comes from a
    combined aggregate over the local firsts, and the mark is joined back on the
    same (key, salt) partitioning, so no key is ever handled by one task. There
    are as many salts as shuffle partitions unless given. ``order`` should be
    unique within a key; of equal rows any one is marked. Rows with a null key
    get no mark.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salts)).cast("int")
    local = Window.partitionBy(*keys, "_salt").orderBy(*_ordered(order))
    ranked = df.withColumn("_salt", salt).withColumn("_rank", F.row_number().over(local))
    winners = (ranked.filter("_rank = 1").groupBy(*keys)
               .agg(F.min(F.struct(*[F.col(c) for c in order], F.col("_salt"))).alias("_w"))
               .select(*keys, F.col("_w._salt").alias("_salt"), F.lit(True).alias("_won")))
    return (ranked.join(winners, [*keys, "_salt"], "left")
            .withColumn(flag, F.coalesce(F.col("_won"), F.lit(False)) & (F.col("_rank") == 1))
            .drop("_salt", "_rank", "_won"))


def tag_exists(df: DataFrame, parent: DataFrame, column: str, parent_column: str, flag: str,
               unique: bool = False) -> DataFrame:
    """Mark the rows whose ``column`` value is a key of ``parent``.

    ``unique`` tells that the parent holds each key once. Spark broadcasts a small parent; beyond its threshold both sides are dealt
    anew for the join and adaptive execution splits hot keys.
    """
    keys = parent.select(F.col(parent_column).alias("_key")).dropna()
    known = (keys if unique else keys.distinct()).withColumn(flag, F.lit(True))
    joined = df.join(known, dealt_anew([column]) == dealt_anew(["_key"]), "left").drop("_key")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def enforce_fk(df: DataFrame, parent: DataFrame, column: str, parent_column: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected) by a foreign key, straight against the parent: a semi-join and an anti-join,
    each stopping at a row's first match."""
    keys = parent.select(F.col(parent_column).alias(column))
    return df.join(keys, column, "left_semi").select(df.columns), df.join(keys, column, "left_anti").select(df.columns)


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that remain after their parents were deleted."""
    return child.join(deleted.select(key), key, "left_anti").select(child.columns)


def assign_ids(df: DataFrame, id_column: str, start: int, order: list[str] | None = None) -> DataFrame:
    """Dense ids from ``start``, without gathering rows in one task.

    With ``order`` the rows are range partitioned first; without it they are
    numbered where they lie and nothing is shuffled. The checkpoint fixes each
    row's place, so ids do not change when a task is repeated.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return number_fixed(fix_rows(df), id_column, start)


def fix_rows(df: DataFrame) -> DataFrame:
    """The rows checkpointed in the shared folder, with their partitions and order."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def number_fixed(fixed: DataFrame, id_column: str, start: int) -> DataFrame:
    """Dense ids for checkpointed rows or a filter of them.

    The id is the offset of the row's partition (one number per partition) plus
    the row's position in it.
    """
    placed = (fixed.withColumn("_slot", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright("_slot", 33))
              .withColumn("_pos", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_offset"))
    ids = F.lit(start).cast("long") + F.col("_offset") + F.col("_pos")
    return (placed.join(F.broadcast(offsets), "_part")
            .select(ids.alias(id_column), *[F.col(c) for c in fixed.columns]))


def upsert_dim(existing: DataFrame, incoming: DataFrame, natural_key: list[str], id_column: str,
               seed: int) -> tuple[DataFrame, DataFrame]:
    """Get-or-create: returns (all rows, newly created rows) of a dimension.

    New keys are numbered in key order after the highest id. One row per new key of a dimension (search windows, keywords) goes through
    the window that does it, never one per fact; no job starts before the result is used.
    """
    fresh = incoming.select(*natural_key).distinct().join(existing.select(*natural_key), natural_key, "left_anti")
    top = existing.agg(F.max(id_column).alias("top")).scalar()
    start = F.greatest(F.lit(seed), F.coalesce(top + 1, F.lit(seed))).cast("long")
    place = F.row_number().over(Window.orderBy(*natural_key)).cast("long")
    created = fresh.withColumn(id_column, place + start - 1)
    created = created.select(*[F.col(f.name).cast(f.dataType) for f in existing.schema])
    return existing.unionByName(created), created


def resolve_id(df: DataFrame, dim: DataFrame, natural_key: list[str], id_column: str) -> DataFrame:
    """Attach the id of each row's natural key. A key with no id, or more than one, fails the query when it is met."""
    lookup = (dim.groupBy(*[F.col(c).alias(f"_{c}") for c in natural_key])
              .agg(F.count(F.lit(1)).alias("_ids"), F.min(id_column).alias(id_column)))
    found = df.join(lookup, dealt_anew(natural_key) == dealt_anew([f"_{c}" for c in natural_key]), "left")
    said = lambda text: F.raise_error(F.concat(F.lit(f"{text} {id_column} for "), F.to_json(F.struct(*natural_key))))
    checked = (F.when(F.col("_ids") == 1, F.col(id_column)).when(F.col("_ids") > 1, said("more than one")).otherwise(said("no")))
    return found.withColumn(id_column, checked.cast(dim.schema[id_column].dataType)).select(*df.columns, id_column)


def correct(df: DataFrame, key: str, ids: list, column: str, value) -> DataFrame:
    """Targeted correction: set ``column`` to ``value`` where ``key`` is listed."""
    return df.withColumn(column, F.when(F.col(key).isin(ids), F.lit(value)).otherwise(F.col(column)))
