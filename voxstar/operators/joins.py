"""Joins that stay balanced whatever the key distribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000


def dealt_anew(columns: list[str]) -> Column:
    """Key columns as one join key that no earlier partitioning satisfies.

    A join on it shuffles both sides for itself, so adaptive execution may split a hot key even where one side was just
    aggregated by these columns. Nulls in the key are equal to each other.
    """
    return F.struct(*[F.col(c) for c in columns])


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str, salt_by: list[str],
              hot_rows: int = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Join on equal keys, splitting every key with more than ``hot_rows`` left rows.

    The hot keys come from a map-side combined count; there are at most
    rows / ``hot_rows`` of them, which bounds their broadcast. A key with n rows
    is split into n / ``hot_rows`` salts, chosen by a hash of ``salt_by``, and only
    the right rows of hot keys are copied, once per salt: at most
    2 * rows / ``hot_rows`` copies in all. ``how`` may be inner, left, left_semi or
    left_anti: each left row meets exactly one salt, so results are unchanged. Left rows with a null in the key match
    nothing and go round the join.
    ``counted`` may name a cheaper frame to count the keys in, such as the fact
    table ``left`` was built from; it only steers the split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    hot = ((left if counted is None else counted).dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
           .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts")))
    hot = F.broadcast(hot)
    lost = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    everything, left = left, left.filter(~lost)
    digest = F.xxhash64(*[F.col(c) for c in salt_by])
    salted_left = (left.join(hot, on, "left")
                   .withColumn("_salt", F.coalesce(F.pmod(digest, F.col("_salts")).cast("int"), F.lit(0)))
                   .drop("_salts"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_right = right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    joined = salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(everything.filter(lost), allowMissingColumns=True)


def dim_join(fact: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Join a fact to a lookup table.

    Spark broadcasts the lookup side when its estimated or, at run time, its actual size is below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond it adaptive execution splits hot keys of the fact side. Planning starts no job.
    """
    return fact.join(dim, on, how)


def full_outer_keyed(left: DataFrame, right: DataFrame, on: list[str], salt_by: list[str],
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer join as a salted left join plus the right rows nothing refers to."""
    matched = skew_join(left, right, on, "left", salt_by, hot_rows)
    orphans = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(orphans, allowMissingColumns=True)
