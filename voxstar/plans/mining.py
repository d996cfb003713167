"""Frequent itemsets, indicator matrices and itemset statistics."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.functions.sentiment import itemset_sentiment
from voxstar.operators.joins import dim_join
from voxstar.operators.keys import fix_rows
from voxstar.seeds import MIN_SUPPORT

MASK_ITEMS = 12  # up to this many items, a transaction is one bit mask


def _support_of(by: str, min_support: float | dict) -> Column:
    if not isinstance(min_support, dict):
        return F.lit(float(min_support))
    levels = F.lit(None).cast("double")
    for value, level in min_support.items():
        levels = F.when(F.col(by) == value, F.lit(float(level))).otherwise(levels)
    return levels


def _mask_itemsets(txns: DataFrame, by: str, txn: list[str], item: str, items: list[str],
                   min_support, k: int | None) -> DataFrame:
    """Itemsets over a short item list.

    A transaction folds into one integer (``bit_or`` combines map-side), equal
    transactions are counted, and only the distinct masks - at most 2^items per
    group - are expanded into their subsets.
    """
    bit = F.lit(0)
    for i, value in enumerate(items):
        bit = F.when(F.col(item) == value, F.lit(1 << i)).otherwise(bit)
    masks = (txns.groupBy(by, *txn).agg(F.bit_or(bit).alias("_mask"))
             .groupBy(by, "_mask").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("n_txn", F.sum("_n").over(Window.partitionBy(by))))
    sizes = [k] if k else range(1, len(items) + 1)
    wanted = [sum(1 << i for i in combo) for size in sizes for combo in combinations(range(len(items)), size)]
    if not wanted:
        wanted = [1 << len(items)]  # no itemset of that size exists
    subsets = F.filter(F.array(*[F.lit(w) for w in wanted]),
                       lambda w: w.bitwiseAND(F.col("_mask")) == w)
    counted = (masks.select(by, "n_txn", "_n", F.explode(subsets).alias("_set"))
               .groupBy(by, "n_txn", "_set").agg(F.sum("_n").alias("freq")))
    members = F.filter(
        F.array(*[F.when(F.col("_set").bitwiseAND(F.lit(1 << i)) != 0, F.lit(v)) for i, v in enumerate(items)]),
        lambda v: v.isNotNull())
    out = counted.withColumn("support", F.col("freq") / F.col("n_txn"))
    return (out.filter(F.col("support") >= _support_of(by, min_support))
            .select(by, F.array_sort(members).alias("items"), "freq", "n_txn", "support"))


def _tree_itemsets(txns: DataFrame, txn: list[str], item: str, frequent: DataFrame, n: int,
                   min_support: float, k: int | None) -> DataFrame:
    """Itemsets over a long item list, with FP-growth on the frequent items.

    FP-growth rounds its count threshold up in floating point and would lose an
    itemset exactly at it, so it runs a little lower and the exact test follows.
    """
    kept = dim_join(txns.select(*txn, item).distinct(), frequent.select(item), item)
    baskets = kept.groupBy(*txn).agg(F.collect_set(item).alias("items"))
    held = baskets.count()  # transactions without a frequent item are not baskets
    if held == 0:
        return txns.sparkSession.createDataFrame([], "items array<string>, freq long, n_txn long, support double")
    low = min(1.0, max(1e-12, min_support * n / held * (1 - 1e-9)))
    model = FPGrowth(itemsCol="items", minSupport=low).fit(baskets.select("items"))
    sets = model.freqItemsets
    if k:
        sets = sets.filter(F.size("items") == k)
    out = sets.select(F.array_sort("items").alias("items"), "freq", F.lit(n).cast("long").alias("n_txn"))
    return out.withColumn("support", F.col("freq") / F.col("n_txn")).filter(F.col("support") >= min_support)


def frequent_itemsets(txns: DataFrame, txn: list[str], item: str, min_support: float = MIN_SUPPORT,
                      k: int | None = 1, items: list[str] | None = None,
                      mask_items: int = MASK_ITEMS) -> DataFrame:
    """(items, freq, n_txn, support) of the itemsets of size ``k`` (all sizes when None).

    ``txns`` is long form, one row per (transaction, item); repeats count once and
    a row with a null item makes an empty transaction. Size 1 is plain counting;
    short item lists use masks; others go to FP-growth.
    """
    spark = txns.sparkSession
    if items is None:
        items = [r[0] for r in txns.select(item).dropna().distinct().limit(mask_items + 1).collect()]
    if len(items) <= mask_items:
        grouped = txns.withColumn("_all", F.lit(1))
        return _mask_itemsets(grouped, "_all", txn, item, sorted(items), min_support, k).drop("_all")
    n = txns.select(*txn).distinct().count()
    singles = (txns.select(*txn, item).dropna(subset=[item]).distinct()
               .groupBy(item).agg(F.count(F.lit(1)).alias("freq"))
               .withColumn("n_txn", F.lit(n).cast("long"))
               .withColumn("support", F.col("freq") / F.col("n_txn"))
               .filter(F.col("support") >= min_support))
    if k == 1:
        return singles.select(F.array(item).alias("items"), "freq", "n_txn", "support")
    frequent = [r[0] for r in singles.select(item).limit(mask_items + 1).collect()]
    if len(frequent) <= mask_items:
        grouped = txns.withColumn("_all", F.lit(1))
        return _mask_itemsets(grouped, "_all", txn, item, sorted(frequent), min_support, k).drop("_all")
    return _tree_itemsets(txns, txn, item, singles, n, min_support, k)


def _level_itemsets(txns: DataFrame, by: str, txn: list[str], item: str, min_support, k: int | None) -> DataFrame:
    """Itemsets over item lists of any length, all groups together, level by level.

    Level n holds a row per transaction and frequent itemset of size n in it. Each is extended by the transaction's later
    frequent items; sets below the support go before the next level, since none of their supersets can reach it. Levels end
    at size ``k`` or when no set is left.
    """
    rows = txns.groupBy(by, *txn, item).agg(F.lit(1).alias("_one")).drop("_one")
    sizes = rows.groupBy(by, *txn).agg(F.lit(1).alias("_one")).groupBy(by).agg(F.count(F.lit(1)).alias("n_txn"))
    level = rows.dropna(subset=[item]).withColumn("items", F.array(item))
    single, out, size = None, [], 1
    while True:
        counted = (level.groupBy(by, "items").agg(F.count(F.lit(1)).alias("freq")).join(sizes, by)
                   .withColumn("support", F.col("freq") / F.col("n_txn")).filter(F.col("support") >= _support_of(by, min_support)))
        counted = fix_rows(counted.select(by, "items", "freq", "n_txn", "support"))
        if k in (None, size):
            out.append(counted)
        if size == k or counted.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), out or [counted])
        level = fix_rows(level.join(counted.select(by, "items"), [by, "items"], "left_semi"))
        single = single if single is not None else level.select(by, *txn, F.col(item).alias("_next"))
        level = (level.join(single, [by, *txn]).filter(F.col("_next") > F.col(item))
                 .select(by, *txn, F.col("_next").alias(item), F.concat("items", F.array("_next")).alias("items")))
        size += 1


def frequent_itemsets_by(txns: DataFrame, by: str, txn: list[str], item: str, items: list[str],
                         min_support: float | dict, k: int | None = 3) -> DataFrame:
    """Itemsets of the listed items per group, all groups together.

    ``min_support`` is one level or a level per group; groups without a level drop out. Lists of up to 12 items fold into masks; longer ones are
    counted level by level, with the same result.
    """
    if len(items) <= MASK_ITEMS:
        return _mask_itemsets(txns, by, txn, item, sorted(items), min_support, k)
    wanted = txns.withColumn(item, F.when(F.col(item).isin(list(items)), F.col(item)))
    return _level_itemsets(wanted, by, txn, item, min_support, k)


def label_itemsets(itemsets: DataFrame) -> DataFrame:
    """Add the itemset sentiment and the ', '-joined item list."""
    return (itemsets.withColumn("sentiment", itemset_sentiment(F.col("items")))
            .withColumn("itemsets", F.array_join("items", ", ")))


def support_stats(itemsets: DataFrame, by: list[str]) -> DataFrame:
    """Largest and median support per group."""
    return itemsets.groupBy(*by).agg(F.max("support").alias("max_support"),
                                     F.median("support").alias("median_support"))


def sorted_itemsets(itemsets: DataFrame, ascending: bool = True) -> DataFrame:
    """Itemsets by support, ties by items."""
    support = F.col("support").asc() if ascending else F.col("support").desc()
    return itemsets.orderBy(support, F.col("items"))


def indicator_matrix(df: DataFrame, key: list[str], item: str, values: list[str]) -> DataFrame:
    """One 0/1 column per listed value."""
    return df.groupBy(*key).agg(*[F.max((F.col(item) == v).cast("int")).alias(str(v)) for v in values])


def indicator_long(matrix: DataFrame, key: list[str], values: list[str], item: str = "item",
                   value: str = "present") -> DataFrame:
    """The indicator matrix turned back to rows."""
    return matrix.unpivot(key, values, item, value)
