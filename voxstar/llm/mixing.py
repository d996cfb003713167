"""Mix sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.llm.staging import checkpointed, stored

#: 52 bits of a document's hash give its uniform number.
_DIGITS = 13


def words_in(text: str) -> Column:
    """The number of words of a text column, 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)) \
        .cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Per source (``source``, ``source_size``) its ``target``.

    Sources in code-point order, null last, take the weights in turn. A target is the smaller of weight times level
    and ``most`` times the size, with one level for all, such that the targets add up to ``share`` times the whole size:
    what is cut from one source is shared out again by weight until nothing is above its bound. If all sources up to some point of the
    order (bound / weight) are cut, the level follows from the rest; the right level is the largest of these.
    One row per source goes through the two windows, never one per document.
    """
    order = Window.partitionBy().orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight)
    first = Window.partitionBy().orderBy(most * F.col("source_size") / F.col("weight"),
                                         F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least(most * F.col("source_size"), F.col("level") * F.col("weight")))
            .select("source", "source_size", "target"))


def uniform(key: str, text: str, seed: str) -> Column:
    """A number in [0, 1) that only depends on the row's key, its text and the seed."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"),
                            F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") / F.lit(float(16 ** _DIGITS))


def mix(docs: DataFrame, size: Column, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and the columns of ``keep``.

    A source's rate is its target over its size. Each document is taken floor(rate) times, and once more when its uniform number,
    a hash of seed, doc_id and whole text, is below the fraction: independent draws with that probability, the same on every run.
    Rows without a doc_id, or with one that repeats, draw by their own texts; rows equal in both draw alike. Null is a source of its own,
    the last; a source without words has target 0. An empty table gives no rows; other columns are not read.

    Sizes are summed per source before the shuffle; the rows of one hot source are then spread over all partitions, since the source table
    returns by a join that adaptive execution broadcasts or splits.
    """
    sized = docs.select("doc_id", "source", size.alias("size"), uniform("doc_id", "text", seed).alias("_draw"), *keep)
    if not keep:  # counts only: cheaper to keep than to take twice from the texts
        sized = checkpointed(sized)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stored(targets(sources, weights, share, most).withColumnRenamed("source", "_source"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (F.col("_draw") < rate - whole).cast("long")
    return (sized.join(goal, F.col("source").eqNullSafe(F.col("_source"))).withColumn("copies", whole + extra).drop("_source", "_draw"))
