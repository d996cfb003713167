"""Near duplicates: circulant MinHash, bands, exact Jaccard, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.llm import words as W
from voxstar.llm.graph import components
from voxstar.llm.staging import checkpointed, packed
from voxstar.shipping import ship

#: Signature length; places of the second permutation.
COORDINATES = 256
PLACES = 1 << 20
#: Bands of BAND_ROWS coordinates. A pair at similarity 0.8 shares none of them with probability 3e-6.
BAND_ROWS = 6
BANDS = COORDINATES // BAND_ROWS
#: Two signatures at similarity 0.8 differ in 25.6 of 256 low bits on average, deviation 4.8: six deviations are 54.4.
BITS_APART = 55

_SECOND = np.random.default_rng(7).permutation(PLACES).astype(np.uint32)
_CIRCLE = sliding_window_view(np.concatenate((_SECOND, _SECOND[:COORDINATES - 1])), COORDINATES)
_BAND_SALT = W.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its word windows, A-Z lowered; a shorter text is one window."""
    words = W.find(texts, lower=True)
    hashes = words.hashes()
    grams = W.windows(hashes, width)
    out = []
    for low, high in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        n = high - low
        if n >= width:
            out.append(np.unique(grams[low:high - width + 1]))
        else:
            out.append(W.windows(hashes[low:high], int(n)) if n else hashes[:0])
    return out


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """Coordinate k is the least second[(first(x) + k) mod PLACES] over the set: one permutation scrambles the shingles,
    the other, shifted round by k, orders them."""
    places = W.mix(shingle_set) >> np.uint64(64 - 20)
    low = np.full(COORDINATES, PLACES, np.uint32)
    for at in range(0, len(places), 2048):
        np.minimum(low, _CIRCLE[places[at:at + 2048]].min(axis=0), out=low)
    return low


def _signed(shingle_set: np.ndarray) -> tuple[int, int, list[int], list[int]]:
    """Two order-free hashes of the set, its band keys, the low bits of its signature as four numbers."""
    sig = signature(shingle_set)
    rows = sig[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = _BAND_SALT.copy()
    for j in range(BAND_ROWS):
        key = W.mix(key ^ rows[:, j])
    one, two = W.mix(shingle_set), W.mix(shingle_set ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    bits = np.packbits((sig & 1).astype(np.uint8)).view(np.int64)
    return (one.sum(dtype=np.uint64).view(np.int64).item(), two.sum(dtype=np.uint64).view(np.int64).item(),
            key.view(np.int64), bits)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """``rk`` (hash of doc_id and text), ``doc_id``, ``n_shingles``, ``s1``, ``s2`` (hashes of the set), ``bands``, ``bits``; no shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        for batch in batches:
            rows = []
            for _, part in W.slices(batch.column(2).to_pylist()):
                rows += [(len(s), *(_signed(s) if len(s) else (None, None, None, None))) for s in shingles(part, width)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]],
                    names=["rk", "doc_id", "n_shingles", "s1", "s2", "bands", "bits"])

    return docs.select(F.xxhash64("doc_id", "text").alias("rk"), "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "rk long, doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, bits array<long>")


def _comparable(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The text of each needed ``rk``, once."""
    return checkpointed(docs.select(F.xxhash64("doc_id", "text").alias("rk"), F.col("text").cast("binary").alias("text"))
                        .join(needed, "rk", "left_semi").dropDuplicates(["rk"]))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole shingle sets satisfy 100 * intersection >= percent * union.

    Each pair meets its two texts in two joins, whose hot keys (a hub of thousands of copies) adaptive execution splits.
    """
    left = texts.select(F.col("rk").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("rk").alias("v"), F.col("text").alias("text_v"))
    # the text that many pairs share comes last, so that it is hashed once for a run of pairs
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "text_u", "text_v")

    def run(batches):
        last, held = None, None
        for batch in batches:
            u, v, first, second = (batch.column(i).to_pylist() for i in range(4))
            good = []
            for i in range(len(u)):
                if last is None or u[i] != last:
                    last, held = u[i], shingles([first[i]], width)[0]
                other = shingles([second[i]], width)[0]
                common = len(np.intersect1d(held, other, assume_unique=True))
                good.append(100 * common >= percent * (len(held) + len(other) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _shingle_rows(texts: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, part in W.slices(batch.column(1).to_pylist()):
                sets = shingles(part, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[first:first + len(part)], [len(x) for x in sets])),
                     pa.array(np.concatenate(sets).view(np.int64))], names=["id", "shingle"])

    return texts.select("rk", "text").mapInArrow(run, "id long, shingle long")


def sharing(texts: DataFrame, placed: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v) in different components that can still reach the similarity, by an exact prefix filter.

    Each set is ordered from its rarest shingle among these documents. The first shingle that a similar pair shares
    leaves room for the needed overlap behind it in both; pairs without such a shingle are out. Members of a group that differ
    from it by edits of their own begin with shingles that hardly anyone has, so they do not meet the whole group again.
    """
    rows = _shingle_rows(texts, width)
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select(F.expr("~shingle").alias("other"), "df")
    order = Window.partitionBy("id").orderBy("df", "shingle")
    ranked = (rows.join(often, F.col("shingle") == F.expr("~other"), "left").select("id", "shingle", F.coalesce("df", F.lit(1)).alias("df"))
              .withColumn("pos", F.row_number().over(order) - 1))
    heads = checkpointed(ranked.join(placed, "id").where((F.col("df") > 1) & (100 * (F.col("n") - F.col("pos")) >= percent * F.col("n")))
                         .select("shingle", "pos", "id", "n", "component"))
    other = heads.select(*[F.col(c).alias("o_" + c) for c in heads.columns])
    overlap = F.ceil(percent * (F.col("n") + F.col("o_n")) / F.lit(100.0 + percent))
    return (heads.join(other, (F.col("shingle") == F.col("o_shingle")) & (F.col("id") < F.col("o_id"))
                       & (F.col("component") != F.col("o_component")) & _comparable(F.col("n"), F.col("o_n"), percent)
                       & (F.least(F.col("n") - F.col("pos"), F.col("o_n") - F.col("o_pos")) >= overlap))
            .select(F.col("id").alias("u"), F.col("o_id").alias("v")).distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``rk``, ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` and ``head`` of every row.

    Rows are linked when their whole sets of ``width``-word shingles have a Jaccard similarity of ``percent`` % or
    more. ``rk``, the hash of doc_id and text, names a row, so rows of one doc_id with different texts are linked each by its own, and
    a null doc_id is linked like any other; equal rows share their ``rk``. A component is named by its smallest doc_id, null if no row in it
    has one. Its ``head`` is the rk of the row with the smallest (doc_id, nulls last; rk). ``kept`` is doc_id = component_id, and in a component
    without ids rk = head. A text without words (null, empty) has an empty set and is alone. An empty table gives no rows; other columns are not read.

    1. Rows are signed where they lie. Equal sets collapse into one class, led by its first row, so that exact
       copies cost one row each however many there are.
    2. Each band's bucket links its members to its least member: one candidate per member, never all pairs. Confirmed
       links form components, which swallow a group of near copies whole.
    3. What is left are members of one bucket in different components. A semi-join finds those with a likely partner by the low
       bits of their signatures; the pairs among them come from an exact prefix filter on whole sets and are
       confirmed. Nothing is capped, and a group of near copies is never paired out.
    """
    ship(docs.sparkSession)
    n_docs = docs.count()
    rows = checkpointed(signed(docs, width))
    sets = rows.where("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk")
    classes = packed(sets.groupBy("s1", "s2", "n_shingles").agg(F.min(place).alias("first"))
                     .select("s1", "s2", "n_shingles", "first.no_id", "first.doc_id", F.col("first.rk").alias("lead")), n_docs)
    leads = checkpointed(sets.join(classes.select("lead"), F.col("rk") == F.col("lead")).dropDuplicates(["lead"])
                         .select("lead", "doc_id", "n_shingles", "bands", "bits"))

    member = leads.select(F.explode("bands").alias("key"), F.col("lead").alias("id"), F.col("n_shingles").alias("n"),
                          F.col("doc_id").isNull().alias("no_id"), "doc_id")
    hubs = packed(member.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("no_id", "doc_id", "id", "n")).alias("hub"))
                  .where("members > 1").select("key", F.struct("hub.id", "hub.n").alias("hub")), n_docs)
    buckets = checkpointed(member.join(hubs, "key").select("key", "id", "n", "hub"))
    pairs = (buckets.where((F.col("id") != F.col("hub.id")) & _comparable(F.col("n"), F.col("hub.n"), percent))
             .select(F.col("hub.id").alias("u"), F.col("id").alias("v")).distinct())
    pairs = packed(pairs, n_docs)
    needed = pairs.select(F.col("u").alias("rk")).union(pairs.select("v")).distinct()
    links = packed(confirmed(pairs, texts_of(docs, needed), width, percent), n_docs)
    known = components(links)

    placed = checkpointed(buckets.select("key", "id", "n").join(known, F.col("id") == F.col("node"), "left")
                          .select("key", "id", "n", F.coalesce("component", "id").alias("component")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("key"))
    bits = leads.select(F.col("lead").alias("id"), *[F.col("bits")[i].alias(f"b{i}") for i in range(4)])
    open_rows = packed(placed.join(packed(mixed, n_docs), "key", "left_semi"), n_docs)
    open_rows = packed(open_rows.join(bits, "id"), n_docs)
    other = open_rows.select("key", *[F.col(c).alias(f"o_{c}") for c in open_rows.columns if c != "key"])
    apart = sum((F.bit_count(F.col(f"b{i}").bitwiseXOR(F.col(f"o_b{i}"))) for i in range(4)), F.lit(0))
    doubtful = packed(open_rows.join(other, (open_rows["key"] == other["key"]) & (F.col("id") != F.col("o_id"))
                                     & (F.col("component") != F.col("o_component"))
                                     & _comparable(F.col("n"), F.col("o_n"), percent) & (apart <= BITS_APART), "left_semi")
                      .select("id", "n", "component").distinct(), n_docs)
    texts = texts_of(docs, doubtful.select(F.col("id").alias("rk")))
    more = packed(confirmed(packed(sharing(texts, doubtful, width, percent), n_docs), texts, width, percent), n_docs)
    final = known if more.isEmpty() else components(links.union(more))

    first = F.min(F.struct("no_id", "doc_id", "lead")).alias("first")
    named = packed(final.join(classes, F.col("node") == F.col("lead")).groupBy("component").agg(first), n_docs)
    linked = final.join(named, "component").select("node", "first")
    led = packed(classes.join(linked, F.col("lead") == F.col("node"), "left")
                 .withColumn("first", F.coalesce("first", F.struct("no_id", "doc_id", "lead")))
                 .select("s1", "s2", "n_shingles", F.col("first.doc_id").alias("component"), F.col("first.lead").alias("head")), n_docs)
    alone = F.col("n_shingles") == 0
    return (rows.drop("bands", "bits").join(led, ["s1", "s2", "n_shingles"], "left")
            .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component")))
            .withColumn("head", F.when(alone, F.col("rk")).otherwise(F.col("head")))
            .withColumn("kept", F.coalesce(F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("doc_id").isNotNull() | (F.col("rk") == F.col("head"))),
                                           F.lit(False)))
            .select("rk", "doc_id", "n_shingles", "component_id", "kept", "head"))
