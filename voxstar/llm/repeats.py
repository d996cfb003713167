"""Remove passages that occur elsewhere, by suffix trees over prefix-partitioned groups of suffixes."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from voxstar.llm import words as W
from voxstar.llm.staging import checkpointed
from voxstar.shipping import ship

#: Words of the prefix that first groups suffixes.
PREFIX = 12
#: Larger groups are split by the longest prefix, the whole window.
GROUP = 128


def _anchors(words: W.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, prefix hash at each word, and for each window of ``width`` words (its first word, its anchor).

    A window's anchor is the place of the least prefix hash inside it, so equal windows have their anchors at one offset.
    """
    hashes = words.hashes()
    grams = W.windows(hashes, PREFIX)
    first = W.inside(words, width)
    room = width - PREFIX + 1
    if not len(first):
        return hashes, grams, first, first
    least = sliding_window_view(grams, room).argmin(axis=1)
    return hashes, grams, first, first + least[first]


def anchors(docs: DataFrame, width: int) -> DataFrame:
    """``gram``, ``rk``, ``pos``: each anchor of each row's text, about 2 in ``width - PREFIX + 2`` words."""

    def run(batches):
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for first, part in W.slices(batch.column(1).to_pylist()):
                words = W.find(part)
                _, grams, _, at = _anchors(words, width)
                at = np.unique(at)
                text = np.searchsorted(words.offsets, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(keys[first + text]),
                     pa.array((at - words.offsets[text]).astype(np.int32))], names=["gram", "rk", "pos"])

    return docs.select("rk", "text").mapInArrow(run, "gram long, rk long, pos int")


def _suffixes(joined: DataFrame, width: int) -> DataFrame:
    """Per listed anchor its prefix, place and surrounding words (32 bits each; 0 outside the text).

    ``low`` and ``high`` say which windows around the anchor lie inside the text.
    """
    before, after = width - PREFIX, width

    def run(batches):
        for batch in batches:
            keys, lists = np.asarray(batch.column(0)), batch.column(3).to_pylist()
            for first, part in W.slices(batch.column(2).to_pylist()):
                words = W.find(part)
                hashes = words.hashes()
                grams = W.windows(hashes, PREFIX)
                text = np.repeat(np.arange(len(part)), [len(lists[first + i]) for i in range(len(part))])
                pos = np.array([p for i in range(len(part)) for p in lists[first + i]], np.int64)
                if not len(pos):
                    continue
                at, n = words.offsets[text] + pos, words.counts[text]
                place = pos[:, None] + np.arange(-before, after)
                inside = (place >= 0) & (place < n[:, None])
                short = np.maximum((hashes >> np.uint64(32)).astype(np.uint32), 1)
                around = np.where(inside, short[np.where(inside, place + words.offsets[text][:, None], 0)], 0).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(keys[first + text]), pa.array(pos.astype(np.int32)),
                     pa.array(np.maximum(before - pos, 0).astype(np.int32)),
                     pa.array(np.minimum(before, n - width - pos + before).astype(np.int32)),
                     pa.array([row.tobytes() for row in around], pa.binary())],
                    names=["gram", "rk", "pos", "low", "high", "around"])

    return joined.select("rk", "doc_id", "text", "cold").where("size(cold) > 0").mapInArrow(
        run, "gram long, rk long, pos int, low int, high int, around binary")


def _grow(gram: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes sorted into prefix groups: the first and last repeated window of each (first > last: none).

    Sorting a group's suffixes puts its tree's leaves in order; where neighbours have fewer than d words in common, one node of depth d ends and
    the next begins. A window that starts o words into the surroundings is repeated when two leaves below one
    node of depth PREFIX + o also agree on the words to the left of the anchor that the window takes in.
    """
    before = width - PREFIX
    order = np.argsort(np.concatenate([gram[:, None].view(np.uint32).reshape(len(gram), -1), around[:, before:]], axis=1)
                       .view(f"V{4 * (2 + width)}").ravel(), kind="stable")
    g, right, left = gram[order], around[order, before:], around[order, :before]
    same = (right[1:] == right[:-1]) & (g[1:] == g[:-1])[:, None]
    common = np.concatenate(([0], np.cumprod(same, axis=1, dtype=np.uint8).sum(axis=1)))
    from_left = np.zeros((len(g), before + 1), np.uint64)  # hash of the last j words before the anchor
    for j in range(before):
        from_left[:, j + 1] = W.mix(from_left[:, j] + left[:, before - 1 - j])
    first, last = np.full(len(g), width), np.full(len(g), -1)
    for o in range(before + 1):
        node = np.cumsum(common < PREFIX + o).astype(np.uint64)
        key = W.mix(node) + from_left[:, before - o]
        able = np.flatnonzero((low[order] <= o) & (high[order] >= o))
        by_key = able[np.argsort(key[able], kind="stable")]
        twin = key[by_key][1:] == key[by_key][:-1]
        hit = np.unique(np.concatenate((by_key[1:][twin], by_key[:-1][twin])))
        first[order[hit]] = np.minimum(first[order[hit]], o)
        last[order[hit]] = o
    return first, last


def _trees(suffixes: DataFrame, width: int) -> DataFrame:
    """``rk``, ``low``, ``high``: the stretch of repeated windows round each suffix's anchor."""
    before = width - PREFIX
    names = ["gram", "rk", "pos", "low", "high", "around"]

    def ranges(part: pa.Table) -> pa.RecordBatch:
        gram, rk, pos, low, high = (part.column(n).to_numpy() for n in names[:5])
        around = np.frombuffer(b"".join(part.column("around").to_pylist()), np.uint32).reshape(len(gram), -1)
        first, last = _grow(gram, low, high, around, width)
        some = last >= first
        return pa.RecordBatch.from_arrays(
            [pa.array(rk[some]), pa.array((pos - before + first)[some].astype(np.int32)),
             pa.array((pos - before + last + width)[some].astype(np.int32))], names=["rk", "low", "high"])

    def run(batches):
        held = None  # rows of the group that the next batch may go on with
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            gram = part.column("gram").to_numpy()
            if not len(gram):
                continue
            cut = int(np.searchsorted(gram, gram[-1], side="left"))
            held = part.slice(cut)
            if cut:
                yield ranges(part.slice(0, cut))
        if held is not None and held.num_rows:
            yield ranges(held)

    return (suffixes.repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, "rk long, low int, high int"))


def _whole_windows(joined: DataFrame, width: int) -> DataFrame:
    """``whole``, ``rk``, ``low``: a hash of each window whose anchor is listed as hot."""

    def run(batches):
        for batch in batches:
            keys, lists = np.asarray(batch.column(0)), batch.column(3).to_pylist()
            for first, part in W.slices(batch.column(2).to_pylist()):
                words = W.find(part)
                hashes, _, begin, anchor = _anchors(words, width)
                hot = np.zeros(len(words.starts) + 1, np.bool_)
                for i in range(len(part)):
                    hot[words.offsets[i] + np.array(lists[first + i], np.int64)] = True
                begin = begin[hot[anchor]]
                text = np.searchsorted(words.offsets, begin, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.windows(hashes, width)[begin].view(np.int64)), pa.array(keys[first + text]),
                     pa.array((begin - words.offsets[text]).astype(np.int32))], names=["whole", "rk", "low"])

    return joined.select("rk", "doc_id", "text", "hot").where("size(hot) > 0").mapInArrow(
        run, "whole long, rk long, low int")


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``text`` (kept words joined by one space) of every row.

    A window is ``width`` consecutive words of a text. Every word inside a window that also starts anywhere else, in the same text or another
    row, is removed; windows are judged on the input. Null texts have no words and give an empty text; rows that repeat are
    elsewhere to each other; doc_id may be null; an empty table gives no rows; other columns are not read.

    * Suffixes start at anchors only: the least prefix hash of each window. Two equal windows share their anchor's
      offset, so a repeat always shows as two suffixes with one prefix; a prefix that occurs once drops out after a combining count.
    * Suffixes are grouped by their first 12 words, each with the words of all windows round its anchor. A task sorts the
      groups that fit a batch and reads the trees' nodes off neighbouring suffixes.
    * Prefixes of more than 128 suffixes are lengthened to the whole window. Equal whole windows need no tree: they are counted with
      map-side sums, so a passage that a third of all rows share is no task's burden.
    * Texts are shuffled once by row key; the exchange serves all three joins.

    Words are compared inside a group by 32 bits of their hash, windows and prefixes by 64.
    """
    ship(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")) \
        .select(F.xxhash64("doc_id", "text").alias("rk"), "doc_id", "text")
    marks = anchors(texts, width)
    shared = checkpointed(marks.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                          .select("gram", (F.col("n") > GROUP).alias("is_hot")))
    places = (marks.join(shared, "gram").groupBy("rk")
              .agg(F.collect_set(F.when(~F.col("is_hot"), F.col("pos"))).alias("cold"),
                   F.collect_set(F.when(F.col("is_hot"), F.col("pos"))).alias("hot")))
    joined = texts.join(places, "rk")
    cold = _trees(_suffixes(joined, width), width)
    whole = _whole_windows(joined, width)
    # named by its complement, so that the join deals both sides anew and can split a hot window
    often = whole.groupBy("whole").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.expr("~whole").alias("other"))
    hot = whole.join(often, F.col("whole") == F.expr("~other"), "left_semi") \
        .select("rk", "low", (F.col("low") + width).alias("high"))
    spans = cold.union(hot).groupBy("rk").agg(F.collect_set(F.struct("low", "high")).alias("spans"))

    def run(batches):
        for batch in batches:
            doc, texts_, spans_ = batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            total, gone, out = [], [], []
            for text, found in zip(texts_, spans_, strict=True):
                parts = (text or b"").split()
                keep = np.ones(len(parts), np.bool_)
                for span in found or ():
                    keep[span["low"]:span["high"]] = False
                total.append(len(parts))
                gone.append(len(parts) - int(keep.sum()))
                out.append(b" ".join(compress(parts, keep) if found else parts))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"])

    return (texts.join(spans, "rk", "left").select("rk", "doc_id", "text", "spans")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, text string"))
