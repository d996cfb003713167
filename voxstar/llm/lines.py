"""Line dedup: an exact set-similarity join over the lines of all texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voxstar.llm import words as W
from voxstar.llm.staging import checkpointed, packed, stored
from voxstar.shipping import ship

#: Counters of the word counts that order tokens by rarity: a byte each for the workers. Frequent words, of which there are some ten
#: thousands in any corpus, then share a counter with a rare word for one in a hundred.
COUNTER_BITS = 22
#: Words counted together, rows a task holds until it deals them out, and bytes of them compared together.
_TOGETHER = 1 << 22
_HELD = 1 << 17
_CHUNK = 1 << 22
_ONE = np.uint64(1)
#: Sizes from which a set has 128 and 256 toggled bits; below, 64 tell two sets apart.
BITS_FROM = (64, 128)
_PLACE, _GONE, _DOUBT = "place", "gone", "doubt"


def _lines(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The line of each word, numbered through the slice, and the first line of each text (a text ends a line)."""
    breaks = np.flatnonzero(words.data == 10)
    here = np.diff(np.searchsorted(words.starts, breaks), prepend=0)
    return np.repeat(np.arange(len(breaks)), here), np.searchsorted(breaks, words.texts[:-1])


def word_counts(docs: DataFrame) -> np.ndarray:
    """How often words occur, by hash counter, as levels of a byte: exact up to 16, then eight levels to each doubling.

    A task sends its counters in blocks, at most 2^22 in all; blocks are added up in tasks of their own and the driver gets a byte a counter.
    """
    block = 1 << 12

    def run(batches):
        counts, held, size = np.zeros(1 << COUNTER_BITS, np.int64), [], 0
        for batch in batches:
            for _, part in W.slices(batch.column(0).to_pylist()):
                held.append((W.find(part).hashes() >> np.uint64(64 - COUNTER_BITS)).astype(np.int32))
                size += len(held[-1])
                if size > _TOGETHER:
                    counts += np.bincount(np.concatenate(held), minlength=len(counts))
                    held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=len(counts))
        some = np.flatnonzero(counts)
        edges = np.append(np.flatnonzero(np.diff(some // block, prepend=-1)), len(some))
        cuts = list(zip(edges[:-1], edges[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(some[i] // block) for i, _ in cuts], pa.int64()),
             pa.array([(some[i:j] % block).astype(np.uint16).tobytes() for i, j in cuts], pa.binary()),
             pa.array([counts[some[i:j]].tobytes() for i, j in cuts], pa.binary())], names=["block", "at", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, at, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                mine = sums.setdefault(key, np.zeros(block, np.int64))
                mine[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
        levels = {k: np.minimum(np.where(n <= 16, n, 16 + 8 * np.log2(np.maximum(n, 16) / 16)), 255).astype(np.uint8) for k, n in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(levels), pa.int64()), pa.array([x.tobytes() for x in levels.values()], pa.binary())],
                                         names=["block", "levels"])

    sent = docs.select("text").mapInArrow(run, "block long, at binary, n binary")
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    for key, levels in sent.repartition("block").mapInArrow(add, "block long, levels binary").collect():
        out[key * block:(key + 1) * block] = np.frombuffer(levels, np.uint8)
    return out


def rare_first(hashes: np.ndarray, group: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each group (numbered from 0, in order), from the rarest, and where each group begins.

    The order is by (level of the count, hash), the same in every group.
    """
    n_groups = int(group[-1]) + 1 if len(group) else 0
    level = counts[(hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    free = 56 - n_groups.bit_length()  # group, level and the first bits of the hash in one number: one sort instead of three
    key = (group.astype(np.uint64) << np.uint64(free + 8)) | (level.astype(np.uint64) << np.uint64(free)) | (hashes >> np.uint64(64 - free))
    order = np.argsort(key)
    sorted_ = hashes[order]
    same = key[order[1:]] == key[order[:-1]]
    if (sorted_[1:][same] != sorted_[:-1][same]).any():  # two hashes with the same first bits
        order = np.lexsort((hashes, level, group))
        sorted_ = hashes[order]
    hashes, group = sorted_, group[order]
    fresh = np.ones(len(hashes), np.bool_)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1])
    hashes, group = hashes[fresh], group[fresh]
    return hashes, np.searchsorted(group, np.arange(n_groups))


def _alone(n, percent: int):
    """Whether a set of n words can match equal sets only; it needs no prefix then."""
    return 100 * n < percent * (n + 1)


def _heads(hashes: np.ndarray, begins: np.ndarray, percent: int, wanted: np.ndarray | None = None,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each group: its size, and which groups and positions its prefix holds (none if not ``wanted``), and their hashes."""
    sizes = np.diff(np.append(begins, len(hashes)))
    long = sizes - (percent * sizes + 99) // 100 + 1
    if wanted is not None:
        long = np.where(wanted, long, 0)
    owner = np.repeat(np.arange(len(sizes)), long)
    pos = np.arange(len(owner)) - np.repeat(np.cumsum(long) - long, long)
    return sizes, owner, pos, hashes[begins[owner] + pos]


def _toggled(hashes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Four numbers per group, with one bit toggled by each member: sets differ in at least as many members as their bits differ.

    Small groups use 64 bits, those from BITS_FROM on 128 and 256; a longer form folds into a shorter by exclusive or.
    """
    bit, place = _ONE << (hashes & np.uint64(63)), (hashes >> np.uint64(6)) & np.uint64(3)
    four = [np.bitwise_xor.reduceat(np.where(place == j, bit, np.uint64(0)), begins) for j in range(4)]
    two = [four[0] ^ four[2], four[1] ^ four[3]]
    zero = np.zeros_like(two[0])
    form = np.digitize(sizes, BITS_FROM)
    return [np.choose(form, (a, b, c)).view(np.int64) for a, b, c in zip(
        (two[0] ^ two[1], zero, zero, zero), (*two, zero, zero), four, strict=True)]


#: A task deals its rows to buckets by the first bits of a token (prefixes), a set (places) or a row's hash (places known to be later ones).
#: The rows of a bucket are one value: column after column, of a size or position the low byte apart from the rest, which is next to always 0.
_BUCKET_BITS = 12
_PREFIX, _FIRST, _LATER = range(3)
_PREFIX_CELLS = tuple(np.dtype(t) for t in ("<u4", "<i8", "<i8", "<i8", "u1", "<u4", "u1", "<u4"))
_PLACE_CELLS = tuple(np.dtype(t) for t in ("<i8", "u1", "<i8", "<u4", "<i8"))


def _cells(kind: int, bucket: np.ndarray, columns: list[np.ndarray], types: tuple[np.dtype, ...]) -> pa.RecordBatch:
    """One value for each bucket; rows come in order of it."""
    edges = np.append(np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1)), len(bucket)).tolist()
    views = [(memoryview(c.astype(t)).cast("B"), t.itemsize) for c, t in zip(columns, types, strict=True)]
    cells = [b"".join([v[i * n:j * n] for v, n in views]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(((kind << _BUCKET_BITS) + bucket[edges[:-1]]).astype(np.int32)), pa.array(cells, pa.binary())],
                                      names=["bucket", "cells"])


def _columns(cells: list[bytes], types: tuple[np.dtype, ...]) -> list[np.ndarray]:
    """The columns of some values, one after another."""
    rows, parts = [len(c) // sum(t.itemsize for t in types) for c in cells], []
    at = [0] * len(cells)
    for t in types:
        parts.append(np.concatenate([np.frombuffer(c, t, n, i) for c, n, i in zip(cells, rows, at, strict=True)]))
        at = [i + n * t.itemsize for i, n in zip(at, rows, strict=True)]
    return parts


def _prefix_columns(buckets: list[int], cells: list[bytes]) -> list[np.ndarray]:
    """Token, ``s1``, size, position and two numbers of bits of each prefix row. Of a token there are the first 44 bits."""
    low, s1, b0, b1, *sizes = _columns(cells, _PREFIX_CELLS)
    width = sum(t.itemsize for t in _PREFIX_CELLS)
    high = np.repeat(np.array(buckets, np.int64), [len(c) // width for c in cells])
    n, pos = (a.astype(np.int64) | (b.astype(np.int64) << 8) for a, b in (sizes[:2], sizes[2:]))
    return [(high << 32) | low, s1, n, pos, b0, b1]


def _earliest(s1: np.ndarray, known: np.ndarray, doc_id: np.ndarray, line_no: np.ndarray, rk: np.ndarray,
              ) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The first place of each set in order of ``s1``, and all others, each place once. ``known``: whether there is a doc_id."""
    columns = [s1, known, doc_id, line_no, rk]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.ones(len(s1), np.bool_)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    columns = [c[fresh] for c in columns]
    first = np.ones(len(columns[0]), np.bool_)
    first[1:] = columns[0][1:] != columns[0][:-1]
    return [c[first] for c in columns], [c[~first] for c in columns]


def dealt(docs: DataFrame, percent: int, counts: np.ndarray) -> DataFrame:
    """``bucket`` and ``cells``, its rows. Places: of every line with a word, ``s1``, doc_id, line number and ``rk``; what is not the first of
    its set in a task is a later one already. Prefixes: for each set, once per task, a row for each of its rarest words, as many
    as a match must share one of: token, ``s1``, size, position and bits toggled by its words.

    ``s1`` is a hash of the line's set of words, the same for equal sets. Sets that can match equal sets only have no prefix, and words
    that occur once in all texts, which no other line shares, are left out. Rows travel as values of some kB: Spark moves and sorts few of them.
    """

    def sent(prefix, places):
        if prefix:
            token, s1, b0, b1, n, pos = (np.concatenate(c) for c in zip(*prefix, strict=True))
            if len(token):
                key = token >> np.uint64(32 - _BUCKET_BITS)
                order = np.argsort(key)
                key, s1, b0, b1, n, pos = (c[order] for c in (key, s1, b0, b1, n, pos))
                yield _cells(_PREFIX, key >> np.uint64(32), [key, s1, b0, b1, n & 255, n >> 8, pos & 255, pos >> 8], _PREFIX_CELLS)
        if places:
            first, later = _earliest(*(np.concatenate(c) for c in zip(*places, strict=True)))
            for kind, by, columns in ((_FIRST, 0, first), (_LATER, 4, later)):
                bucket = columns[by].view(np.uint64) >> np.uint64(64 - _BUCKET_BITS)
                order = np.argsort(bucket, kind="stable")
                if len(order):
                    yield _cells(kind, bucket[order], [c[order] for c in columns], _PLACE_CELLS)

    def run(batches):
        met, prefix, places, size = set(), [], [], 0
        for batch in batches:
            for first, part in W.slices(batch.column(2).to_pylist()):
                words = W.find(part)
                line, starts = _lines(words)
                if not len(line):
                    continue
                fresh = np.concatenate(([True], line[1:] != line[:-1]))
                number, group = line[fresh], np.cumsum(fresh) - 1
                hashes, begins = rare_first(words.hashes(), group, counts)
                s1 = np.add.reduceat(W.mix(hashes), begins).view(np.int64)
                text = np.searchsorted(starts, number, side="right") - 1
                rows = pa.array(first + text)
                doc_id = batch.column(1).take(rows)
                places.append((s1, np.asarray(doc_id.is_valid()).astype(np.uint8), np.asarray(doc_id.fill_null(0)), number - starts[text],
                               np.asarray(batch.column(0).take(rows))))
                new = np.zeros(len(s1), np.bool_)
                new[np.unique(s1, return_index=True)[1]] = True
                new &= np.fromiter((x not in met for x in s1.tolist()), np.bool_, len(s1))
                met.update(s1[new].tolist())
                sizes = np.diff(np.append(begins, len(hashes)))
                sizes, owner, pos, token = _heads(hashes, begins, percent, new & ~_alone(sizes, percent))
                shared = counts[(token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)] > 1
                owner, pos, token = owner[shared], pos[shared], token[shared]
                bits = _toggled(hashes, begins, np.minimum(sizes, BITS_FROM[1] - 1))
                prefix.append((token, s1[owner], bits[0][owner], bits[1][owner], sizes[owner], pos))
                size += len(s1) + len(token)
                if size > _HELD:
                    yield from sent(prefix, places)
                    prefix, places, size = [], [], 0
        yield from sent(prefix, places)

    return docs.select("rk", "doc_id", "text").mapInArrow(run, "bucket int, cells binary")


def prefixes(docs: DataFrame, percent: int, counts: np.ndarray) -> DataFrame:
    """What ``dealt`` sends, row by row: ``s1``, and in ``meta`` the size and position of a prefix row, or a negative number for a place."""

    def run(batches):
        for batch in batches:
            for bucket, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket >> _BUCKET_BITS == _PREFIX:
                    _, s1, n, pos, _, _ = _prefix_columns([bucket], [cell])
                    meta = (n << 32) | pos
                else:
                    s1, _, _, line_no, _ = _columns([cell], _PLACE_CELLS)
                    meta = -1 - line_no.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(s1), pa.array(meta)], names=["s1", "meta"])

    return dealt(docs, percent, counts).mapInArrow(run, "s1 long, meta long")


def _by_token(token: np.ndarray, n: np.ndarray, s1: np.ndarray) -> np.ndarray:
    """The order by token, n and s1."""
    if len(token) and (token[1:] >= token[:-1]).all():  # rows of a task come so: number of the token, n and the first bits of s1 in one number
        rank = np.cumsum(np.concatenate(([False], token[1:] != token[:-1]))).astype(np.uint64)
        free = 64 - int(rank[-1]).bit_length() - int(n.max()).bit_length()
        if 0 < free < 64:
            high = (rank << np.uint64(64 - int(rank[-1]).bit_length())) if rank[-1] else rank
            key = high | (n.astype(np.uint64) << np.uint64(free)) | (s1.view(np.uint64) >> np.uint64(64 - free))
            order = np.argsort(key)
            same = key[order[1:]] == key[order[:-1]]
            if (s1[order[1:][same]] == s1[order[:-1][same]]).all():
                return order
    return np.lexsort((s1, n, token))


def likely(token: np.ndarray, s1: np.ndarray, n: np.ndarray, pos: np.ndarray, b0: np.ndarray, b1: np.ndarray, percent: int) -> np.ndarray:
    """``s1`` of the sets that share a token with another set and pass the length, position and bit filters with it.

    The rows of equal sets under one token are one row. Rows of one token are in order of size; each is compared with the next, the
    one after it and so on, all tokens at once, until sizes are too far apart.
    """
    order = _by_token(token, n, s1)
    token, s1, n, pos, b0, b1 = (a[order] for a in (token, s1, n, pos, b0, b1))
    fresh = np.ones(len(token), np.bool_)
    fresh[1:] = (token[1:] != token[:-1]) | (s1[1:] != s1[:-1])
    if len(token):
        pos = np.minimum.reduceat(pos, np.flatnonzero(fresh))  # two words of a set may share the first bits of a token
    token, s1, n, b0, b1 = (a[fresh] for a in (token, s1, n, b0, b1))
    n, pos, b0, b1 = n.astype(np.int64), pos.astype(np.int64), b0.view(np.uint64), b1.view(np.uint64)
    found, small, step = np.zeros(len(token), np.bool_), np.arange(len(token)), 0
    while len(small):
        step += 1
        small = small[small + step < len(token)]
        large = small + step
        near = (token[small] == token[large]) & (100 * n[small] >= percent * n[large])
        small, large = small[near], large[near]
        open_ = ~(found[small] & found[large])
        x, y = small[open_], large[open_]
        both = n[x] + n[y]
        overlap = (percent * both + 99 + percent) // (100 + percent)
        most = both - 2 * overlap
        ok = np.minimum(n[x] - pos[x], n[y] - pos[y]) >= overlap
        ok &= np.bitwise_count(b0[x] ^ b1[x] ^ b0[y] ^ b1[y]) <= most
        ok &= (n[x] < BITS_FROM[0]) | (np.bitwise_count(b0[x] ^ b0[y]).astype(np.int64) + np.bitwise_count(b1[x] ^ b1[y]) <= most)
        found[x[ok]] = True
        found[y[ok]] = True
    return np.unique(s1[found])


def compared(cells: DataFrame, percent: int) -> DataFrame:
    """``kind``, ``s1``, ``doc_id``, ``rk``, ``line_no``: the first place of each set, the later ones, and the sets with a likely partner (``doubt``).

    A bucket comes together in one task, which holds one and the rest of a chunk. At any size of the tables the buckets of prefixes
    have a 4096th of all tokens each; those of places have at most one place of a set from each task and chunk that dealt it.
    """
    kinds = "kind string, s1 long, doc_id long, rk long, line_no int"

    def rows(kind, s1, known=None, doc_id=None, line_no=None, rk=None):
        rest = [pa.nulls(len(s1), t) for t in (pa.int64(), pa.int64(), pa.int32())] if known is None else [
            pa.array(doc_id, mask=known == 0), pa.array(rk), pa.array(line_no.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(s1), pa.string()), pa.array(s1), *rest], names=["kind", "s1", "doc_id", "rk", "line_no"])

    def settled(kind, buckets, cells):
        if kind == _PREFIX:
            columns = _prefix_columns(buckets, cells)
            order = np.argsort(columns[0], kind="stable")  # merges the cells, which are in order
            yield rows(_DOUBT, likely(*(c[order] for c in columns), percent))
        else:
            columns = _columns(cells, _PLACE_CELLS)
            first, later = _earliest(*columns) if kind == _FIRST else ([c[:0] for c in columns], columns)
            yield rows(_PLACE, *first)
            yield rows(_GONE, *later)

    def run(batches):
        buckets, held, size = [], [], 0
        for part in (batch.slice(at, 1000) for batch in batches for at in range(0, batch.num_rows, 1000)):
            for bucket, cell in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if held and bucket != buckets[-1]:
                    kind = buckets[-1] >> _BUCKET_BITS
                    if size > _CHUNK or kind != bucket >> _BUCKET_BITS:
                        yield from settled(kind, buckets, held)
                        buckets, held, size = [], [], 0
                buckets.append(bucket)
                held.append(cell)
                size += len(cell)
        if held:
            yield from settled(buckets[-1] >> _BUCKET_BITS, buckets, held)

    return cells.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, kinds)


def _can_match(percent: int, x: str = "x_", y: str = "y_") -> Column:
    """The filters on two rows of one token, with columns named from x and y: toggled bits, length, and position (the first
    word that a match shares leaves room for the overlap behind it)."""
    both, smaller = F.col(x + "n") + F.col(y + "n"), F.least(x + "n", y + "n")
    overlap = F.expr(f"({percent} * ({x}n + {y}n) + {99 + percent}) div {100 + percent}")
    most = both - 2 * overlap
    one, two, three, four = (F.col(f"{x}b{j}").bitwiseXOR(F.col(f"{y}b{j}")) for j in range(4))
    few = F.bit_count(one.bitwiseXOR(two).bitwiseXOR(three).bitwiseXOR(four)) <= most
    some = F.bit_count(one.bitwiseXOR(three)) + F.bit_count(two.bitwiseXOR(four)) <= most
    many = F.bit_count(one) + F.bit_count(two) + F.bit_count(three) + F.bit_count(four) <= most
    return (few & (100 * smaller >= percent * F.greatest(x + "n", y + "n"))
            & (F.least(F.col(x + "n") - F.col(x + "pos"), F.col(y + "n") - F.col(y + "pos")) >= overlap)
            & (some | (smaller < BITS_FROM[0])) & (many | (smaller < BITS_FROM[1])))


def _named(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``s1`` and its whole set of words, as 64-bit hashes, of each wanted (rk, line_no, s1)."""
    listed = wanted.groupBy("rk").agg(F.collect_list(F.struct("line_no", "s1")).alias("wanted"))

    def run(batches):
        for batch in batches:
            lists, rows = batch.column(1).to_pylist(), []
            for i, text in enumerate(batch.column(0).to_pylist()):
                split = text.split(b"\n")
                words = W.find([split[w["line_no"]] for w in lists[i]])
                hashes = words.hashes()
                for k, w in enumerate(lists[i]):
                    rows.append((w["s1"], np.unique(hashes[words.offsets[k]:words.offsets[k + 1]]).tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["s1", "words"])

    return docs.select("rk", "text").join(listed, "rk").select("text", "wanted").mapInArrow(run, "s1 long, words binary").dropDuplicates(["s1"])


def _set_heads(sets: DataFrame, percent: int, counts: np.ndarray) -> DataFrame:
    """Prefix rows of whole sets."""
    names = ["token", "pos", "n", "s1", "doc_id", "line_no", "rk", "b0", "b1", "b2", "b3"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sets_ = [np.frombuffer(b, np.uint64) for b in part.column(1).to_pylist()]
                group = np.repeat(np.arange(len(sets_)), [len(s) for s in sets_])
                hashes, begins = rare_first(np.concatenate(sets_), group, counts)
                sizes, owner, pos, token = _heads(hashes, begins, percent)
                owner_ = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(pos), pa.array(sizes[owner]), part.column(0).take(owner_),
                     *[part.column(i).take(owner_) for i in (2, 3, 4)],
                     *[pa.array(b[owner]) for b in _toggled(hashes, begins, sizes)]], names=names)

    whole = sets.select("s1", "words", "doc_id", F.col("line_no").cast("long").alias("line_no"), "rk")
    return whole.mapInArrow(run, ", ".join(f"{n} long" for n in names))


#: What comes first: null doc_ids first; the row's hash tells lines at one place of several texts apart.
_ORDER = ("doc_id", "line_no", "rk")


def _earlier(x: str, y: str) -> Column:
    """Whether x comes before y; null ids first."""
    place = lambda side: F.struct(*[F.col(f"{side}_{c}") for c in _ORDER])
    return place(x) < place(y)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``s1`` of each y whose set reaches the similarity with its x."""
    x = sets.select(F.col("s1").alias("x_s1"), F.col("words").alias("x_words"))
    y = sets.select(F.col("s1").alias("y_s1"), F.col("words").alias("y_words"))

    def run(batches):
        for batch in batches:
            later = []
            for s1, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    later.append(s1)
            yield pa.RecordBatch.from_arrays([pa.array(later, pa.int64())], names=["s1"])

    return (pairs.select("x_s1", "y_s1").join(y, "y_s1").join(x, "x_s1").select("y_s1", "x_words", "y_words")
            .mapInArrow(run, "s1 long").distinct())


def beaten_sets(sets: DataFrame, percent: int, counts: np.ndarray, n_sets: int = 0) -> DataFrame:
    """``s1`` of every set that some set with an earlier first line matches; ``n_sets``: about how many there are.

    First each set meets only the earliest holder of each of its prefix words among sets of about its size: one pair per word, and
    a group of near copies is settled against its first member. Only sets that nothing has beaten yet meet all others.
    """
    ratio = 100 / percent
    heads = checkpointed(_set_heads(sets, percent, counts).withColumn("band", F.floor(F.log(ratio, F.col("n")))))
    first = (*_ORDER, "s1", "pos", "n", "b0", "b1", "b2", "b3")
    hubs = packed(heads.groupBy(F.col("token").alias("x_token"), F.col("band").alias("x_band"))
                  .agg(F.count(F.lit(1)).alias("members"), F.min(F.struct(*first)).alias("first")).where("members > 1")
                  .select("x_token", "x_band", *[F.col(f"first.{c}").alias(f"x_{c}") for c in first]), n_sets)
    y = _named(heads, "y")
    near = (y.join(hubs, (F.col("y_token") == F.col("x_token")) & (F.col("y_band") == F.col("x_band")) & (F.col("x_s1") != F.col("y_s1"))
                   & _earlier("x", "y") & _can_match(percent)).select("x_s1", "y_s1").distinct())
    near = packed(near, n_sets)
    beaten = packed(_verified(near, sets, percent), n_sets)
    open_ = checkpointed(heads.join(beaten, "s1", "left_anti"))
    rest = (_named(open_, "y").join(_named(heads, "x"), (F.col("y_token") == F.col("x_token")) & (F.col("x_s1") != F.col("y_s1"))
                                    & _earlier("x", "y") & _can_match(percent)).select("x_s1", "y_s1").distinct())
    rest = packed(rest.join(near, ["x_s1", "y_s1"], "left_anti"), n_sets)
    return beaten.union(_verified(rest, sets, percent))


def dedup_lines(docs: DataFrame, percent: int = 80, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``keep``, ``text`` without removed lines, ``n_lines`` and ``n_removed`` of every row.

    Lines are cut at \\n; two match when the Jaccard similarity of their sets of words is ``percent`` % or more. A line goes if any
    earlier line matches it, whether or not that one goes itself; earlier means by (doc_id, line number), null doc_ids first, and by a
    hash of the row where several texts have a line there. Every line with a word is compared, lines without one stay. Rows with equal
    doc_id and text are one document and get one result. A null text stays null and has 0 lines; an empty table gives no rows.

    Words are ordered by rarity (a count per hash counter, then the hash), the same order everywhere. Equal sets of words are one set
    from the start: a line that a third of all texts hold has one prefix row a task and is compared once. A set's prefix is its
    rarest words, so many that two matching sets share one. The rows of a prefix word meet in a bucket; length, position and bit filters
    leave the sets with a likely partner. Only of those the words are fetched, and whole sets decide.
    """
    spark = ship(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *[F.col(c).alias("keep_" + c) for c in keep]) \
        .select(F.xxhash64("doc_id", "text").alias("rk"), "*")
    counts = word_counts(texts)
    rows = stored(compared(dealt(texts, percent, counts), percent), "lines", "lz4")
    doubtful = rows.where(F.col("kind") == _DOUBT).select("s1")
    wanted = stored(rows.where(F.col("kind") == _PLACE).select("s1", *_ORDER).join(doubtful, "s1", "left_semi"), "wanted", "lz4")
    n_sets = wanted.count()
    sets = checkpointed(_fetched(texts, wanted).join(wanted, "s1"))
    beaten = beaten_sets(sets, percent, counts, n_sets)

    # a later line of a set always goes, its first line only if the set is beaten
    firsts = packed(wanted.join(beaten, "s1", "left_semi").select("rk", "line_no"), n_sets)
    gone = (rows.where(F.col("kind") == _GONE).select("rk", "line_no").union(firsts)
            .groupBy("rk").agg(F.collect_set("line_no").alias("gone")))
    width = len(keep)

    def run(batches):
        for batch in batches:
            out, total, removed = [], [], []
            for text, drop in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                split = text.split(b"\n") if text is not None else []
                total.append(len(split))
                removed.append(len(drop or ()))
                if drop:
                    drop = set(drop)
                    text = b"\n".join([line for k, line in enumerate(split) if k not in drop])
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *[batch.column(4 + i) for i in range(width)], pa.array(out, pa.binary()).cast(pa.string()),
                 pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                names=["doc_id", *keep, "text", "n_lines", "n_removed"])

    joined = texts.join(gone, "rk", "left").select("rk", "doc_id", "text", "gone", *["keep_" + c for c in keep])
    schema = docs.select("doc_id", *keep).schema.add("text", "string").add("n_lines", "long").add("n_removed", "long")
    return joined.mapInArrow(run, schema)
