"""Pack tokenized documents into sequences: non-negative least squares over length combinations."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from voxstar.llm.staging import stored
from voxstar.llm.words import SLICE, mix, sixteen, slices
from voxstar.shipping import ship

#: Heads are cut to whole units; a combination has at most DEPTH heads.
UNIT = 128
DEPTH = 4
#: Units whose ids a worker keeps, some 200 bytes each; the first half stays.
CACHE = 1 << 18

#: Kinds of bytes: white space, letter, digit, other mark, and what only the tokenizer can split.
_SPACE, _LETTER, _DIGIT, _MARK, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[ord("'")] = _WHOLE
_KIND[ord("0"):ord("9") + 1] = _DIGIT
_KIND[ord("a"):ord("z") + 1] = _LETTER
_KIND[list(b" \t\n\v\f\r")] = _SPACE
#: Second bytes of the small letters from U+00DF to U+00FF, whose first byte is C3.
_LATIN = np.zeros(256, np.bool_)
_LATIN[0x9F:0xC0] = True
_LATIN[0xB7] = False
#: The steps for which ``_units`` knows the pieces of such letters, digits and marks.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
           "behavior": "Removed", "invert": True},
          {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary; a space stays one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)} | {0x20: " "}


def _runs(kind: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one kind other than white space begin and end; each byte of kind ``apart`` is a run."""
    cut = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == apart)))
    begins = np.flatnonzero(cut)
    ends, taken = np.append(begins[1:], len(kind)), kind[begins] != _SPACE
    return begins[taken], ends[taken]


def _units(data: np.ndarray, pieces: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and kind of each unit of lowered bytes: the pieces of words of small letters, digits and marks, other words whole.

    An apostrophe may begin a piece such as 's, so words with one stay whole. Without ``pieces`` all words do.
    """
    kind = _KIND[data]
    if pieces:
        first = np.flatnonzero(data[:-1] == 0xC3)
        first = first[_LATIN[data[first + 1]]]
        kind[first] = kind[first + 1] = _LETTER
    else:
        kind[kind != _SPACE] = _WHOLE
    hard = np.flatnonzero(kind == _WHOLE)
    if pieces and len(hard):
        space = np.flatnonzero(kind == _SPACE)
        after = np.unique(np.searchsorted(space, hard))
        low, high = np.append(-1, space)[after] + 1, np.append(space, len(kind))[after]
        kind[np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange((high - low).sum())] = _WHOLE
    begins, ends = _runs(kind, _DIGIT)
    return begins, ends, kind[begins]


def _distinct(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct unit, and for each place the number of its unit. Units over 16 bytes are not compared."""
    low, high = sixteen(data, begins, ends)
    order = np.argsort(mix(mix(low) + high))
    low, high, long = low[order], high[order], (ends - begins)[order] > 16
    fresh = np.ones(len(order), np.bool_)
    fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | long[1:] | long[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order[fresh], number


class Encoder:
    """Ids of texts by a tokenizer that drops white space, looked up unit by unit.

    Splitting at ASCII white space and lowering A-Z first changes no id: the tokenizer's normalizer lowers every character and its
    pieces never span white space. If its steps are those in _NORMAL and _SPLIT, words are split further into their pieces, of which
    there are fewer distinct ones. Texts that may hold a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[bytes, bytes] = {}
        mark = self.tokenizer.encode("\x01", add_special_tokens=False).ids
        self.between = mark[0] if len(mark) == 1 else None
        steps = json.loads(self.tokenizer.to_str())
        # the same model over pieces that are split, lowered and in byte letters already; its suffix marks each piece's last id
        self.model, self.letters = Tokenizer(self.tokenizer.model), _byte_letters()
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab, suffix = self.model.get_vocab(), steps["model"].get("end_of_word_suffix")
        self.pieces = ((steps["normalizer"] or {}).get("normalizers") == _NORMAL
                       and (steps["pre_tokenizer"] or {}).get("pretokenizers") == _SPLIT
                       and bool(suffix) and all({c, c + suffix} <= vocab.keys() for b, c in self.letters.items() if b != 0x20))
        self.lasts = np.zeros(max(vocab.values(), default=0) + 1, np.bool_)
        self.lasts[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _learn_pieces(self, pieces: list[bytes]) -> None:
        """Add the ids of some pieces."""
        for at in range(0, len(pieces), 2048):
            part = pieces[at:at + 2048]
            text = b" ".join(part).decode("latin-1").translate(self.letters)
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.append(0, np.flatnonzero(self.lasts[ids]) + 1) * self.dtype().itemsize).tolist()
            whole = ids.tobytes()
            self.known.update(zip(part, [whole[a:b] for a, b in pairwise(ends)], strict=True))

    def _learn_words(self, words: list[bytes]) -> None:
        """Add the ids of some words, encoded together, with a control character between them that is one id and occurs in none of them."""
        known, joined = self.known, []
        for word in words:
            if self.between is None or b"\x01" in word:
                known[word] = self._encode(word.decode("utf-8", "replace"))
            else:
                joined.append(word)
        for at in range(0, len(joined), 2048):
            part = joined[at:at + 2048]
            text = " \x01 ".join([w.decode("utf-8", "replace") for w in part])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.append(np.flatnonzero(ids == self.between), len(ids))
            begins = np.append(0, ends[:-1] + 1)
            known.update(zip(part, [ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], strict=True))

    def _found(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of lowered bytes: where each begins, how many ids it has, and the ids of all."""
        array = np.frombuffer(data, np.uint8)
        begins, ends, kind = _units(array, self.pieces)
        if not len(begins):
            return begins, begins, np.empty(0, self.dtype)
        places, number = _distinct(array, begins, ends)
        units = [data[a:b] for a, b in zip(begins[places].tolist(), ends[places].tolist(), strict=True)]
        known = self.known
        if missing := {u: k for u, k in zip(units, kind[places].tolist(), strict=True) if u not in known}:
            self._learn_pieces([u for u, k in missing.items() if k != _WHOLE])
            self._learn_words([u for u, k in missing.items() if k == _WHOLE])
        found = [known[u] for u in units]
        ids = np.frombuffer(b"".join(found), self.dtype)
        length = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype().itemsize
        first, count = (np.cumsum(length) - length)[number], length[number]
        if len(known) > CACHE:
            for unit in list(islice(reversed(known), len(known) - CACHE // 2)):
                del known[unit]
        return begins, count, ids[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as the bytes of ``dtype`` numbers."""
        plain = [b"" if b"<|" in text else text for text in texts]
        begins, count, ids = self._found(b"\n".join(plain).lower() + b"\n")
        starts = np.cumsum([0, *(len(text) + 1 for text in plain)])
        ends = np.append(0, np.cumsum(count))[np.searchsorted(begins, starts)].tolist()
        return [self._encode(text.decode("utf-8", "replace")) if b"<|" in text else ids[a:b].tobytes()
                for text, (a, b) in zip(texts, pairwise(ends), strict=True)]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """Each row's ids and where it stands among its partition's rows.

    A row of n ids has ``full`` whole windows, a head of ``head`` units and a tail of ``tail`` ids. ``before_full``, ``before_head``
    and ``before_tail`` count the partition's earlier windows, heads and tails of that length; they are written
    with the ids, so a later attempt cannot number rows differently.
    """
    units = window // UNIT

    def run(batches):
        encoder, pid = _encoder(path), TaskContext.get().partitionId()
        last = np.array([end], encoder.dtype).tobytes()
        fulls, heads, tails = 0, np.zeros(units, np.int64), np.zeros(UNIT, np.int64)
        for batch in batches:
            at = 0
            for _, part in slices(batch.column(1).to_pylist()):
                rows = []
                for ids in encoder.encode(part):
                    n = len(ids) // encoder.dtype().itemsize + 1
                    full, head, tail = n // window, n % window // UNIT, n % UNIT
                    rows.append((ids + last, n, full, head, tail, fulls, heads[head], tails[tail]))
                    fulls, heads[head], tails[tail] = fulls + full, heads[head] + 1, tails[tail] + 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(columns[0], pa.binary()),
                     pa.array([pid] * len(part), pa.int64()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                    names=["doc_id", "ids", "pid", "n", "full", "head", "tail", "before_full", "before_head", "before_tail"])
                at += len(part)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, ids binary, pid long, n long, full long, head long, tail long, "
             "before_full long, before_head long, before_tail long")


def combinations(total: int, depth: int) -> list[tuple[int, ...]]:
    """Falling tuples of 2 to ``depth`` lengths that fill ``total``."""
    found, open_ = [], [((), total, total - 1)]
    while open_:
        parts, left, most = open_.pop()
        if not left:
            found.append(parts)
        elif len(parts) < depth:
            open_ += [((*parts, m), left - m, m) for m in range(1, min(most, left) + 1)]
    return sorted(found, reverse=True)


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |ax - b|, by the active-set method: free the variable with the steepest gradient, solve for the free ones, and
    step back to the first that would turn negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], np.bool_)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(3 * a.shape[1]):
        slope = np.where(free, -np.inf, a.T @ (b - a @ x))
        if slope.max(initial=-np.inf) <= limit:
            break
        free[slope.argmax()] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (z <= 0)
            if not low.any():
                x = z
                break
            step = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x = x + step * (z - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


@dataclass
class Plan:
    """Where the k-th head of each length goes, and the k-th tail.

    ``slots[m]``: (first rank, end, first sequence, offset in units). Heads from ``spare[m]`` on and all tails run on in one stream that
    is cut at window ends; ``stream`` has the place of each length's first.
    """

    slots: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    spare: dict[int, int] = field(default_factory=dict)
    stream: dict[int, int] = field(default_factory=dict)
    tails: dict[int, int] = field(default_factory=dict)
    first: int = 0


def plan(fulls: int, heads: dict[int, int], tails: dict[int, int], units: int) -> Plan:
    """Combinations and their repeat counts from the histograms.

    The counts solve the least squares, rounded down and held to what is there. What is left is packed greedily, longest first, again into
    whole windows; heads that fit no whole window join the stream.
    """
    left = {m: heads.get(m, 0) for m in range(1, units)}
    out, taken, sequence = Plan(), dict.fromkeys(left, 0), fulls
    out.slots = {m: [] for m in left}

    def use(parts: tuple[int, ...], times: int) -> None:
        nonlocal sequence
        at = 0
        for m in parts:
            out.slots[m].append((taken[m], taken[m] + times, sequence, at))
            taken[m] += times
            left[m] -= times
            at += m
        sequence += times

    def room(parts: tuple[int, ...]) -> int:
        return min(left[m] // parts.count(m) for m in parts)

    shapes = combinations(units, DEPTH)
    matrix = np.array([[parts.count(m) for parts in shapes] for m in left], np.float64)
    wanted = least_squares(matrix, np.array(list(left.values()), np.float64))
    for k in np.argsort(-wanted, kind="stable"):
        if (times := min(int(wanted[k] + 1e-6), room(shapes[k]))) > 0:
            use(shapes[k], times)
    for longest in sorted(left, reverse=True):
        while left[longest]:
            parts, space = [longest], units - longest
            for m in range(min(longest, space), 0, -1):
                while m <= space and left[m] > parts.count(m):
                    parts.append(m)
                    space -= m
            if space:
                break
            use(tuple(parts), room(tuple(parts)))
    out.first, at = sequence, 0
    for m in sorted(left, reverse=True):
        out.spare[m], out.stream[m] = taken[m], at
        at += left[m] * m * UNIT
    for s in sorted(tails, reverse=True):
        out.tails[s] = at
        at += s * tails[s]
    return out


def _cut(at: int, length: int, first: int, window: int) -> list[tuple[int, int, int]]:
    """(sequence, offset, length) of a stretch of the stream."""
    out = []
    while length:
        part = min(length, window - at % window)
        out.append((first + at // window, at % window, part))
        at, length = at + part, length - part
    return out


def _place(plan_: Plan, window: int) -> Callable:
    def place(n: int, full: int, head: int, tail: int, f: int, h: int, t: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of a document's pieces, from its global ranks."""
        out = [(j * window, window, f + j, 0) for j in range(full)]
        start = full * window
        if head:
            if h < plan_.spare[head]:
                slots = plan_.slots[head]
                low, _, sequence, at = slots[np.searchsorted(ends[head], h, side="right")]
                where = [(sequence + h - low, at * UNIT, head * UNIT)]
            else:
                where = _cut(plan_.stream[head] + (h - plan_.spare[head]) * head * UNIT, head * UNIT, plan_.first, window)
            for sequence, at, length in where:
                out.append((start, length, sequence, at))
                start += length
        if tail:
            for sequence, at, length in _cut(plan_.tails[tail] + t * tail, tail, plan_.first, window):
                out.append((start, length, sequence, at))
                start += length
        return out

    ends = {m: np.array([s[1] for s in slots], np.int64) for m, slots in plan_.slots.items()}
    return place


def pack(docs: DataFrame, tokenizer: str, end: int, window: int = 4096) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is the ids of its whole text (null: empty) and ``end``. It is cut into whole windows, a head of whole
    128-id units and a tail; sequences hold ``window`` ids and only the very last may hold fewer. Repeated rows and doc_ids are
    documents of their own, doc_id may be null, an empty table gives no rows, other columns are not read.

    Only the histogram of head lengths (31 numbers) and tail lengths (127) reaches the driver, which enumerates the falling combinations
    of up to four heads that fill a window, solves their repeat counts by non-negative least squares, rounds them, and packs what is left
    greedily. A document's place then follows from its rank among documents of its length: ranks inside a partition are written with
    the ids, and each partition's first ranks come from a running sum over partitions per length. No window or sort runs over documents, and a
    length that a third of them share makes no hot task.
    """
    spark = ship(docs.sparkSession)
    staged = stored(tokenized(docs, tokenizer, end, window), "tokens", compression="zstd")
    amounts = staged.select("pid", F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("kind"), F.col("full").alias("amount")),
        F.struct(F.col("head").alias("kind"), (F.col("head") > 0).cast("long").alias("amount")),
        F.struct((F.lit(window) + F.col("tail")).alias("kind"), (F.col("tail") > 0).cast("long").alias("amount")))).alias("x"))
    counts = stored(amounts.where("x.amount > 0").groupBy("pid", "x.kind").agg(F.sum("x.amount").alias("amount")), "lengths")
    totals = {r["kind"]: r["amount"] for r in counts.groupBy("kind").agg(F.sum("amount").alias("amount")).collect()}
    drawn = plan(totals.get(0, 0), {k: v for k, v in totals.items() if 0 < k < window},
                 {k - window: v for k, v in totals.items() if k > window}, window // UNIT)
    earlier = Window.partitionBy("kind").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(counts.withColumn("first", F.coalesce(F.sum("amount").over(earlier), F.lit(0)))
                    .groupBy("pid").agg(F.map_from_entries(F.collect_list(F.struct("kind", "first"))).alias("firsts")), "firsts")
    narrow = _width(tokenizer)

    def run(batches):
        place = _place(drawn, window)
        for batch in batches:
            doc, ids, rows = batch.column(0), batch.column(1).to_pylist(), zip(
                *(batch.column(i).to_pylist() for i in range(2, 9)), strict=True)
            out, source, size = [], [], 0
            for i, (n, full, head, tail, f, h, t) in enumerate(rows):
                words = np.frombuffer(ids[i], narrow).astype("<u4")
                for start, length, sequence, at in place(n, full, head, tail, f, h, t):
                    out.append((start, length, words[start:start + length].tobytes(), n, sequence, at))
                    source.append(i)
                size += n
                if size >= SLICE or i + 1 == len(ids):
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [doc.take(pa.array(source)), *[pa.array(c, pa.binary() if k == 2 else pa.int64())
                                                       for k, c in enumerate(columns)]],
                        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                    out, source, size = [], [], 0

    rank = lambda before, kind: (F.col(before) + F.coalesce(F.col("firsts")[kind], F.lit(0))).alias(before)
    joined = staged.join(firsts, "pid", "left").select(
        "doc_id", "ids", "n", "full", "head", "tail", rank("before_full", F.lit(0).cast("long")), rank("before_head", F.col("head")),
        rank("before_tail", F.lit(window) + F.col("tail")))
    return joined.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long")


def _width(tokenizer: str) -> str:
    return "<u2" if _encoder(tokenizer).dtype is np.uint16 else "<u4"
