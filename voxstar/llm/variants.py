"""Group spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

An edit lies in the first or in the second half of the shorter word, so two words at one edit share the other half. Words
that share a half, and whose shorter length is m, form a list. A list is sorted by what its words do not share and scanned for
each of its words: the rows of the edit matrix, three cells wide, are kept from one entry to the next as far as their common prefix
reaches, and once a row has no cell below two, all entries that share the prefix up to it are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from voxstar.llm.staging import stored
from voxstar.shipping import ship

#: A list with more words than this is split by quarters instead of halves, so that one task's memory stays bounded.
LONG_LIST = 20_000
#: Shorter words are left alone: with a half of fewer than two letters lists would not be selective.
LEAST = 4
#: A letter of a word.
LETTER = "[A-Za-z\u00C0-\u00FF]"
_DEAD = 26


@lru_cache(maxsize=1)
def _rows() -> list[int]:
    """The next row of the matrix by row and matches: ``8 * row + bits`` gives the next row's number.

    A row has the cells left of, on and right of the diagonal, each 0, 1 or 2 (two or more), numbered as digits of base 3. Bit k says
    that the entry's next character equals the word's at that cell.
    """
    out = []
    for row in range(27):
        left, on, right = row // 9, row // 3 % 3, row % 3
        for bits in range(8):
            a = min(left + 1 - (bits & 1), on + 1)
            b = min(on + 1 - (bits >> 1 & 1), right + 1, a + 1)
            c = min(right + 1 - (bits >> 2 & 1), b + 1)
            out.append(9 * min(a, 2) + 3 * min(b, 2) + min(c, 2))
    return out


def one_edit_apart(entries: list[str]) -> Iterator[tuple[int, int]]:
    """Places (i, j), i < j, of entries at exactly one edit, in a sorted list of distinct strings."""
    table, n = _rows(), len(entries)
    common = [0] * (n + 1)  # with the entry before
    for i in range(1, n):
        a, b = entries[i - 1], entries[i]
        k, top = 0, min(len(a), len(b))
        while k < top and a[k] == b[k]:
            k += 1
        common[i] = k
    common[n] = -1
    beyond = [n] * (n + 1)  # the next entry with a shorter common prefix
    for i in range(n - 1, -1, -1):
        j = i + 1
        while common[j] >= common[i]:
            j = beyond[j]
        beyond[i] = j
    first = 9 * 2 + 3 * 0 + 1  # before any character: no cell on the left, 0 on the diagonal, one insertion on the right
    for i in range(n - 1):
        word = "\0" + entries[i] + "\0\0"
        size = len(entries[i])
        rows = [first] + [9 * 1 + 1] * size  # along the word itself the diagonal stays 0
        if size:
            rows[size] = 9 * 1 + 2
        else:
            rows[0] = 9 * 2 + 2
        j = i + 1
        valid = size  # rows up to this depth belong to the entry met last
        while j < n:
            depth = common[j]
            if depth < valid:
                valid = depth
            entry = entries[j]
            end = len(entry)
            if end > size + 1:
                end = size + 1
            row = rows[valid]
            while valid < end:
                c = entry[valid]
                row = table[8 * row + (c == word[valid]) + 2 * (c == word[valid + 1]) + 4 * (c == word[valid + 2])]
                if valid + 1 > size - 1:  # cells beyond the word's end do not exist
                    row = row // 3 * 3 + 2 if valid + 1 == size else row // 9 * 9 + 8
                valid += 1
                if valid < len(rows):
                    rows[valid] = row
                else:
                    rows.append(row)
                if row == _DEAD:
                    break
            if row == _DEAD:
                j += 1
                while common[j] >= valid:
                    j = beyond[j]
                valid -= 1
                continue
            gap = size - len(entry)
            if -1 <= gap <= 1 and (row // 9, row // 3 % 3, row % 3)[1 + gap] == 1:
                yield i, j
            j += 1


def _lists(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, ...]]:
    """The bodies, words, counts, sizes and last marks of each list of two or more, from rows sorted by key and body."""
    held, key = None, None
    for batch in batches:
        keys = batch["key"].to_numpy()
        columns = [batch[c].tolist() for c in ("body", "word", "n", "size", "last")]
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for at, to in zip(cuts, cuts[1:]):
            if held and key == keys[at]:
                for had, more in zip(held, columns):
                    had.extend(more[at:to])
                continue
            if held and len(held[0]) > 1:
                yield tuple(held)
            held, key = [c[at:to] for c in columns], keys[at]
    if held and len(held[0]) > 1:
        yield tuple(held)


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each word of a list with near words there: their number and the most frequent one, of several the least."""
    out: list[tuple] = []
    for bodies, words, counts, sizes, lasts in _lists(batches):
        size, last = sizes[0], lasts[0]
        best: dict[int, list] = {}
        for i, j in one_edit_apart(bodies):
            a, b = bodies[i], bodies[j]
            if len(a) > size and len(b) > size:
                continue  # the list of a greater length has them
            if not last and len(a) != len(b) and b.startswith(a):
                continue  # the edit is at the border and belongs to the next part
            for x, y in ((i, j), (j, i)):
                found = (-counts[y], words[y])
                if x not in best:
                    best[x] = [1, found]
                else:
                    best[x][0] += 1
                    best[x][1] = min(best[x][1], found)
        out += [(words[x], number, low, word) for x, (number, (low, word)) in best.items()]
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["word", "n_near", "low", "form"])
            out = []
    yield pd.DataFrame(out, columns=["word", "n_near", "low", "form"])


def _parts(m: Column, low: Column, high: Column) -> Column:
    """A word as an entry of the list of words that share all but the characters [low, high) of the shorter one's m."""
    end = F.length("word") - (m - high)
    return F.struct(
        F.concat_ws("\x01", m, low, high, F.substring("word", F.lit(1), low), F.substring("word", end + 1, m - high)).alias("key"),
        F.substring("word", low + 1, end - low).alias("body"), (high - low).alias("size"), (high == m).alias("last"),
        m.alias("m"), low.alias("low"), high.alias("high"))


def _half(m: Column) -> Column:
    return F.floor(m / 2).cast("int")


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``form`` and ``form_n``: near words of each word that has any, and the most frequent of them."""
    length = F.length("word")
    lengths = F.filter(F.array(length, length - 1), lambda m: m >= LEAST)
    halves = F.flatten(F.transform(lengths, lambda m: F.array(_parts(m, F.lit(0), _half(m)), _parts(m, _half(m), m))))
    entries = words.select("word", "n", F.explode(halves).alias("e")).select("word", "n", "e.*")
    long = entries.groupBy("key").count().where(F.col("count") > LONG_LIST).select("key", F.lit(True).alias("long"))
    low, high, m = F.col("low"), F.col("high"), F.col("m")
    middle = low + F.floor((high - low) / 2).cast("int")
    dealt = F.when(F.col("long"), F.array(_parts(m, low, middle), _parts(m, middle, high))).otherwise(
        F.array(F.struct("key", "body", "size", "last", "m", "low", "high")))
    lists = (entries.join(long, "key", "left").select("word", "n", F.explode(dealt).alias("e"))
             .select("e.key", "e.body", "word", "n", "e.size", "e.last").repartition("key").sortWithinPartitions("key", "body"))
    ship(words.sparkSession)
    found = lists.mapInPandas(_near, "word string, n_near long, low long, form string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("low", "form")).alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.low")).alias("form_n")))


def runs(docs: DataFrame, least: int, text: str = "text") -> DataFrame:
    """``docs`` with one row per maximal run of letters in ``run``, at least so long; A-Z become a-z, nothing else changes."""
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = docs.withColumn("run", F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTER}{{{least},}}"), F.lit(0)))).drop(text)
    return found.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", capital, small)).otherwise(F.col("run")))


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``. ``words`` has distinct ``word`` and its count ``n``.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its most frequent near
    word (of several, the least in code-point order) if that is ``ratio`` times as frequent as the word, else null; its root is the end of the chain of
    forms, itself without one. Counts grow along a chain, so chains end.

    Words that are null or shorter than LEAST code points are returned as they are, with no near word and in nobody's count. An
    empty table gives no row. Other columns are ignored.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "variants-words")
    best = near_words(words.where(F.length("word") >= LEAST))
    large = F.col("form_n") >= ratio * F.col("n")
    forms = stored(words.join(best, "word", "left").select(
        "word", F.when(large, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(large, F.col("form_n")).alias("form_n")), "variants-forms")
    chains = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the reach
        on = chains.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        further = stored(chains.join(on, F.col("root") == F.col("_at"), "left")
                         .select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "variants-roots")
        chains = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return forms.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
