"""Mend the structure of conversations with the fewest, cheapest edits, by block tables in the manner of the Four Russians.

A conversation's rows are reduced in Spark to one symbol each. An edit script keeps, re-labels or deletes each row and may insert
empty turns, so that the roles' initials read ``(s?(ua)+)?``. The cost to finish from the four places in that pattern is a vector of four
numbers. Differences inside a vector are bounded, so only a few dozen normalised vectors exist, and the step over every block of
BLOCK symbols from every one of them is tabulated once. Costs run over a conversation from its end, a look-up per block; the trace goes
forward and expands one block at a time, taking the ASCII-least edit that stays on a cheapest script.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.shipping import ship

BLOCK = 4
#: Costs of the edits.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What a row is to the pattern: x must go; else its role's initial (o: any other), in capitals if its text is cut off.
SYMBOLS = "xsuaoSUAO"
#: Places in the pattern: nothing yet, after s, after u, after a; and where a user's or assistant's turn leads.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ONWARD = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_NOT_SPACE = r"[^\x20\x09-\x0D]"


def _kept(symbol: str, place: int) -> int | None:
    """The place that keeping a row leads to, if it may be kept."""
    initial = symbol.lower()
    if initial == "s":
        return _SYSTEM if place == _START else None
    onward = _ONWARD[place]
    return onward if initial == ("u" if onward == _USER else "a") else None


def _options(symbol: str, place: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next place) of the edits that use up a row."""
    yield "D", DELETE, place
    if symbol == "x":
        return
    extra = TRUNCATED if symbol.isupper() else 0
    kept = _kept(symbol, place)
    if kept is not None:
        yield "K", extra, kept
    yield "R", RELABEL + extra, _ONWARD[place]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Least costs when turns may be inserted first; two rounds, since u and a lead to each other at a price."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_ONWARD[p]]) for p, c in enumerate(costs)]
    return tuple(costs)


@dataclass
class Tables:
    """``vectors`` are normalised costs by place. ``step[v, symbol]`` and ``block[v, code]`` lead to the vector before a symbol or block
    and ``rise`` and ``block_rise`` to what was taken off. ``moves[v, symbol, place]`` has the cheapest, then ASCII-least, edits up to
    and with the symbol, and where they lead; ``ends[place]`` those after the last row."""

    vectors: list[tuple[int, ...]]
    step: np.ndarray
    rise: np.ndarray
    block: np.ndarray
    block_rise: np.ndarray
    moves: dict[tuple[int, int, int], tuple[str, int]]
    ends: list[str]


@lru_cache(maxsize=1)
def tables() -> Tables:
    big = 1 << 20
    last = _with_inserts([0, big, big, 0])
    vectors, number = [last], {last: 0}
    steps, rises, moves = [], [], {}
    for v in vectors:  # grows while it runs
        to, up = [], []
        for k, symbol in enumerate(SYMBOLS):
            costs = _with_inserts([min(c + v[p] for _, c, p in _options(symbol, place)) for place in range(4)])
            low = min(costs)
            plain = tuple(c - low for c in costs)
            if plain not in number:
                number[plain] = len(vectors)
                vectors.append(plain)
            to.append(number[plain])
            up.append(low)
            for start in range(4):
                edits, place = "", start
                while True:
                    least = min([(e, p) for e, c, p in _options(symbol, place) if c + v[p] == costs[place]]
                                + [("I", _ONWARD[place])] * (INSERT + costs[_ONWARD[place]] == costs[place]))
                    edits, place = edits + least[0], least[1]
                    if least[0] != "I":
                        break
                moves[number[v], k, start] = edits, place
        steps.append(to)
        rises.append(up)
    step, rise = np.array(steps), np.array(rises)
    block, block_rise = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), np.int64)
    for i in range(BLOCK):  # a code's first symbol is its highest digit and is met last
        block_rise = (block_rise[:, None, :] + rise[block].transpose(0, 2, 1)).reshape(len(vectors), -1)
        block = step[block].transpose(0, 2, 1).reshape(len(vectors), -1)
    ends = ["I" * (last[p] // INSERT) for p in range(4)]
    return Tables(vectors, step, rise, block, block_rise, moves, ends)


_DIGIT = np.zeros(128, np.int64)
_DIGIT[[ord(c) for c in SYMBOLS]] = range(len(SYMBOLS))
_POWERS = len(SYMBOLS) ** np.arange(BLOCK)[::-1]


def cheapest(symbols: str) -> tuple[int, str]:
    """Cost and edits of the cheapest script, the ASCII-least of several."""
    t = tables()
    digits = _DIGIT[np.frombuffer(symbols.encode(), np.uint8)]
    odd = len(digits) % BLOCK
    codes = (digits[odd:].reshape(-1, BLOCK) @ _POWERS).tolist()
    at, cost, after = 0, 0, []
    for code in reversed(codes):
        after.append(at)
        cost += int(t.block_rise[at, code])
        at = int(t.block[at, code])
    after.reverse()

    def vectors(part, right):
        """The vector after each symbol of a part."""
        out = [right]
        for k in part[:0:-1]:
            out.append(int(t.step[out[-1], k]))
        return out[::-1]

    place, edits = _START, []
    first = digits[:odd].tolist()
    if first:
        path = vectors(first, at)
        for k, v in zip(first[::-1], path[::-1]):
            cost += int(t.rise[v, k])
            at = int(t.step[v, k])
    cost += t.vectors[at][_START]
    parts = ([(first, path)] if first else []) + [(p, None) for p in digits[odd:].reshape(-1, BLOCK).tolist()]
    for i, (part, path) in enumerate(parts):
        path = path or vectors(part, after[i - bool(first)])
        for k, v in zip(part, path):
            done, place = t.moves[v, k, place]
            edits.append(done)
    return cost, "".join(edits) + t.ends[place]


def scripted(symbols: str) -> tuple[int, str, list[int], list[str | None]]:
    """Cost and edits, and each resulting turn's row (-1: inserted) and new role (None: the row's own)."""
    cost, edits = cheapest(symbols)
    rows, roles, row, place = [], [], 0, _START
    for edit in edits:
        if edit != "D":
            place = _SYSTEM if edit == "K" and symbols[row] in "sS" else _ONWARD[place]
            rows.append(-1 if edit == "I" else row)
            roles.append(None if edit == "K" else _ROLE[place])
        row += edit != "I"
    return cost, edits, rows, roles


def _script(symbols: Column) -> Column:
    @F.pandas_udf("cost long, audit string, rows array<int>, roles array<string>")
    def of(given: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scripted(s) for s in given], columns=["cost", "audit", "rows", "roles"])

    return of(symbols)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: str | None = None) -> DataFrame:
    """One row per conversation: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired``.

    ``repaired`` is an array of (role, text). Rows go by ``turn``, nulls first; rows at one place go by role, then text. Of a row's
    faults the first counts: blank (nothing but white space), duplicate (role and text stood earlier), truncated (the last character
    that is not white space is none of ``. ! ?``). ``gaps`` are the missing numbers between the least and greatest turn, ``illegal``
    neighbouring roles whose initials are not su, ua or au. ``audit`` has one letter per edit: Keep, Rerole, Delete, Insert.

    Null roles and texts count as one space. Rows without a conversation form one of their own. Repeated rows are duplicates. Rows
    where ``present`` is false or null are absent, but their conversation is returned, with zeros and no edits if nothing else is
    in it. An empty table gives no row. Other columns are ignored.

    A conversation's rows meet in one task, since each one's place counts; only its symbols, a byte a row, go to Python. It must fit
    one row (2 GB) as its repaired form is one value.
    """
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    given = rows.select(F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                        F.coalesce(text, F.lit(" ")).alias("text"), here.alias("here"))
    same = Window.partitionBy("_conv", "here", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = (F.when(~F.col("text").rlike(_NOT_SPACE), "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter"))
    marked = (given.repartition("_conv").withColumn("nth", F.row_number().over(same))
              .withColumn("fault", fault).withColumn("letter", letter).withColumn("symbol", symbol))
    each = F.when(F.col("here"), F.struct("turn", "role", "text", "nth", "symbol"))
    count = lambda kind: F.count(F.when(F.col("here") & (F.col("fault") == kind), 1)).alias(kind)
    whole = marked.groupBy("_conv").agg(F.sort_array(F.collect_list(each)).alias("turns"), count("blank"), count("duplicate"), count("truncated"))
    ship(rows.sparkSession)
    n = F.size("turns")
    numbers = F.filter(F.transform("turns", lambda t: t["turn"]), lambda t: t.isNotNull())
    span = F.array_max(numbers) - F.array_min(numbers) + 1 - F.size(F.array_distinct(numbers))
    head = lambda t: F.substring(t["role"], 1, 1)
    pairs = F.zip_with(F.slice("turns", F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice("turns", F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat(head(a), head(b)))
    illegal = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    script = whole.withColumn("script", _script(F.array_join(F.transform("turns", lambda t: t["symbol"]), "")))
    repaired = F.zip_with("script.rows", "script.roles", lambda i, r: F.struct(
        F.coalesce(r, F.get(F.col("turns"), i)["role"]).alias("role"), F.coalesce(F.get(F.col("turns"), i)["text"], F.lit("")).alias("text")))
    return script.select(F.col("_conv").alias(conv), F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                         illegal.cast("long").alias("illegal"), "script.cost", "script.audit", repaired.alias("repaired"))
