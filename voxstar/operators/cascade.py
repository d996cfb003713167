"""Deleting along the foreign keys of a schema: each table once, parents before children."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, functions as F

from voxstar.operators.keys import tag_exists
from voxstar.session import stored

GONE = "is_gone"


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to ``parent.parent_column``. ``unique``: a parent value stands in one row; otherwise a child row goes with
    the last parent row that holds its value."""

    child: str
    column: str
    parent: str
    parent_column: str
    unique: bool = True


def delete_order(keys: Iterable[ForeignKey], roots: Iterable[str]) -> list[str]:
    """The tables that a deletion in ``roots`` can reach, parents first. A cycle among them is an error that names it."""
    reached, open_ = set(), set(roots)
    while open_:
        reached |= open_
        open_ = {k.child for k in keys if k.parent in reached} - reached
    sorter = TopologicalSorter({t: [] for t in sorted(reached)})
    for key in keys:
        if key.parent in reached:
            sorter.add(key.child, key.parent)
    try:
        return list(sorter.static_order())
    except CycleError as cycle:
        raise ValueError(f"foreign keys form a cycle: {' -> '.join(reversed(cycle.args[1]))}") from cycle


def cascade(tables: dict[str, DataFrame], keys: list[ForeignKey], doomed: dict[str, Column]) -> dict[str, DataFrame]:
    """Every table a deletion reaches, its rows marked in ``is_gone``.

    ``doomed`` says by table which rows are deleted outright. A child row goes when a value it refers to is gone; null refers to
    nothing. Only values that a child refers to are passed on, written once in the shared folder, so a table's plan
    joins its own rows with its parents' lost values and never repeats what was done above them.
    """
    for name in {*doomed, *(k.child for k in keys), *(k.parent for k in keys)} & {*delete_order(keys, doomed)}:
        if name not in tables:
            raise ValueError(f"no table {name}")
    lost: dict[tuple[str, str], DataFrame] = {}
    out: dict[str, DataFrame] = {}
    for name in delete_order(keys, doomed):
        rows, marks = tables[name], [F.coalesce(doomed.get(name, F.lit(False)), F.lit(False))]
        parents = [k for k in keys if k.child == name and (k.parent, k.parent_column) in lost]
        for i, key in enumerate(parents):
            rows = tag_exists(rows, lost[key.parent, key.parent_column], key.column, key.parent_column, f"_gone{i}", unique=True)
            marks.append(F.col(f"_gone{i}"))
        out[name] = rows.withColumn(GONE, reduce(lambda a, b: a | b, marks)).select(*tables[name].columns, GONE)
        for column in {k.parent_column for k in keys if k.parent == name}:
            unique = all(k.unique for k in keys if k.parent == name and k.parent_column == column)
            held = out[name].select(column, GONE).dropna()
            if unique:
                values = held.filter(GONE).select(column).distinct()
            else:
                values = held.groupBy(column).agg(F.every(GONE).alias("_all")).filter("_all").select(column)
            lost[name, column] = stored(values, f"lost-{name}")
    return out


def remaining(marked: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What a cascade leaves of each table."""
    return {name: rows.filter(~F.col(GONE)).drop(GONE) for name, rows in marked.items()}


def deleted_counts(marked: dict[str, DataFrame]) -> DataFrame:
    """(table_name, deleted, kept) of a cascade."""
    one = lambda name, rows: rows.agg(F.count_if(GONE).alias("deleted"), F.count_if(~F.col(GONE)).alias("kept")).select(
        F.lit(name).alias("table_name"), "deleted", "kept")
    return reduce(lambda a, b: a.unionByName(b), [one(*x) for x in marked.items()])
