"""Free-text profile locations to US state codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxstar.seeds import US_STATES

# ---- fixed values: rewrite order and patterns decide results -----------------
REWRITES = [
    r", USA$",
    r".*, (?=[A-Z]{2}$)",
    r".* (?=[A-Z]{2}$)",
    r".*, ",
    r".*,(?=[A-Z]{2}$)",
]
DISTRICT = ("DC", "DISTRICT OF COLUMBIA")  # a known code without a row in us_states
# ------------------------------------------------------------------------------


STATE_CODES = {name.title().replace(" Of ", " of "): code for code, name, *_ in [*US_STATES, DISTRICT]}


def map_values(value: Column, mapping: dict[str, str]) -> Column:
    """Whole-cell replacement; values outside the mapping stay as they are."""
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, value), value)


def normalise_location(location: Column) -> Column:
    """Strip country and city parts, then turn a full state name into its code."""
    out = location
    for pattern in REWRITES:
        out = F.regexp_replace(out, "(?d)" + pattern, "")
    return map_values(out, STATE_CODES)


def is_state(code: Column) -> Column:
    return code.isin(list(STATE_CODES.values()))
