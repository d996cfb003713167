"""Cities, author states and per-capita rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxstar.functions.location import is_state, normalise_location
from voxstar.operators.joins import dim_join, full_outer_keyed
from voxstar.operators.keys import dedupe_last

DISTRICT = "DC"


def build_cities(world: DataFrame, us_states: DataFrame, **skew) -> DataFrame:
    """World cities matched to US states by upper-cased province; unmatched cities get state 0.

    A state without a city comes out as a row without a city id, to be rejected
    by the key rule. The match is by name only, so provinces that share a state's
    name are corrected afterwards.
    """
    left = world.withColumn("state_province", F.upper(F.coalesce(F.col("admin_name"), F.lit("NAN")))).drop("admin_name")
    states = us_states.select(F.col("state").alias("state_province"), "state_id", F.lit(True).alias("_state_row"))
    joined = full_outer_keyed(left, states, ["state_province"], ["id"], **skew)
    return joined.select(
        "city", "city_ascii", "lat", "lng", "country", "iso2", "iso3",
        F.when(F.col("id").isNotNull(), F.col("state_province")).alias("state_province"),
        "capital", "population", F.col("id").alias("city_id"),
        F.coalesce("state_id", F.lit(0)).alias("state_id"))


def located_users(users: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Users whose location reads as a US state, with the state code."""
    coded = users.select("author_id", normalise_location(F.col("location")).alias("state_abbr"),
                         *[c for c in keep or []])
    return coded.filter(is_state(F.col("state_abbr")))


def author_location(users: DataFrame, us_states: DataFrame, order: list[str] | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """(author_id, state_id[, keep]); codes without a state row drop out.

    With ``order``, an author's last located row counts.
    """
    kept = list(dict.fromkeys([*(order or []), *(keep or [])]))
    located = located_users(users, kept)
    if order:
        located = dedupe_last(located, ["author_id"], order)
    return (dim_join(located.select("author_id", "state_abbr", *(keep or [])), us_states.select("state_abbr", "state_id"), "state_abbr").select("author_id", "state_id", *(keep or [])))


def users_per_state(users: DataFrame) -> DataFrame:
    """(state_abbr, users)."""
    return located_users(users).groupBy("state_abbr").agg(F.count("author_id").alias("users"))


def per_capita(population: DataFrame, state_users: DataFrame, keep_district: bool = True) -> DataFrame:
    """Users per million and per hundred thousand inhabitants, matched by state code."""
    pops = population if keep_district else population.filter(F.col("state") != DISTRICT)
    joined = pops.join(state_users.withColumnRenamed("state_abbr", "state"), "state")
    share = F.col("users").cast("double") / F.col("pop")
    return joined.select("state", "pop", "users", (share * 1e6).alias("per_mil"), (share * 1e5).alias("ratio"))


def geo_hierarchy(us_states: DataFrame, divisions: DataFrame, regions: DataFrame) -> DataFrame:
    """States with their division and region names."""
    return us_states.join(divisions, "div_id").join(regions, "reg_id")


def hierarchy_paths(nodes: DataFrame, separator: str = " / ") -> DataFrame:
    """(id, name, depth, root, path) of every node of a tree given as (id, parent_id, name), however deep it is.

    A node without a parent, or whose parent is not among the nodes, is a root at depth 0; ``path`` joins the names from its root down.
    Nodes on a cycle, and those that hang on one, are reached from no root: their depth, root and path are null. Each level is one join; the
    recursion ends with the level that finds nothing, so a cycle cannot keep it going. Trees deeper than
    ``spark.sql.cteRecursionLevelLimit`` fail with an error that names the setting.
    """
    known = nodes.select(F.col("id").alias("parent_id"), F.lit(True).alias("_known"))
    given = nodes.select("id", "parent_id", "name")
    marked = given.join(known, "parent_id", "left").select("id", "parent_id", "name", F.col("_known").isNull().alias("is_root"))
    return nodes.sparkSession.sql("""
        WITH RECURSIVE reached(id, depth, root, path) AS (
          SELECT id, 0, id, name FROM {marked} WHERE is_root
          UNION ALL
          SELECT n.id, r.depth + 1, r.root, concat(r.path, {separator}, n.name)
          FROM reached r JOIN {marked} n ON n.parent_id = r.id WHERE NOT n.is_root)
        SELECT n.id, n.name, r.depth, r.root, r.path FROM {marked} n LEFT JOIN reached r ON r.id = n.id""",
        marked=marked, separator=separator)
