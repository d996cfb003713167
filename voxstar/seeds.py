"""Seed dimensions and the emotion polarity, as literal relations.

All frames here are built from the constants below, so their size is fixed and
joins may broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxstar.schemas import table_schema

# ---- fixed values: they must equal the published seed data -------------------

REGIONS = ["NORTHEAST", "MIDWEST", "WEST", "SOUTH"]

DIVISIONS = [
    ("NEW ENGLAND", "NORTHEAST"),
    ("MIDDLE ATLANTIC", "NORTHEAST"),
    ("EAST NORTH CENTRAL", "MIDWEST"),
    ("WEST NORTH CENTRAL", "MIDWEST"),
    ("MOUNTAIN", "WEST"),
    ("PACIFIC", "WEST"),
    ("SOUTH ATLANTIC", "SOUTH"),
    ("EAST SOUTH CENTRAL", "SOUTH"),
    ("WEST SOUTH CENTRAL", "SOUTH"),
]

US_STATES = [
    ("AL", "ALABAMA", "EAST SOUTH CENTRAL"),
    ("AK", "ALASKA", "PACIFIC"),
    ("AZ", "ARIZONA", "MOUNTAIN"),
    ("AR", "ARKANSAS", "WEST SOUTH CENTRAL"),
    ("CA", "CALIFORNIA", "PACIFIC"),
    ("CO", "COLORADO", "MOUNTAIN"),
    ("CT", "CONNECTICUT", "NEW ENGLAND"),
    ("DE", "DELAWARE", "SOUTH ATLANTIC"),
    ("FL", "FLORIDA", "SOUTH ATLANTIC"),
    ("GA", "GEORGIA", "SOUTH ATLANTIC"),
    ("HI", "HAWAII", "PACIFIC"),
    ("ID", "IDAHO", "MOUNTAIN"),
    ("IL", "ILLINOIS", "EAST NORTH CENTRAL"),
    ("IN", "INDIANA", "EAST NORTH CENTRAL"),
    ("IA", "IOWA", "WEST NORTH CENTRAL"),
    ("KS", "KANSAS", "WEST NORTH CENTRAL"),
    ("KY", "KENTUCKY", "EAST SOUTH CENTRAL"),
    ("LA", "LOUISIANA", "WEST SOUTH CENTRAL"),
    ("ME", "MAINE", "NEW ENGLAND"),
    ("MD", "MARYLAND", "SOUTH ATLANTIC"),
    ("MA", "MASSACHUSETTS", "NEW ENGLAND"),
    ("MI", "MICHIGAN", "EAST NORTH CENTRAL"),
    ("MN", "MINNESOTA", "WEST NORTH CENTRAL"),
    ("MS", "MISSISSIPPI", "EAST SOUTH CENTRAL"),
    ("MO", "MISSOURI", "WEST NORTH CENTRAL"),
    ("MT", "MONTANA", "MOUNTAIN"),
    ("NE", "NEBRASKA", "WEST NORTH CENTRAL"),
    ("NV", "NEVADA", "MOUNTAIN"),
    ("NH", "NEW HAMPSHIRE", "NEW ENGLAND"),
    ("NJ", "NEW JERSEY", "MIDDLE ATLANTIC"),
    ("NM", "NEW MEXICO", "MOUNTAIN"),
    ("NY", "NEW YORK", "MIDDLE ATLANTIC"),
    ("NC", "NORTH CAROLINA", "SOUTH ATLANTIC"),
    ("ND", "NORTH DAKOTA", "WEST NORTH CENTRAL"),
    ("OH", "OHIO", "EAST NORTH CENTRAL"),
    ("OK", "OKLAHOMA", "WEST SOUTH CENTRAL"),
    ("OR", "OREGON", "PACIFIC"),
    ("PA", "PENNSYLVANIA", "MIDDLE ATLANTIC"),
    ("RI", "RHODE ISLAND", "NEW ENGLAND"),
    ("SC", "SOUTH CAROLINA", "SOUTH ATLANTIC"),
    ("SD", "SOUTH DAKOTA", "WEST NORTH CENTRAL"),
    ("TN", "TENNESSEE", "EAST SOUTH CENTRAL"),
    ("TX", "TEXAS", "WEST SOUTH CENTRAL"),
    ("UT", "UTAH", "MOUNTAIN"),
    ("VT", "VERMONT", "NEW ENGLAND"),
    ("VA", "VIRGINIA", "SOUTH ATLANTIC"),
    ("WA", "WASHINGTON", "PACIFIC"),
    ("WV", "WEST VIRGINIA", "SOUTH ATLANTIC"),
    ("WI", "WISCONSIN", "EAST NORTH CENTRAL"),
    ("WY", "WYOMING", "MOUNTAIN"),
]

EVENTS = ["EBOLA OUTBREAK", "TRUMP ELECTION", "SANDY HOOK", "SAME SEX MARRIAGE", "TRUMP IMPEACHMENT"]
EVENT_SEED = 3000

# folder tag of a captured event -> event id
EVENT_TAGS = {
    "ebola": 3000,
    "trump_election": 3001,
    "sandy_hook": 3002,
    "ss_marriage": 3003,
    "trump_impeachment": 3004,
}

CAT_NAMES = ["CIVIL RIGHTS", "HELATH", "POLITICS", "WORLD"]  # spelling as stored
CAT_NAME_SEED = 7000

CATEGORY = [
    (3000, 7000), (3000, 7001), (3000, 7003),
    (3001, 7000), (3001, 7002), (3001, 7003),
    (3002, 7000), (3002, 7002),
    (3003, 7000), (3003, 7001), (3003, 7002),
    (3004, 7000), (3004, 7002), (3004, 7003),
]
CATEGORY_SEED = 4000

SEARCH_DATE_SEED = 1000
SEARCH_SEED = 2000
DATA_SEED = 5000
WORD_SEED = 8000

POSITIVE, NEGATIVE, NEUTRAL = 1, 0, 9
SENTIMENT_CATEGORY = [(POSITIVE, "POSITIVE"), (NEGATIVE, "NEGATIVE"), (NEUTRAL, "NEUTRAL")]

POSITIVE_EMOTIONS = ["anticipation", "joy", "surprise", "trust", "positive"]
NEGATIVE_EMOTIONS = ["anger", "disgust", "fear", "sadness", "negative"]
EMOTIONS = sorted(POSITIVE_EMOTIONS + NEGATIVE_EMOTIONS)
POSITIVE_MARK, NEGATIVE_MARK = 333, 666

MIN_SUPPORT = 0.005
# per-event thresholds of the three-emotion itemsets
EVENT_SUPPORT = {
    "TRUMP IMPEACHMENT": 0.37,
    "TRUMP ELECTION": 0.37,
    "EBOLA OUTBREAK": 0.25,
    "SANDY HOOK": 0.13,
    "SAME SEX MARRIAGE": 0.10,
}

# the five rows whose province name matched a US state by accident
CITY_CORRECTIONS = [1100440040, 1100553391, 1100932516, 1100946651, 1430540258]

# ------------------------------------------------------------------------------


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literal_frame(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """A relation made of constants, planned as a local relation in the JVM."""
    fields = [part.strip().split() for part in ddl.split(",")]
    names = [name for name, _ in fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


def _seed(spark, table, rows):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(table))
    return literal_frame(spark, ddl, rows)


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All seeded dimensions by table name; foreign keys are looked up by name."""
    names = literal_frame(spark, "div_id int, division string, region string",
                          [(i, d, r) for i, (d, r) in enumerate(DIVISIONS, 1)])
    regions = _seed(spark, "regions", list(enumerate(REGIONS, 1)))
    divisions = names.join(regions, "region").select("div_id", "division", "reg_id")
    state_names = literal_frame(spark, "state_id int, state_abbr string, state string, division string",
                                [(i, a, s, d) for i, (a, s, d) in enumerate(US_STATES, 1)])
    us_states = (state_names.join(divisions, "division")
                 .select("state_id", "state", "state_abbr", "div_id"))
    return {
        "regions": regions,
        "divisions": divisions,
        "us_states": us_states,
        "events": event_dim(spark).select("event_id", "event_name"),
        "cat_name": _seed(spark, "cat_name", list(enumerate(CAT_NAMES, CAT_NAME_SEED))),
        "category": _seed(spark, "category",
                          [(i, e, n) for i, (e, n) in enumerate(CATEGORY, CATEGORY_SEED)]),
        "sentiment_category": _seed(spark, "sentiment_category", SENTIMENT_CATEGORY),
    }


def event_dim(spark: SparkSession) -> DataFrame:
    """(event_tag, event_id, event_name) for the captured events."""
    rows = [(tag, event_id, EVENTS[event_id - EVENT_SEED]) for tag, event_id in EVENT_TAGS.items()]
    return literal_frame(spark, "event_tag string, event_id int, event_name string", rows)


def emotion_polarity(spark: SparkSession) -> DataFrame:
    """(emotion, polarity +1/-1, sent_id 333/666)."""
    rows = ([(e, 1, POSITIVE_MARK) for e in POSITIVE_EMOTIONS]
            + [(e, -1, NEGATIVE_MARK) for e in NEGATIVE_EMOTIONS])
    return literal_frame(spark, "emotion string, polarity int, sent_id int", rows)
