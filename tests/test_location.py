import pytest
from pyspark.sql import functions as F

from voxstar.functions import location
from voxstar.plans import geo
from voxstar import seeds


@pytest.mark.parametrize("raw,want", [
    ("Austin, TX", "TX"), ("Texas, USA", "TX"), ("Miami FL", "FL"), ("New York, NY, USA", "NY"), ("Boston,MA", "MA"),
    ("London, UK", "UK"), ("Georgia", "GA"), ("Washington, DC", "DC"), ("District of Columbia", "DC"), ("Paris", "Paris"),
    ("West Virginia", "WV"), ("", ""), ("line\nAustin, TX", "line\nTX"), (None, None)])
def test_normalise(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "l string")
    assert df.select(location.normalise_location(F.col("l"))).first()[0] == want


def test_codes():
    assert len(location.STATE_CODES) == 51
    assert location.STATE_CODES["District of Columbia"] == "DC"


def test_author_location_and_rates(spark, frame, rows):
    users = frame("author_id string, location string, n int", [
        ("1", "Austin, TX", 1), ("1", "Miami FL", 2), ("2", "Texas", 1), ("3", "Washington, DC", 1), ("4", "Oslo", 1),
        ("2", "Oslo", 2)])
    states = seeds.seed_tables(spark)["us_states"]
    assert rows(geo.author_location(users, states, ["n"])) == [("1", 9), ("2", 43)]
    counts = geo.users_per_state(users)
    assert rows(counts) == [("DC", 1), ("FL", 1), ("TX", 2)]
    pops = frame("state string, pop bigint", [("TX", 1000000), ("DC", 500000), ("UT", 10)])
    rates = {r.state: (r.users, round(r.per_mil, 9), round(r.ratio, 9)) for r in geo.per_capita(pops, counts).collect()}
    assert rates == {"DC": (1, 2.0, 0.2), "TX": (2, 2.0, 0.2)}
    assert rows(geo.per_capita(pops, counts, keep_district=False), "state") == [("TX",)]


def test_build_cities(frame, rows):
    ddl = ("city string, city_ascii string, lat double, lng double, country string, iso2 string, iso3 string, "
           "admin_name string, capital string, population double, id int")
    world = frame(ddl, [("A", "A", 1.0, 2.0, "US", "US", "USA", "Texas", None, 5.0, 1),
                        ("B", "B", 1.0, 2.0, "FR", "FR", "FRA", "Somewhere", None, 5.0, 2),
                        ("C", "C", 1.0, 2.0, "FR", "FR", "FRA", None, None, None, 3)])
    states = frame("state_id int, state string, state_abbr string, div_id int", [(43, "TEXAS", "TX", 9), (44, "UTAH", "UT", 5)])
    built = geo.build_cities(world, states)
    assert rows(built, "city", "state_province", "city_id", "state_id") == sorted([
        ("A", "TEXAS", 1, 43), ("B", "SOMEWHERE", 2, 0), ("C", "NAN", 3, 0), (None, None, None, 44)], key=repr)


def test_geo_hierarchy(spark, rows):
    dims = seeds.seed_tables(spark)
    tree = geo.geo_hierarchy(dims["us_states"], dims["divisions"], dims["regions"])
    found = {r.state_abbr: (r.division, r.region) for r in tree.collect()}
    assert len(found) == 50
    assert found["TX"] == ("WEST SOUTH CENTRAL", "SOUTH") and found["ME"] == ("NEW ENGLAND", "NORTHEAST")
