from voxstar import seeds
from voxstar.plans import views


def test_seed_tables(spark, rows):
    dims = seeds.seed_tables(spark)
    assert {n: df.count() for n, df in dims.items()} == {
        "regions": 4, "divisions": 9, "us_states": 50, "events": 5, "cat_name": 4, "category": 14, "sentiment_category": 3}
    assert rows(dims["divisions"])[0] == (1, "NEW ENGLAND", 1)
    assert rows(dims["us_states"].filter("state_id IN (1, 43)")) == [(1, "ALABAMA", "AL", 8), (43, "TEXAS", "TX", 9)]


def test_vw_cat_events(spark, rows):
    dims = seeds.seed_tables(spark)
    view = views.vw_cat_events(dims["category"], dims["cat_name"], dims["events"])
    assert rows(view, "category_id", "event_id", "categories", "event_name") == [
        (4000, 3000, "CIVIL RIGHTS, HELATH, WORLD", "EBOLA OUTBREAK"),
        (4003, 3001, "CIVIL RIGHTS, POLITICS, WORLD", "TRUMP ELECTION"),
        (4006, 3002, "CIVIL RIGHTS, POLITICS", "SANDY HOOK"),
        (4008, 3003, "CIVIL RIGHTS, HELATH, POLITICS", "SAME SEX MARRIAGE"),
        (4011, 3004, "CIVIL RIGHTS, POLITICS, WORLD", "TRUMP IMPEACHMENT")]


def test_us_cities_drop_zero_and_null(frame, rows):
    cities = frame("city string, state_id int", [("a", 0), ("b", 3), ("c", None)])
    assert rows(views.vw_us_cities(cities)) == [("b", 3)]


def test_literal_frame_quotes(spark):
    df = seeds.literal_frame(spark, "a string, b int", [("it's \\ \"x\"", None)])
    assert tuple(df.first()) == ("it's \\ \"x\"", None)
