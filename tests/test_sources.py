import json

import pytest
from pyspark.sql import functions as F

import payload_files as files
from voxstar.operators.quality import audit_totals
from voxstar.sources import files as store_files
from voxstar.sources import payloads as p
from voxstar.sources import tables
from voxstar.suite import captures


def test_lookup_files(spark, tmp_path, rows):
    (tmp_path / "lex.csv").write_text("term,emotion,association\nlove,joy,1\nlove,fear,0\n")
    assert rows(tables.read_lexicon(spark, str(tmp_path / "lex.csv"))) == [("love", "fear", 0), ("love", "joy", 1)]
    (tmp_path / "pop.csv").write_text("State,Pop\nTexas,100\nDistrict of Columbia,7\n")
    assert rows(tables.read_population(spark, str(tmp_path / "pop.csv"))) == [("DC", 7), ("TX", 100)]
    (tmp_path / "cities.csv").write_text(
        "city,city_ascii,lat,lng,country,iso2,iso3,admin_name,capital,population,id\nA,A,1.5,2,X,XX,XXX,Texas,,7,3\n")
    assert rows(tables.read_cities(spark, str(tmp_path / "cities.csv")), "city", "lat", "admin_name", "id") == [("A", 1.5, "Texas", 3)]


def test_emoji_dictionary(spark, tmp_path, rows):
    words = ["first"] + [f"w{i}" for i in range(20)]
    body = {"😀": ["grin", "joy", "joy", "happy"], "🙈": ["only"], "🚀": words, "🎉": ["x", None, "y"]}
    (tmp_path / "emoji.json").write_text(json.dumps(body, ensure_ascii=False, indent=1), encoding="utf-8")
    got = dict(rows(tables.read_emoji_dict(spark, str(tmp_path / "emoji.json"))))
    assert got == {"😀": ["joy", "happy"], "🙈": [], "🚀": words[1:], "🎉": ["y"]}
    cut = dict(rows(tables.read_emoji_dict(spark, str(tmp_path / "emoji.json"), limit=15)))
    assert cut == {**got, "🚀": words[1:16]}


def test_export(spark, tmp_path, rows):
    (tmp_path / "EVENTS.json").write_text('[{"EVENT_ID":1, "EVENT_NAME":"A"},\n {"EVENT_ID":2, "EVENT_NAME":"B"}]')
    assert rows(tables.read_export(spark, str(tmp_path / "EVENTS.json"), "events")) == [(1, "A"), (2, "B")]
    (tmp_path / "RUN_LOG.json").write_text(
        '[{"RUN_DATE":"2021-09-06 19:23:12", "LOAD_TYPE":"INITIAL", "COMMENT":"USERS: 593 LOADED, 2 SKIPPED", "FILEPATH":"x"}]')
    log = tables.read_export(spark, str(tmp_path / "RUN_LOG.json"), "run_log")
    assert str(log.first().run_date) == "2021-09-06 19:23:12"
    assert rows(audit_totals(log)) == [("INITIAL", "USERS", 593, 2, 1)]


def test_payload_scan_and_metadata(spark, tmp_path, rows):
    files.first_files(tmp_path)
    payloads = p.read_payloads(spark, str(tmp_path))
    good, bad = p.quarantine(payloads)
    assert good.count() == 3 and [r.filepath.rsplit("/", 1)[1] for r in bad.collect()] == ["cut_2014-03-23_2014-03-24.json"]
    meta = p.with_search_meta(good).select("event_tag", "event_id", "keyword", F.col("search_start").cast("string"),
                                           F.col("search_end").cast("string"))
    assert rows(meta) == sorted([
        ("ss_marriage", 3003, "same_sex_marriage", "2015-06-26", "2015-06-27"),
        ("ebola", 3000, "africa", "2014-03-23", "2014-03-24"), (None, None, None, None, None)], key=repr)


def test_flattening(spark, tmp_path, rows):
    files.first_files(tmp_path)
    good, _ = p.quarantine(p.read_payloads(spark, str(tmp_path)))
    one = good.filter(F.col("filepath").contains("same_sex"))
    assert rows(p.payload_texts(one), "pos", "tweet_id", "retweet_id", "retweet_text") == [
        (0, "1", "90", "happy love wins today"), (1, "2", "91", None), (2, "3", "92", "a quoted joy"),
        (3, "4", None, None), (4, "5", None, None), (5, None, None, "nobody refers to me")]
    assert rows(p.payload_facts(one), "author_id", F.col("created_at").cast("string"), "tweet_id")[0] == ("a", "2015-06-26", "1")
    assert rows(p.payload_errors(one), "value", "title") == [("91", "Not Found Error")]
    assert rows(p.payload_pages(one), "result_count") == [(5,)]
    users = p.payload_users(good)
    bare = users.filter("author_id = 'e'").first()
    assert bare.created_at is None and bare.followers_count is None and bare.verified is None
    assert users.filter("author_id = 'b'").first().location is None
    plain = p.payload_texts(good.filter(F.col("filepath").contains("africa")))
    assert rows(plain, "tweet_id", "retweet_id") == [("4", None), ("6", None)]


@pytest.mark.parametrize("local", [True, False])
def test_files_are_written_by_name(spark, frame, tmp_path, monkeypatch, local):
    system = store_files._system
    if not local:
        monkeypatch.setattr(store_files, "_system", lambda *a: (*system(*a)[:2], None))
    root = tmp_path / "capture"
    store_files.write_files(frame("folder string, name string, value string", [
        ("ebola", "a_2015-01-01_2015-01-02.json", "{\n}"), ("ebola", "b.json", "one"), ("ebola", "b.json", "one"), ("sandy", "a:b#c.json", "\u00e9"),
        (None, "lost.json", "x"), ("ebola", None, "x")]), str(root))
    found = {str(f.relative_to(root)): f.read_bytes() for f in root.rglob("*") if f.is_file() and not f.name.endswith(".crc")}
    assert found == {"ebola/a_2015-01-01_2015-01-02.json": b"{\n}\n", "ebola/b.json": b"one\none\n", "sandy/a%3Ab%23c.json": "\u00e9\n".encode()}
    assert store_files.matching(spark, f"{root}/*/*.json") == 3


def test_capture_files_take_no_step_of_the_driver_each(spark, tmp_path, monkeypatch):
    docs = [(i, "some text", "en", f"src{i % 5}", 9) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(store_files, "rename", None)
    assert [p.rsplit("/", 1)[1] for p in store_files.listed(spark, f"{captures._json_files(spark, str(tmp_path))}/*")] == ["ebola"]


def test_tasks_list_and_read_the_files_that_spark_would(spark, tmp_path):
    root = tmp_path / "cap ture"
    for name in ("ebola/a.json", "ebola/_h.json", "ebola/_h=1.json", "ebola/.d.json", "ebola/t.txt", "ebola/sub/n.json", "a b%\u00e9#/q%20 \u20ac\u2003.json",
                 "_hid/z.json", ".dot/z.json", "x.json/in.json", "top.json"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b'{"data": 1}\n\xff\r\n' + name.encode())
    (root / "ebola" / "empty.json").touch()
    (root / "ebola" / "link.json").symlink_to(root / "ebola" / "a.json")
    (root / "ebola" / "lost.json").symlink_to(root / "nowhere")
    found = store_files.list_files(spark, str(root), ".json")
    shown = lambda df: sorted(map(tuple, df.select("filepath", F.hex("value")).collect()))
    assert shown(store_files.read_files(found)) == shown(p.scan_payloads(spark, str(root))) and found.count() == 9
    assert store_files.list_files(spark, str(tmp_path / "none"), ".json").count() == 0
    assert not store_files.tasks_reach(spark, f"{tmp_path}/*")


def test_a_listing_of_a_large_folder_is_whole(spark, tmp_path):
    for i in range(n := 2 * store_files._ROWS + 3):
        (tmp_path / f"{i}.json").touch()
    assert store_files.list_files(spark, str(tmp_path), ".json").select("path").distinct().count() == n
    assert store_files.matching(spark, f"{tmp_path}/*.json") == n


def test_matches_are_counted_without_a_list_in_the_jvm(spark, tmp_path, monkeypatch):
    for name in ("a/x.json", "a/.y.json", "a/t.txt", "b/c/x.json", "top.json", "a+b/(x).json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).touch()
    patterns = ["*", "*/*.json", "?/*", "a/x.json", "a+b/*", "*/*/*", "none/*", "a/x.json/*", "{a,b}/*", "[ab]/*"]
    system = store_files._system
    with monkeypatch.context() as m:
        m.setattr(store_files, "_system", lambda *a: (*system(*a)[:2], None))
        wanted = [store_files.matching(spark, f"{tmp_path}/{x}") for x in patterns]
    assert [store_files.matching(spark, f"{tmp_path}/{x}") for x in patterns] == wanted and wanted[:2] == [4, 3]
    monkeypatch.setattr(store_files, "_system", lambda *a: (None, None, system(*a)[2]))
    assert store_files.matching(spark, f"{tmp_path}/*/*.json") == 3
