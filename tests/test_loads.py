import json
import os
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import payload_files as files
from voxstar.operators.quality import reconcile
from voxstar.plans import loads
from voxstar.plans.catalog import register
from voxstar.plans.events import sentiment_by_category
from voxstar.plans.loads import initial_load, secondary_load, seed_load
from voxstar.sources.payloads import scan_payloads, stream_payloads
from voxstar.sources.tables import Store, load
from voxstar.streaming import ingest
from voxstar.streaming.ingest import ingest_files, load_batch
from voxstar.suite import captures


@pytest.fixture
def capture(tmp_path):
    root = tmp_path / "capture"
    files.first_files(root)
    return root


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


REFUSED = [("cut_2014-03-23_2014-03-24.json", "FILE REJECTED: unreadable"), ("notes.json", "FILE REJECTED: file name")]


def comments(log):
    return sorted((r.filepath.rsplit("/", 1)[1], r.comment) for r in log.collect())


def test_initial_load(spark, capture, store, rows):
    log = initial_load(store, scan_payloads(spark, str(capture)), "one")
    africa, marriage = "africa_2014-03-23_2014-03-24.json", "same_sex_marriage_2015-06-26_2015-06-27.json"
    assert comments(log) == sorted([
        (africa, "USERS: 2 LOADED, 0 SKIPPED"), (marriage, "USERS: 2 LOADED, 1 SKIPPED"),
        (africa, "TEXT: 2 LOADED, 0 SKIPPED"), (marriage, "TEXT: 4 LOADED, 2 SKIPPED"),
        (africa, "TWEET_DATA: 2 LOADED, 0 SKIPPED"), (marriage, "TWEET_DATA: 4 LOADED, 1 SKIPPED"),
        (africa, "SEARCH_DATES: '2014-03-23','2014-03-24'"), (marriage, "SEARCH_DATES: '2015-06-26','2015-06-27'"),
        (africa, "SEARCHES: 'africa', '1000', '3000'"), (marriage, "SEARCHES: 'same_sex_marriage', '1001', '3003'"),
        *REFUSED])
    assert rows(store.read("users"), "author_id") == [("a",), ("b",), ("c",), ("e",)]
    assert rows(store.read("tweet_text"), "tweet_id") == [(str(i),) for i in range(1, 7)]
    assert rows(store.read("search_dates"), "search_date_id", F.col("search_start").cast("string")) == [
        (1000, "2014-03-23"), (1001, "2015-06-26")]
    assert rows(store.read("searches")) == [(2000, "africa", 1000, 3000), (2001, "same_sex_marriage", 1001, 3003)]
    # users and texts of all files come before the first fact, so tweet 4 of africa finds its author
    facts = rows(store.read("tweet_data"), "data_id", "author_id", "tweet_id", "search_id")
    assert [f[0] for f in facts] == list(range(5000, 5000 + len(facts)))
    assert rows(store.rejects("tweet_text"), "tweet_id", "reject_reason") == sorted(
        [(None, "missing key"), ("4", "duplicate key")], key=repr)
    assert rows(store.rejects("payload"), "reject_reason") == [("file name",), ("unreadable",)]


def test_reload_adds_nothing(spark, capture, store):
    raw = scan_payloads(spark, str(capture))
    initial_load(store, raw, "one")
    before = {t: store.read(t).count() for t in ("users", "tweet_text", "tweet_data", "searches", "search_dates")}
    assert initial_load(store, raw, "one").count() == 0  # same key: skipped
    log = initial_load(store, raw, "two")                 # new key: every row is known
    said = [r.comment for r in log.collect()]
    assert all(" 0 LOADED" in c for c in said if "LOADED" in c) and not any(c.startswith("SEARCH_DATES") for c in said)
    assert {t: store.read(t).count() for t in before} == before


def test_unfinished_load_is_invisible(spark, capture, store, monkeypatch):
    raw = scan_payloads(spark, str(capture))
    monkeypatch.setattr(Store, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        initial_load(store, raw, "one")
    monkeypatch.undo()
    assert store.read("users").count() == 0 and store.read("run_log").count() == 0
    initial_load(store, raw, "one")
    assert store.read("users").count() == 4
    assert store.read("tweet_data").agg(F.min("data_id")).first()[0] == 5000


def test_quoting_rule(spark, capture, store, rows):
    initial_load(store, scan_payloads(spark, str(capture)), quoting=True)
    assert ("b", "both quote kinds") in rows(store.rejects("users"), "author_id", "reject_reason")
    assert ("2", "unknown author") in rows(store.rejects("tweet_data"), "tweet_id", "reject_reason")


def test_secondary_load(spark, capture, store, frame, rows):
    initial_load(store, scan_payloads(spark, str(capture)), "one")
    lexicon = frame("term string, emotion string, association int", files.LEXICON)
    log = secondary_load(store, lexicon, "derive")
    words = rows(store.read("word_association"), "tweet_id", "term", "emotion")
    assert ("1", "love", "joy") in words and words.count(("4", "hope", "anticipation")) == 2
    votes = dict(rows(store.read("sentiment_category_assignment")))
    assert votes["1"] == 1 and votes["4"] == 9
    assert rows(store.read("author_location")) == [("a", 43), ("c", 43)]
    ids = [r[0] for r in rows(store.read("word_association"), "wa_id")]
    assert ids == list(range(8000, 8000 + len(ids)))
    assert {r.comment.split(":")[0] for r in log.collect()} <= {"WORD_ASSOCIATION", "TWEET_SENT_CAT", "AUTHOR_LOCATION"}
    assert ("5", "unknown tweet") not in rows(store.rejects("word_association"), "tweet_id", "reject_reason")  # no lexicon word
    again = secondary_load(store, lexicon, "derive again")
    assert again.count() == 0
    assert len(words) == store.read("word_association").count()
    assert dict(rows(store.read("sentiment_category_assignment"))) == votes


def test_secondary_load_catches_up(spark, store, frame, tmp_path, rows):
    """A text whose author arrives later is derived with its first fact; earlier rows stay as they are."""
    lexicon = frame("term string, emotion string, association int", files.LEXICON)
    one, two = tmp_path / "one", tmp_path / "two"
    files.write(one, "ebola", "who_2014-03-23_2014-03-24.json", files.payload(
        [files.tweet("1", "a", "love"), files.tweet("2", "x", "fear fear")], [files.user("a"), files.user("idle")]))
    files.write(two, "ebola", "cdc_2014-03-23_2014-03-24.json", files.payload(
        [files.tweet("2", "x", "fear fear"), files.tweet("3", "idle", "hope"), files.tweet("1", "a", "love")], [files.user("x")]))
    initial_load(store, scan_payloads(spark, str(one)))
    secondary_load(store, lexicon)
    assert rows(store.read("sentiment_category_assignment")) == [("1", 1)]
    assert rows(store.read("author_location"), "author_id") == [("a",)]
    assert rows(store.rejects("word_association"), "tweet_id", "reject_reason") == [("2", "unknown tweet")] * 4
    assert rows(store.rejects("author_location"), "author_id") == [("idle",)]
    initial_load(store, scan_payloads(spark, str(two)))
    secondary_load(store, lexicon)
    assert rows(store.read("sentiment_category_assignment")) == [("1", 1), ("2", 0), ("3", 1)]
    assert rows(store.read("author_location"), "author_id") == [("a",), ("idle",), ("x",)]
    assert rows(store.read("word_association"), "wa_id") == [(8000 + i,) for i in range(7)]


def test_log_reconciles_with_tables(spark, capture, store):
    initial_load(store, scan_payloads(spark, str(capture)), "one")
    names = {"USERS": "users", "TEXT": "tweet_text", "TWEET_DATA": "tweet_data"}
    report = reconcile(store.read("run_log"), {label: load(spark, store.root, t) for label, t in names.items()})
    assert report.count() == 3 and report.filter("difference <> 0").count() == 0


def test_stream_equals_batch(spark, capture, store, tmp_path, rows):
    initial_load(store, scan_payloads(spark, str(capture)), "one")
    streamed = Store(spark, str(tmp_path / "streamed"))
    checkpoint = str(tmp_path / "checkpoint")
    ingest_files(spark, str(capture), streamed, checkpoint)
    for table in ("users", "tweet_text", "tweet_data", "searches", "search_dates"):
        assert rows(streamed.read(table)) == rows(store.read(table)), table

    files.write(capture, "ebola", "who_2014-03-23_2014-03-24.json", files.payload(
        [files.tweet("4", "c", "hope and hope and fear"), files.tweet("70", "n", "new one")], [files.user("n"), files.user("a")]))
    ingest_files(spark, str(capture), streamed, checkpoint)
    assert streamed.commits().count() == 2
    assert streamed.read("users").count() == 5
    assert rows(streamed.read("searches").filter("keyword = 'who'")) == [(2002, "who", 1000, 3000)]
    assert streamed.read("tweet_data").filter("tweet_id = '4'").count() == 3  # one capture per search
    ingest_files(spark, str(capture), streamed, checkpoint)
    assert streamed.commits().count() == 2


def numbered(root, *numbers):
    for i in numbers:
        files.write(root, "ebola" if i % 2 else "ss_marriage", f"w_2014-03-23_2014-03-{i:02d}.json", {})
        os.utime(next(Path(root).glob(f"*/*-{i:02d}.json")), (1_400_000_000 + i,) * 2)


def test_files_are_picked_up_by_tasks(spark, tmp_path, monkeypatch):
    """In chunks, oldest first, none twice; a failed batch is repeated with its files. No plan and no file source holds a payload file."""
    root, check, loads = tmp_path / "capture", str(tmp_path / "check"), []
    broken = []

    def load(store, raw, key, quoting):
        if broken:
            raise RuntimeError("broken load")
        limits = [raw.sparkSession.conf.get(f"spark.sql.{x}autoBroadcastJoinThreshold") for x in ("", "adaptive.")]
        assert limits == [str((10 << 20) // 64), str(10 << 20)] and not [f for f in raw.inputFiles() if f.endswith(".json")]
        loads.append((int(key.split("/")[1]), sorted(int(r["filepath"][-7:-5]) for r in raw.collect())))

    monkeypatch.setattr(ingest, "initial_load", load)
    monkeypatch.setattr(ingest, "stream_payloads", None)
    run = lambda **more: ingest_files(spark, str(root), Store(spark, str(tmp_path / "s")), check, **more)
    run()
    numbered(root, 5, 4, 3, 2, 1)
    run(max_files=2)
    assert loads == [(0, [1, 2]), (1, [3, 4]), (2, [5])]
    run(max_files=2)
    assert len(loads) == 3
    numbered(root, 8, 9)
    broken.append(True)
    with pytest.raises(StreamingQueryException):
        run(max_files=1)
    broken.clear()
    numbered(root, 10)
    run()
    assert loads[3:] == [(3, [8]), (4, [9, 10])]
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"


def test_a_checkpoint_of_the_file_source_goes_on(spark, tmp_path, monkeypatch):
    root, check, loads = tmp_path / "capture", str(tmp_path / "check"), []
    monkeypatch.setattr(ingest, "initial_load", lambda store, raw, key, quoting: loads.append(raw.count()))
    store = Store(spark, str(tmp_path / "s"))
    numbered(root, 1, 2)
    ingest.ingest_stream(stream_payloads(spark, str(root)), store, check).awaitTermination()
    numbered(root, 3)
    ingest_files(spark, str(root), store, check)
    assert loads == [2, 1]


def test_repeated_epoch_is_skipped(spark, capture, store):
    raw = scan_payloads(spark, str(capture))
    run = load_batch(store, name="q")
    run(raw, 0)
    run(raw, 0)
    assert store.commits().count() == 1
    run(raw, 1)
    assert store.commits().count() == 2 and store.read("users").count() == 4


CITIES_DDL = ("city string, city_ascii string, lat double, lng double, country string, iso2 string, iso3 string, "
              "admin_name string, capital string, population double, id int")


def city(name, ident):
    return name, name, None, 2.0, "US", "US", "USA", "Texas", None, 5.0, ident


def test_seed_and_cities_load(spark, frame, store, rows):
    world = frame(CITIES_DDL, [city("A", 1), city("A", 1), city("B", 2), city("C", 1100440040)])
    seed_load(store, world)
    assert rows(store.read("cities"), "city_id", "state_id") == [(1, 43), (1100440040, 0), (2, 43)]
    rejected = rows(store.rejects("cities"), "city_id", "reject_reason")
    assert rejected.count((1, "duplicate key")) == 1 and rejected.count((None, "missing key")) == 49
    assert store.read("us_states").count() == 50
    seed_load(store, world)
    assert store.read("us_states").count() == 50


def topics_of(store):
    names = dict(store.read("cat_name").select("name_id", "name_text").collect())
    out = {}
    for event, name in store.read("category").select("event_id", "cat_name_id").collect():
        out.setdefault(event, []).append(names[name])
    return out


def test_warehouse_sql(spark, capture, store, frame, rows):
    seed_load(store, frame(CITIES_DDL, [city("A", 1)]))
    initial_load(store, scan_payloads(spark, str(capture)))
    secondary_load(store, frame("term string, emotion string, association int", files.LEXICON))
    names = register(store)
    assert {"users", "tweet_data", "vw_tweets", "vw_tweet_emotions_all"} <= set(names)
    star = {n: store.read(n) for n in ("tweet_data", "searches", "events", "category", "cat_name")}
    built = sentiment_by_category(store.read("sentiment_category_assignment"), store.read("sentiment_category"), **star)
    by_name = {(sent, cat): n for sent, cat, n in rows(built, "sentiment_category", "category_name", "tweet_count")}
    votes, facts, found = (dict(rows(store.read("sentiment_category_assignment"))), rows(store.read("tweet_data"), "tweet_id", "search_id"),
                           dict(rows(store.read("searches"), "search_id", "event_id")))
    want = {}
    for tweet, search in facts:
        for topic in topics_of(store)[found[search]] if tweet in votes else ():
            key = ({1: "POSITIVE", 9: "NEUTRAL", 0: "NEGATIVE"}[votes[tweet]], topic)
            want[key] = want.get(key, 0) + 1
    assert want and by_name == want
    assert rows(spark.sql("SELECT CATEGORIES FROM VW_CAT_EVENTS WHERE EVENT_ID = 3002")) == [("CIVIL RIGHTS, POLITICS",)]
    shown = dict(rows(spark.sql("SELECT TWEET_ID, TWEET_TEXT FROM VW_TWEET_TEXT")))
    assert shown["1"] == "happy love wins today" and shown["2"] is None and shown["3"] == "agree with this"
    assert rows(spark.sql("SELECT TWEET_ID, EMOTION FROM VW_EMOTION_DISTINCT_SETS WHERE TWEET_ID = '4'")) == [
        ("4", "anticipation, fear, negative")]
    assert spark.sql("SELECT * FROM VW_TWEETS WHERE KEYWORD_SEARCH = 'africa'").count() == 2
    assert spark.sql("SELECT * FROM VW_US_CITIES").count() == 1


def test_empty_capture(spark, store, tmp_path):
    (tmp_path / "capture" / "ebola").mkdir(parents=True)
    files.write(tmp_path / "capture", "ebola", "none_2014-03-23_2014-03-24.json", {"meta": {"result_count": 0}})
    log = initial_load(store, scan_payloads(spark, str(tmp_path / "capture")), "one")
    assert sorted(r.comment for r in log.collect()) == [
        "SEARCHES: 'none', '1000', '3000'", "SEARCH_DATES: '2014-03-23','2014-03-24'", "TEXT: 0 LOADED, 0 SKIPPED",
        "TWEET_DATA: 0 LOADED, 0 SKIPPED", "USERS: 0 LOADED, 0 SKIPPED"]
    assert store.read("searches").count() == 1


def test_two_sources_and_a_new_checkpoint(spark, store, tmp_path):
    """Loads are keyed by the stream, so neither a second root nor a new checkpoint takes its batches for loaded ones."""
    for name, ident in (("one", "1"), ("two", "2")):
        files.write(tmp_path / name, "ebola", f"{name}_2014-03-23_2014-03-24.json",
                    files.payload([files.tweet(ident, "a" + ident, "love")], [files.user("a" + ident)]))
        ingest_files(spark, str(tmp_path / name), store, str(tmp_path / f"check-{name}"))
    assert store.read("tweet_data").count() == 2
    ingest_files(spark, str(tmp_path / "one"), store, str(tmp_path / "check-anew"))
    assert store.read("tweet_data").count() == 2 and store.commits().count() == 3


def test_wrong_names_are_errors(spark, store):
    with pytest.raises(ValueError):
        load(spark, store.root, "users")
    with pytest.raises(ValueError):
        store.read("vw_cat_events")


# --- what a load moves

TEXT_ROWS = [(1, "f", 0, "a"), (2, "f", 0, "a"), (3, "f", 1, "b"), (4, "g", 0, "b"), (5, "g", 1, None), (6, "g", 2, "c"), (7, "g", 3, None)]


@pytest.mark.parametrize("known, opens", [([], 3), (["c"], 2), (["a", "b", "c"], 0)])
def test_keys_are_judged_apart_from_the_texts(frame, store, known, opens):
    texts = frame("item long, filepath string, pos int, tweet_id string", TEXT_ROWS).withColumn("tweet", F.repeat("tweet_id", F.lit(3)))
    marked = loads._opens_kept(store, "text_opens", 1, texts, frame("tweet_id string", [(k,) for k in known]), ["tweet_id"])
    found = {r["item"]: r["_opens"] for r in marked.collect()}
    assert len(found) == len(TEXT_ROWS) and sum(found.values()) == opens
    assert found[3] == ("b" not in known) and found[6] == ("c" not in known) and not (found[4] or found[5] or found[7] or found[1] and found[2])
    assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()


def test_a_load_leaves_nothing_but_tables(spark, capture, store):
    initial_load(store, scan_payloads(spark, str(capture)), "first")
    left = {f.name for f in Path(store.root).iterdir() if any(f.glob("batch_id=*"))}
    assert "tweet_text" in left and not left & {"captures", "text_opens"}
    assert all(f.name.endswith(".zstd.parquet") for f in Path(store.root, "tweet_text").rglob("*.parquet"))


def test_posts_stand_once_for_every_original_of_an_id(frame):
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", [
        (1, "a", "en", "s", 5), (1, "b", "en", "s", 6), (2, "c", "en", "s", 2000), (2, "c", "en", "s", 2000), (3, "d", "en", "s", 2001), (9, "e", "en", "s", 2001),
        (2, "x", "de", "t", 2000), (4, None, None, "t", 2000), (None, "n", "en", "s", 2000), (600, "far", "en", "s", None)])
    found = {(r["filepath"] or "").split("/")[-1]: json.loads(r["value"]) for r in captures.build_payloads(docs, docs).collect()}
    page = found["s_2015-01-01_2015-01-02.json"]
    assert [x["id"] for x in page["data"]] == ["1", "1", "2", "2", "2", "2", "3", "3", "3", "9"] and page["meta"] == {"result_count": 10}
    assert sorted((x["id"], x.get("text")) for x in page["includes"]["tweets"]) == [
        ("1", "a"), ("1", "a"), ("1", "b"), ("1", "b"), ("2", "c"), ("2", "c"), ("2", "x"), ("8", None)]
    lost = found["t_2015-01-01_2015-01-02.json"]
    assert [x["id"] for x in lost["data"]] == ["2", "2"] and lost["errors"] == [{"value": "1", "title": "Not Found Error"}] * 2
    assert lost["includes"]["tweets"] == [] and page["errors"] == []
