"""Commits that must not go stale, keys by bucket, deletions along the key graph, corrections of stored rows."""

import json
import os
import shutil
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import payload_files as files
from voxstar.operators.cascade import GONE, ForeignKey, cascade, delete_order, deleted_counts, remaining

from voxstar.plans.changes import SCHEMA_KEYS, correct_rows, delete_rows
from voxstar.plans.loads import initial_load, loaded_once, secondary_load, seed_load
from voxstar.schemas import TABLES, table_schema
from voxstar.sources.files import publish, remove
from voxstar.sources.payloads import scan_payloads
from voxstar.sources.tables import StaleCommit, Store, key_bucket


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def capture(spark, root, name, tweets, users, event="ebola"):
    files.write(root / name, event, f"{name}_2014-03-23_2014-03-24.json", files.payload(tweets, users))
    return scan_payloads(spark, str(root / name))


# --- publishing

@pytest.mark.parametrize("linked", [True, False])
def test_a_file_is_published_once(spark, tmp_path, linked):
    path = str(tmp_path / "log" / "1.json")
    (tmp_path / "log").mkdir()
    assert publish(spark, path, "first é", linked) and not publish(spark, path, "second", linked)
    assert Path(path).read_text() == "first é"
    assert [f for f in os.listdir(tmp_path / "log") if not f.endswith(".crc")] == ["1.json"]


def test_one_of_many_writers_wins(spark, tmp_path):
    path, won = str(tmp_path / "1.json"), []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if publish(spark, path, str(i)) else None) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and Path(path).read_text() == str(won[0])


def test_remove_takes_patterns_and_nothing(spark, tmp_path):
    for name in ("a/batch_id=1", "b/batch_id=1", "b/batch_id=12"):
        (tmp_path / name).mkdir(parents=True)
    remove(spark, f"{tmp_path}/*/batch_id=1")
    remove(spark, f"{tmp_path}/none/*")
    assert sorted(p.name for p in tmp_path.glob("*/*")) == ["batch_id=12"]


# --- commits

def test_commit_on_an_old_snapshot_is_refused(store):
    old = store.snapshot()
    assert old.commit(1, "first") == 1
    with pytest.raises(StaleCommit):
        old.commit(2, "second")
    assert store.commits().count() == 1
    assert store.snapshot().commit(2, "second") == 2
    assert store.commit(3, "no snapshot") == 3


def test_derivation_and_capture_do_not_disturb_each_other(store):
    old = store.snapshot()
    old.commit(1, "a capture", "capture")
    assert old.commit(2, "a derivation", "derivation", covers_to=0) == 2
    with pytest.raises(StaleCommit):
        old.commit(3, "a rewrite", "rewrite")
    assert store.derived_to() == 0


def test_two_loads_from_one_snapshot_leave_one_set_of_keys(spark, store, tmp_path, rows, monkeypatch):
    """The second load is refused, runs again on the first one's result and finds its keys taken."""
    raw = capture(spark, tmp_path, "who", [files.tweet("1", "a", "love"), files.tweet("2", "a", "fear")], [files.user("a")])
    more = capture(spark, tmp_path, "cdc", [files.tweet("2", "a", "fear"), files.tweet("3", "b", "hope")], [files.user("a"), files.user("b")])
    stale, runs = store.snapshot(), []
    taken = [stale]

    fresh = Store.snapshot

    def snapshot(self):
        runs.append(self)
        return taken.pop() if taken else fresh(self)

    initial_load(store, raw, "one")
    monkeypatch.setattr(Store, "snapshot", snapshot)
    initial_load(store, more, "two")
    assert len(runs) == 2
    assert rows(store.read("users"), "author_id") == [("a",), ("b",)]
    assert rows(store.read("tweet_text"), "tweet_id") == [("1",), ("2",), ("3",)]
    assert [r[0] for r in rows(store.read("tweet_data"), "data_id")] == [5000, 5001, 5002, 5003]
    assert rows(store.read("search_dates"), "search_date_id") == [(1000,)]
    visible = {str(r[0]) for r in store.commits().select("batch_id").collect()}
    left = {p.name.split("=")[1] for p in Path(store.root).glob("**/batch_id=*")}
    assert left <= visible and not list(Path(store.root).glob("captures/*"))  # the refused attempt and intermediates are gone


def test_a_load_gives_up_after_some_attempts(spark, store, frame, monkeypatch):
    stale, runs = store.snapshot(), []
    store.commit(1, "other")
    monkeypatch.setattr(Store, "snapshot", lambda self: stale)

    def run(snapshot, batch_id, key):
        runs.append(batch_id)
        snapshot.write("users", frame("author_id string", [("a",)]), batch_id)
        snapshot.commit(batch_id, key)

    with pytest.raises(StaleCommit):
        loaded_once(store, "late", run)
    assert len(set(runs)) == 3 and not list(Path(store.root).glob("users/batch_id=*"))


def test_a_finished_load_is_never_discarded(store, frame):
    def run(snapshot, batch_id, key):
        snapshot.write("users", frame("author_id string", [("a",)]), batch_id)
        snapshot.commit(batch_id, key)
        raise RuntimeError("after the commit")

    with pytest.raises(RuntimeError):
        loaded_once(store, "one", run)
    assert store.read("users").count() == 1


def test_parallel_loads(spark, store, tmp_path, rows):
    raws = [capture(spark, tmp_path, f"k{'abc'[i]}", [files.tweet(str(10 * i + j), f"u{j}", "love") for j in range(3)],
                    [files.user(f"u{j}") for j in range(3)]) for i in range(2)]
    failed = []

    def run(i):
        try:
            initial_load(store, raws[i], f"load {i}")
        except Exception as error:  # shown below
            failed.append(error)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    assert [r[0] for r in rows(store.read("tweet_data"), "data_id")] == list(range(5000, 5006))
    assert rows(store.read("users"), "author_id") == [("u0",), ("u1",), ("u2",)]


def test_plans_do_not_grow_with_commits(spark, store):
    sizes = []
    for i in range(3):
        store.commit(i, f"load {i}")
        sizes.append(len(store.read("users")._jdf.queryExecution().optimizedPlan().toString()))
    assert max(sizes) - min(sizes) < 50


# --- keys by bucket

def test_a_look_up_opens_only_the_buckets_of_its_keys(spark, store, frame, rows):
    """Ten loads note keys; what the eleventh opens is what shares a bucket with its own, as little as for the second."""
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("author_id"))
    by_bucket = {}
    for key, b in keys.select("author_id", key_bucket(["author_id"])).collect():
        by_bucket.setdefault(b, []).append(key)
    wanted = frame("author_id string", [(k,) for k in by_bucket[7][:3]])
    opened = []
    for i in range(11):
        found = store.snapshot().known("users", wanted)
        opened.append(sum(spark.read.parquet(f).count() for f in found.inputFiles() if "_keys/" in f))
        assert rows(found) == ([] if i == 0 else [(k,) for k in sorted(by_bucket[7][:2])])
        mine = by_bucket[7][:2] if i == 0 else by_bucket[10 + i][:8]
        store.write("users", frame("author_id string", [(k,) for k in mine]), i + 1)
        store.write_keys("users", i + 1)
        store.commit(i + 1, f"load {i}")
    assert opened == [0] + [2] * 10
    assert store.known("users", frame("author_id string", [(k,) for k in by_bucket[31][:1]])).count() == 0


def test_keys_of_a_load_that_failed_are_not_known(store, frame):
    one = frame("author_id string", [("a",)])
    store.write("users", one, 5)
    store.write_keys("users", 5)
    assert store.known("users", one).count() == 0
    store.discard(5)
    assert not list(Path(store.root).glob("**/*.parquet"))


# --- the key graph

A_TO_D = [ForeignKey("b", "a_id", "a", "id"), ForeignKey("c", "b_id", "b", "id"), ForeignKey("d", "b_id", "b", "id"),
          ForeignKey("d", "c_id", "c", "id"), ForeignKey("e", "tag", "d", "tag", unique=False)]


def test_order_of_deletion():
    order = delete_order(A_TO_D, ["a"])
    assert order.index("a") < order.index("b") < order.index("c") < order.index("d") < order.index("e")
    assert delete_order(A_TO_D, ["c"])[0] == "c" and set(delete_order(A_TO_D, ["c"])) == {"c", "d", "e"}
    assert set(delete_order(SCHEMA_KEYS, ["events"])) == {
        "events", "category", "searches", "tweet_data", "word_association", "sentiment_category_assignment", "author_location"}


def test_cycles_and_missing_tables_are_errors(frame):
    with pytest.raises(ValueError, match="cycle.*x.*y"):
        delete_order([ForeignKey("x", "y_id", "y", "id"), ForeignKey("y", "x_id", "x", "id")], ["x"])
    with pytest.raises(ValueError, match="cycle"):
        delete_order([ForeignKey("x", "up", "x", "id")], ["x"])
    assert delete_order([ForeignKey("x", "up", "x", "id")], ["z"]) == ["z"]  # a cycle out of reach does no harm
    with pytest.raises(ValueError, match="no table"):
        cascade({"a": frame("id int", [(1,)])}, A_TO_D, {"a": F.lit(True)})


def test_cascade_goes_through_every_level(frame, rows):
    tables = {"a": frame("id int", [(1,), (2,), (None,)]),
              "b": frame("id int, a_id int", [(10, 1), (11, 2), (12, None), (13, 1)]),
              "c": frame("id int, b_id int", [(20, 10), (21, 11), (22, None)]),
              "d": frame("b_id int, c_id int, tag string", [(11, 20, "t"), (11, 21, "t"), (13, 21, "u"), (None, 22, "v"), (None, None, None)]),
              "e": frame("tag string, n int", [("t", 1), ("u", 2), ("v", 3), (None, 4), ("none", 5)])}
    marked = cascade(tables, A_TO_D, {"a": F.col("id") == 1, "c": F.col("id") == 22})
    left = remaining(marked)
    assert rows(left["a"]) == [(2,), (None,)] and rows(left["b"]) == [(11, 2), (12, None)] and rows(left["c"]) == [(21, 11)]
    assert rows(left["d"]) == [(11, 21, "t"), (None, None, None)]
    assert rows(left["e"]) == [("none", 5), ("t", 1), (None, 4)]  # t stands in a row that stays, u and v do not
    assert {r.table_name: (r.deleted, r.kept) for r in deleted_counts(marked).collect()} == {
        "a": (1, 2), "b": (2, 2), "c": (2, 1), "d": (3, 2), "e": (2, 3)}
    assert all(GONE in df.columns for df in marked.values())


def test_nothing_doomed_leaves_all(frame, rows):
    tables = {"a": frame("id int", [(1,)]), "b": frame("id int, a_id int", [(1, 1)])}
    assert rows(remaining(cascade(tables, A_TO_D[:1], {"a": F.lit(None).cast("boolean")}))["b"]) == [(1, 1)]


def test_a_level_does_not_repeat_those_above(spark, frame):
    tables = {"a": frame("id int", [(1,)]), "b": frame("id int, a_id int", [(1, 1)]), "c": frame("id int, b_id int", [(1, 1)])}
    marked = cascade(tables, A_TO_D[:2], {"a": F.lit(True)})
    plan = marked["c"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "a_id" not in plan


def test_schema_keys_name_stored_columns():
    for key in SCHEMA_KEYS:
        assert key.child in TABLES and key.column in table_schema(key.child).names
        assert key.parent_column in table_schema(key.parent).names


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Two events in two loads, one tweet captured by both, everything derived."""
    root = tmp_path_factory.mktemp("made")
    store = Store(spark, str(root / "store"))
    seed_load(store)
    first = capture(spark, root, "who", [files.tweet("1", "a", "love"), files.tweet("2", "b", "fear")], [files.user("a"), files.user("b")])
    second = capture(spark, root, "rings", [files.tweet("2", "b", "fear"), files.tweet("3", "c", "hope")], [files.user("c")], "ss_marriage")
    initial_load(store, first, "one")
    initial_load(store, second, "two")
    secondary_load(store, spark.createDataFrame(files.LEXICON, "term string, emotion string, association int"), "derive")
    return store.root, first


@pytest.fixture
def filled(spark, made, tmp_path):
    """A copy of that store for one test."""
    shutil.copytree(made[0], tmp_path / "copy")
    return Store(spark, str(tmp_path / "copy")), made[1]


def test_deleting_an_event(spark, filled, rows, frame):
    store, first = filled
    before = store.snapshot()
    untouched = {p: p.stat().st_mtime_ns for p in Path(store.root).glob("users/**/*.parquet")}
    said = {r.comment for r in delete_rows(store, {"events": F.col("event_id") == 3000}, "no ebola").collect()}
    assert {"EVENTS: 1 DELETED", "SEARCHES: 1 DELETED", "TWEET_DATA: 2 DELETED", "AUTHOR_LOCATION: 1 DELETED"} <= said
    assert rows(store.read("searches"), "keyword") == [("rings",)]
    assert rows(store.read("tweet_data"), "tweet_id") == [("2",), ("3",)]
    assert {t for t, _ in rows(store.read("sentiment_category_assignment"))} == {"2", "3"}  # 2 is still captured by the other event
    assert rows(store.read("author_location"), "author_id") == [("b",), ("c",)]
    assert rows(store.read("users"), "author_id") == [("a",), ("b",), ("c",)]
    assert {p: p.stat().st_mtime_ns for p in Path(store.root).glob("users/**/*.parquet")} == untouched
    assert before.read("tweet_data").count() == 4  # a reader of the older version sees it whole
    assert delete_rows(store, {"events": F.col("event_id") == 3000}, "no ebola").count() == 0  # the key is done
    # facts are free again, so their file can be loaded anew; derived rows follow
    initial_load(store, first, "one again")
    assert rows(store.read("tweet_data"), "tweet_id") == [("1",), ("2",), ("2",), ("3",)]
    assert store.read("tweet_data").select("data_id").distinct().count() == 4


def test_deleting_a_user_frees_the_key(spark, filled, rows):
    store, first = filled
    delete_rows(store, {"users": F.col("author_id") == "a"})
    assert rows(store.read("users"), "author_id") == [("b",), ("c",)]
    assert store.known("users", spark.createDataFrame([("a",)], "author_id string")).filter("author_id = 'a'").count() == 0
    initial_load(store, first, "one again")
    assert rows(store.read("users"), "author_id") == [("a",), ("b",), ("c",)]
    assert rows(store.rejects("users"), "author_id") == [("b",)]


def test_correction_writes_touched_partitions_only(spark, filled, rows):
    store, _ = filled
    names = lambda: {p for p in Path(store.root).glob("users/**/*.parquet")}
    before = names()
    log = correct_rows(store, "users", "author_id", ["c", "nobody"], "location", "Reno, NV")
    assert [r.comment for r in log.collect()] == ["USERS: 1 CORRECTED"]
    assert rows(store.read("users"), "author_id", "location") == [("a", "Austin, TX"), ("b", "Austin, TX"), ("c", "Reno, NV")]
    assert before < names() and len(names() - before) == 1
    again = correct_rows(store, "users", "author_id", ["c"], "location", "Reno, NV")
    assert again.count() == 0 and len(names() - before) == 1
    assert store.read("users").count() == 3


def test_rewrite_keeps_rejected_rows(spark, filled, rows):
    store, first = filled
    initial_load(store, first, "again")  # two users and two texts are refused
    refused = rows(store.rejects("users"), "author_id", "reject_reason", "filepath")
    assert [r[0] for r in refused] == ["a", "b"]
    correct_rows(store, "users", "author_id", ["a", "b", "c"], "location", None)
    assert rows(store.rejects("users"), "author_id", "reject_reason", "filepath") == refused
    assert rows(store.read("users"), "location") == [(None,)] * 3


def test_commit_files_hold_one_row_each(store):
    store.commit(5, "x", "capture", next_ids={"data_id": 9})
    found = sorted(Path(store.root, "commits").glob("*.json"))
    assert [json.loads(p.read_text())["next_ids"] for p in found] == [{"data_id": 9}]
    assert store.next_id("data_id", 5) == 9 and store.next_id("wa_id", 8000) == 8000


