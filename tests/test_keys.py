import random

import pytest
from pyspark.sql import functions as F

from voxstar.operators import joins, keys, paging, quality


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; some keys are null."""
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}"), rng.random()) for i in range(900)]
    return data, spark.createDataFrame(data, "id int, key string, v double").repartition(5)


def test_dedupe_first_and_last(skewed, rows):
    data, df = skewed
    for pick, function in ((min, keys.dedupe_first), (max, keys.dedupe_last)):
        want = {}
        for i, key, _ in data:
            want[key] = i if key not in want else pick(want[key], i)
        assert {r.key: r.id for r in function(df, ["key"], ["id"]).collect()} == want


@pytest.mark.parametrize("salts", [1, 7, None])
def test_tag_first_keeps_all_rows(skewed, salts):
    data, df = skewed
    tagged = keys.tag_first(df, ["key"], ["v", "id"], salts=salts).collect()
    assert len(tagged) == len(data)
    firsts = {}
    for i, key, v in data:
        if key is not None:
            firsts[key] = min(firsts.get(key, (9, 0)), (v, i))
    assert {r.key: (r.v, r.id) for r in tagged if r.is_first} == firsts


def test_tag_first_marks_one_of_equal_rows(frame):
    df = frame("key string, v int", [("a", 1)] * 5 + [("b", None), ("b", None)])
    marked = [r.key for r in keys.tag_first(df, ["key"], ["v"]).collect() if r.is_first]
    assert sorted(marked) == ["a", "b"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(skewed, spark, how, rows):
    _, df = skewed
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("zz", 5)], "key string, r int")
    plain = df.join(right, ["key"], how)
    salted = joins.skew_join(df, right, ["key"], how, ["id"], hot_rows=20)
    assert rows(salted, *plain.columns) == rows(plain)


def test_skew_join_splits_the_hot_key(skewed, spark):
    _, df = skewed
    right = spark.createDataFrame([("hot", 1)], "key string, r int")
    plan = joins.skew_join(df, right, ["key"], "inner", ["id"], hot_rows=50)._jdf.queryExecution().toString()
    assert "_salt" in plan
    with pytest.raises(ValueError):
        joins.skew_join(df, right, ["key"], "full_outer", ["id"])


@pytest.mark.parametrize("how", ["left", "left_anti", "inner", "left_semi"])
def test_skew_join_spreads_null_keys(spark, how, rows):
    """Null keys match nothing; they stay where they lie instead of meeting in one task."""
    df = spark.range(0, 2000, 1, 4).select("id", F.when(F.col("id") >= 1990, F.lit("a")).alias("key"))
    right = spark.createDataFrame([("a", 1), (None, 2)], "key string, r int")
    joined = joins.skew_join(df, right, ["key"], how, ["id"], hot_rows=100)
    plain = df.join(right, ["key"], how)
    assert rows(joined, *plain.columns) == rows(plain)
    if how in ("left", "left_anti"):
        sizes = [r["n"] for r in joined.filter("key IS NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) <= 500 and sum(sizes) == 1990


def test_full_outer_keyed(skewed, spark, rows):
    _, df = skewed
    right = spark.createDataFrame([("hot", 1), ("none", 2)], "key string, r int")
    want = df.join(right, "key", "full_outer")
    assert rows(joins.full_outer_keyed(df, right, ["key"], ["id"], hot_rows=10), *want.columns) == rows(want)


def test_foreign_keys_and_cascade(frame, rows):
    child = frame("id int, parent int", [(1, 10), (2, 11), (3, None), (4, 10)])
    parent = frame("pid int", [(10,), (10,), (12,)])
    ok, bad = keys.enforce_fk(child, parent, "parent", "pid")
    assert rows(ok) == [(1, 10), (4, 10)] and rows(bad) == [(2, 11), (3, None)]
    assert rows(keys.cascade_delete(child, frame("parent int", [(10,), (10,)]), "parent"), "id") == [(2,), (3,)]


def test_tag_exists_beyond_the_limit(skewed, spark):
    _, df = skewed
    parent = spark.createDataFrame([("hot",), ("hot",), ("k5",), (None,)], "p string")
    small = keys.tag_exists(df, parent, "key", "p", "known")
    want = small.filter("known").count()
    assert small.count() == 900 and want > 300
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = keys.tag_exists(df, parent, "key", "p", "known")
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == 900 and large.filter("known").count() == want
        # the join shuffles the parent for itself, after the shuffle of its distinct
        assert plan.count("ENSURE_REQUIREMENTS") >= 3 and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_assign_ids_are_dense_and_ordered(skewed):
    data, df = skewed
    got = keys.assign_ids(df, "n", 5000, ["v", "id"]).collect()
    want = {i: 5000 + n for n, (_, i) in enumerate(sorted((v, i) for i, _, v in data))}
    assert {r.id: r.n for r in got} == want


def test_assign_ids_without_order_or_shuffle(skewed):
    data, df = skewed
    got = keys.assign_ids(df, "n", 7, None)
    assert sorted(r.n for r in got.collect()) == list(range(7, 7 + len(data)))
    fixed = keys.fix_rows(df)
    some = keys.number_fixed(fixed.filter("id % 3 = 1"), "n", 100).collect()
    assert sorted(r.n for r in some) == list(range(100, 100 + len(some))) and len(some) == 300


def test_upsert_and_resolve(spark, frame, rows):
    stored = frame("search_id bigint, keyword string", [(2000, "a"), (2004, "b")])
    incoming = frame("keyword string, x int", [("c", 1), ("a", 1), ("d", 1), ("c", 2)])
    everything, created = keys.upsert_dim(stored, incoming, ["keyword"], "search_id", 2000)
    assert rows(created) == [(2005, "c"), (2006, "d")]
    assert everything.count() == 4
    assert rows(keys.resolve_id(incoming, everything, ["keyword"], "search_id"), "keyword", "search_id") == [
        ("a", 2000), ("c", 2005), ("c", 2005), ("d", 2006)]
    empty = stored.filter("false")
    assert rows(keys.upsert_dim(empty, incoming, ["keyword"], "search_id", 2000)[1], "search_id") == [(2000,), (2001,), (2002,)]
    twice = stored.unionByName(frame("search_id bigint, keyword string", [(9, "a")]))
    with pytest.raises(Exception, match="more than one search_id"):
        keys.resolve_id(incoming.filter("keyword = 'a'"), twice, ["keyword"], "search_id").collect()
    with pytest.raises(Exception, match="no search_id"):
        keys.resolve_id(incoming, stored, ["keyword"], "search_id").collect()


def test_correct(frame, rows):
    df = frame("city_id int, state_id int", [(1, 5), (2, 6), (3, None)])
    assert rows(keys.correct(df, "city_id", [2, 9], "state_id", 0)) == [(1, 5), (2, 0), (3, None)]


def test_reject_reasons(frame, rows):
    df = frame("id string, a string, n string", [("1", "x", "5"), (None, "x", "5"), ("3", "it's \"q\"", "5"), ("4", "x", "y")])
    rules = {"missing": F.col("id").isNull(), "quotes": quality.unquotable("a"), "type": quality.bad_type("n", "int")}
    ok, bad = quality.split_valid(df, rules)
    assert rows(ok, "id") == [("1",)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing", "quotes", "type"]


def test_audit_and_reconcile(frame, rows):
    tagged = frame("filepath string, reject_reason string", [("f1", None), ("f1", "x"), ("f2", None)])
    log = quality.audit(tagged, "INITIAL", "USERS")
    assert rows(log, "load_type", "comment", "filepath") == [
        ("INITIAL", "USERS: 1 LOADED, 1 SKIPPED", "f1"), ("INITIAL", "USERS: 1 LOADED, 0 SKIPPED", "f2")][::-1]
    assert rows(quality.audit_totals(log)) == [("INITIAL", "USERS", 2, 1, 2)]
    report = quality.reconcile(log, {"USERS": tagged, "OTHER": tagged})
    assert rows(report, "table_name", "loaded", "table_rows", "difference") == [("OTHER", None, 3, 3), ("USERS", 2, 3, 1)]


@pytest.mark.parametrize("stride", [1, 3, 1000])
def test_cap_pages(spark, stride):
    rng = random.Random(5)
    pages = [(w, n, rng.choice([None, 0, 10, 40])) for w in ("w1", "w2") for n in range(60)]
    pages += [("hot", n, 1) for n in range(300)]
    kept = []
    for w in ("w1", "w2", "hot"):
        seen = 0
        for _, n, count in sorted(p for p in ((a, b, c or 0) for a, b, c in pages) if p[0] == w):
            if seen >= 100:
                break
            if count:
                kept.append((w, n))
            seen += count
    df = spark.createDataFrame(pages, "w string, n int, result_count int")
    got = paging.cap_pages(df, ["w"], "n", 100, stride=stride).collect()
    assert sorted((r.w, r.n) for r in got) == sorted(kept)


def test_page_totals(frame, rows):
    df = frame("w string, result_count int", [("a", 5), ("a", 7), ("b", None)])
    assert rows(paging.page_totals(df, ["w"])) == [("a", 12, 2), ("b", None, 1)]
