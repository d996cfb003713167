"""Streams with bounded state, batch by batch."""

import datetime

import pytest

from voxstar.operators.paging import cap_pages
from voxstar.streaming.state import STATE_STORE, cap_pages_stream, dedupe_within, drain


@pytest.fixture
def arriving(spark, tmp_path):
    """arriving(ddl, batches, make): run make(stream) over batches that arrive one after the other; returns all rows it wrote."""

    def run(ddl, batches, make):
        source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
        for rows in batches:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)
            out = make(spark.readStream.schema(ddl).parquet(source))
            drain(out, target, checkpoint)
        return spark.read.schema(out.schema).parquet(target)

    return run


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def test_repeats_within_a_span_go_and_later_ones_stay(arriving, rows):
    batches = [
        [("a", at(1), 1), ("a", at(1, 5), 1), ("b", at(2), 2), (None, at(2), 3), ("c", None, 4)],
        [("a", at(3), 5), ("d", at(3), 6)],      # a again two days later: within the span
        [("e", at(9), 7)],
        [("f", at(2), 8), ("e", at(10), 9)],     # f is older than day 9 by more than the span
        [("a", at(16), 10), ("g", at(16), 11)],  # a's span is over
    ]
    got = arriving("k string, ts timestamp, n int", batches, lambda s: dedupe_within(s, ["k"], "ts", "3 days"))
    assert [r[0] for r in rows(got, "k", "n")] == ["a", "a", "b", "d", "e", "g"]
    assert {r[1] for r in rows(got, "k", "n") if r[0] == "a"} == {1, 10}


def test_page_cap_goes_on_from_batch_to_batch(spark, arriving, rows):
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        pages = [("x" if n % 3 else "y", n, (n * 7) % 5 if n % 4 else None) for n in range(40)]
        batches = [pages[:9][::-1], pages[9:10], pages[10:31], pages[31:]]
        ddl = "w string, page int, result_count int"
        got = arriving(ddl, batches, lambda s: cap_pages_stream(s, ["w"], "page", 30))
        want = cap_pages(spark.createDataFrame(pages, ddl), ["w"], "page", 30)
        columns = ["w", "page", "result_count", "fetched_before"]
        assert rows(got, *columns) == rows(want, *columns) and got.count() < sum(bool(p[2]) for p in pages)
    finally:
        for k in STATE_STORE:
            spark.conf.unset(k)
