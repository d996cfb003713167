"""Plan properties that keep the work balanced and inside the JVM."""

import re
from pathlib import Path

import pytest

import oracle

SF = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in oracle.registry.queries().items() if not re.match(r"op\d+_|pipeline$", name)}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables not present")

P_VALUE_ONLY = {"point_biserial"}  # one Python step over one row per event
LOADS = {n for n in QUERIES if n.startswith(("initial_load", "secondary_load", "stream", "json_stream", "payload_files"))}


@pytest.fixture(scope="module")
def plans(spark):
    found = {}
    for name in sorted(set(QUERIES) - LOADS):
        found[name] = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    return found


def test_no_cartesian_products(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p] == []


def test_python_only_for_the_p_value(plans):
    assert {n for n, p in plans.items() if "Python" in p or "Arrow" in p} == P_VALUE_ONLY


def test_lexicon_join_does_not_shuffle_tokens(plans):
    plan = plans["word_association"]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    above_scan = plan[:plan.index("documents.parquet")]
    assert "Exchange hashpartitioning" not in above_scan


def test_dedupe_limits_before_the_shuffle(plans):
    for name in ("pk_dedupe", "last_wins_text"):
        assert plans[name].count("WindowGroupLimit") == 2


def test_scans_read_only_needed_columns(plans):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plans["indicator_matrix"]).group(1)
    assert sorted(c.split(":")[0] for c in read.split(",")) == ["event_type", "ts", "user_id"]
    assert "props" not in plans["page_cap"] and "html" not in "".join(plans.values())


# one task sees: partition sizes, new keys of a dimension, distinct masks, grand totals, a top-k report
SINGLE = ("assign_ids", "upsert_dim", "resolve_id", "frequent_itemsets", "itemset_sentiment", "support_stats", "reconcile",
          "top_support", "text_associations", "frequent_emoji", "emoji_associations")


def test_one_task_only_sees_small_sets(plans):
    single = [n for n, p in plans.items() if "Exchange SinglePartition" in p]
    assert [n for n in single if not n.startswith(SINGLE)] == []
