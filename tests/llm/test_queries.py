"""The registered queries: SQL twins, brute force on the shared tables, the pipeline's stages."""

from pathlib import Path

import brute
import oracle
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from voxstar.llm import queries
from voxstar.session import fresh_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables not present")


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(oracle.registry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.QUERIES.items() if sql))
def test_sql_twin(spark, name):
    assert oracle.compare(spark, name, SF) is None


def test_secret_scan(spark):
    got = {r["doc_id"]: r for r in queries.op1_secret_scan(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc, text in texts:
        spans = brute.secrets(text)
        assert got[doc]["base_sha256"] == brute.sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans))
        assert [got[doc][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[1] == i for s in spans) for i in range(3)]


def test_packing(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    brute.check_pieces([tuple(r) for r in queries.op3_pack_sequences(spark, SF).collect()], ids)


def test_language_on_held_out_documents(spark):
    folder = SF.replace("0.001", "0.01")
    got = queries.op8_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_pipeline_stages(spark):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_dir(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "pack_sequences":
            assert {r["doc_id"] for r in docs.collect()} == {r[0] for r in before}
            break
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        after = [tuple(r) for r in docs.collect()]
        if name == "quality_rules":
            kept = {r["doc_id"] for r in queries.op9_quality_rules(spark, SF).where("kept").collect()}
            assert sorted(after) == sorted(r for r in before if r[0] in kept)
        elif name == "line_dedup":
            want = {d: t for d, t, _, gone in brute.line_dedup([r[:2] for r in before]) if not gone or brute.words(t)}
            assert {r[0]: r[1] for r in after} == want and all(r[4] == len(r[1]) for r in after)
        elif name == "near_dedup":
            keep = {d for rk, d, _, _, _, head in brute.near([(*r[:2], r[0]) for r in before]) if rk == head}
            assert sorted(after) == sorted(r for r in before if r[0] in keep)
        else:
            assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 2
        before = after
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
