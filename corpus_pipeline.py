"""The corpus pipeline: stages over ``documents``, each working on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read as the next one's docs. All but the last
return the columns of documents. SQL has no packing by least squares over a tokenizer, so ORACLE_SQL is None; the tests compare each
stage with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxstar.llm import lines, mixing, near, packing, quality
from voxstar.session import fresh_dir

#: The columns of documents.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _others(*known: str) -> tuple[str, ...]:
    return tuple(c for c in COLUMNS if c not in known)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor their host's verdict rejects."""
    return quality.judge(docs, keep=_others("doc_id", "source")).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that match an earlier line. A document that loses lines and has no word left goes; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs, keep=_others("doc_id", "text"))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return (kept.where((F.col("n_removed") == 0) | ~wordless)
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id (nulls last, then the hash of doc_id and text) of each group of near duplicates (five words,
    similarity 0.8), once; of equal rows one stays, and each text without words."""
    gone = near.near_duplicates(docs).where("rk <> head").select("rk").distinct()
    rows = docs.select(*COLUMNS).withColumn("rk", F.xxhash64("doc_id", "text"))
    return rows.join(gone, "rk", "left_anti").dropDuplicates(["rk"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    mixed = mixing.mix(docs, mixing.words_in("text"), keep=_others("doc_id", "source")).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
