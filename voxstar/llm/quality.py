"""Quality rules judged per document and, with shrunk failure rates, per host."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voxstar.llm import words as W
from voxstar.llm.staging import checkpointed, packed, stored
from voxstar.shipping import ship

#: The window of the repetition rule, in words.
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(SYMBOLS)] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated(words: W.Words, width: int) -> np.ndarray:
    """Per text, the words inside a window of ``width`` words that the text holds twice or more."""
    at = W.inside(words, width)
    covered = np.zeros(len(words.starts) + 1, np.int64)
    if len(at):
        gram = W.windows(words.hashes(), width)[at] + W.mix(words.of()[at].astype(np.uint64))
        order = np.argsort(gram, kind="stable")
        same = gram[order][1:] == gram[order][:-1]
        twice = np.zeros(len(at), np.bool_)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered[at[twice]] += 1
        ends = at[twice] + width
        np.subtract.at(covered, ends, 1)
    return W.per_text(np.cumsum(covered[:-1]) > 0, words.offsets)


def _measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    words = W.find(texts)
    solid = ~W._SPACE[words.data] & ((words.data & 0xC0) != 0x80)
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    return {
        "n_words": words.counts,
        "word_chars": W.per_text(solid, words.texts),
        "n_symbols": W.per_text(_SYMBOL[words.data], words.texts),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": _repeated(words, REPEAT_WINDOW),
    }


def measure(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and the six counts of each row's whole ``text`` (null: no words), all long.

    Partitions are handled on their own, without a shuffle, about a megabyte of text at a time.
    """
    ship(docs.sparkSession)
    kept = docs.select(*keep, F.col("text").cast("binary").alias("_text"))
    schema = kept.drop("_text").schema
    for name in MEASURES:
        schema = schema.add(name, "long")

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            parts = [_measure(part) for _, part in W.slices(texts)]
            if parts:
                found = [pa.array(np.concatenate([p[n] for p in parts]).astype(np.int64)) for n in MEASURES]
                yield pa.RecordBatch.from_arrays(batch.columns[:-1] + found, names=[*keep, *MEASURES])

    return kept.mapInArrow(run, schema)


def failures() -> dict[str, Column]:
    """Rule name -> whether a document fails it."""
    return {
        "short": F.col("n_words") < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host its number of documents and, per rule, the failure rate shrunk towards all hosts' rate.

    The beta prior of a rule is fitted by moments: its mean is the pooled rate m, its strength m(1-m)/v - 1 with v the
    variance of the hosts' rates (each weighted by its documents), held between 1 and 1,000,000. Only those two
    numbers per rule reach the driver.
    """
    rules = failures()
    hosts = packed(measured.where(F.col(host).isNotNull()).groupBy(host)
                   .agg(F.count(F.lit(1)).alias("n_docs"),
                        *[F.sum(fails.cast("long")).alias(name) for name, fails in rules.items()]))
    row = hosts.agg(F.sum("n_docs").alias("n"), *[F.sum(r).alias(r) for r in rules]).first()
    if not row["n"]:
        return hosts.withColumns({r: F.lit(0.0) for r in rules})
    mean = {r: row[r] / row["n"] for r in rules}
    spread = hosts.agg(*[F.sum(F.col("n_docs") * F.pow(F.col(r) / F.col("n_docs") - mean[r], 2)).alias(r)
                         for r in rules]).first()
    shrunk = {}
    for r, m in mean.items():
        v = spread[r] / row["n"]
        strength = min(max(m * (1 - m) / v - 1, 1.0), 1e6) if v > 0 else 1e6
        shrunk[r] = (F.col(r) + m * strength) / (F.col("n_docs") + strength)
    return hosts.withColumns(shrunk)


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row's ``doc_id``, host, ``keep`` and measures, ``base_failed`` and ``kept``.

    A document is kept unless it fails a base rule (under 20 words, over 30 % repeated words) or its host is
    rejected: some rule's shrunk failure rate exceeds ``max_rate``. A document without a host is judged by the base
    rules alone. Equal rows get equal verdicts, null and empty texts have no words and fail, an empty table gives no
    rows, other columns are not read.

    Without ``keep`` the counts, a few dozen bytes a document, are checkpointed; with it (texts, say) they are taken
    again instead, as the wider rows cost more to write. Host sums combine before their shuffle. The table of
    verdicts has a known size: below Spark's threshold it is broadcast and no text is shuffled, beyond it hot hosts
    are split by adaptive execution.
    """
    columns = tuple(dict.fromkeys(("doc_id", host, *keep)))
    measured = measure(docs, columns)
    if not keep:
        measured = checkpointed(measured)
    rates = host_rates(measured, host)
    bad = F.lit(False)
    for rule in failures():
        bad = bad | (F.col(rule) > max_rate)
    verdicts = stored(rates.select(F.col(host).alias("_host"), bad.alias("_rejected")), "verdicts")
    rules = failures()
    failed = F.coalesce(rules["short"] | rules["repeats"], F.lit(True))
    return (measured.join(verdicts, F.col(host) == F.col("_host"), "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~F.coalesce(F.col("_rejected"), F.lit(False)))
            .drop("_host", "_rejected"))
