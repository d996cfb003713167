"""Row acceptance, reject reasons, audit rows and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxstar.session import stored

REASON = "reject_reason"


def unquotable(*columns: str) -> Column:
    """True where one value holds both quote kinds, so no quoting style fits it."""
    tests = [F.coalesce(F.col(c).contains("'") & F.col(c).contains('"'), F.lit(False)) for c in columns]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def bad_type(column: str, kind: str) -> Column:
    """True where a present value cannot be read as ``kind``."""
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def tag_rejects(df: DataFrame, rules: dict[str, Column], reason: str = REASON) -> DataFrame:
    """Add the name of the first rule a row breaks, null for a good row."""
    verdict = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        verdict = F.when(broken, F.lit(name)).otherwise(verdict)
    return df.withColumn(reason, verdict)


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason); together every input row.

    The tagged rows are written once in the shared folder, accepted and rejected ones apart, so the input is evaluated once and
    each half reads its own files only.
    """
    tagged = tag_rejects(df, rules).withColumn("_accepted", F.col(REASON).isNull())
    kept = stored(tagged, "gate", by="_accepted")
    return kept.filter("_accepted").select(*df.columns), kept.filter("NOT _accepted").select(*df.columns, REASON)


def load_counts(tagged: DataFrame, by: list[str], reason: str = REASON, nothing: str | None = None) -> DataFrame:
    """Loaded and skipped rows per group; rows with the reason ``nothing`` are neither."""
    return tagged.groupBy(*by).agg(
        F.count_if(F.col(reason).isNull()).alias("loaded"),
        F.count_if(F.col(reason) != (nothing or "")).alias("skipped"))


def audit(tagged: DataFrame, load_type: str, table: str, filepath: str | Column = "filepath",
          reason: str = REASON, nothing: str | None = None) -> DataFrame:
    """One run_log row per file: "<TABLE>: n LOADED, m SKIPPED".

    A row whose reason is ``nothing`` stands for a file without rows and counts for neither.
    """
    path = F.col(filepath) if isinstance(filepath, str) else filepath
    counted = load_counts(tagged.withColumn("filepath", path), ["filepath"], reason, nothing)
    return counted.select(
        F.current_timestamp().alias("run_date"),
        F.lit(load_type).alias("load_type"),
        F.format_string(f"{table}: %d LOADED, %d SKIPPED", "loaded", "skipped").alias("comment"),
        "filepath")


def audit_totals(run_log: DataFrame) -> DataFrame:
    """Rows loaded and skipped per (load_type, table), read back from the log text."""
    pattern = r"^(\w+): (\d+) LOADED, (\d+) SKIPPED"
    part = lambda i: F.regexp_extract("comment", pattern, i)
    return (run_log.filter(F.col("comment").rlike(pattern))
            .select("load_type", part(1).alias("table_name"),
                    part(2).cast("long").alias("loaded"), part(3).cast("long").alias("skipped"))
            .groupBy("load_type", "table_name")
            .agg(F.sum("loaded").alias("loaded"), F.sum("skipped").alias("skipped"),
                 F.count(F.lit(1)).alias("loads")))


def reconcile(run_log: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Logged totals beside the present row counts, with their difference."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows")
        counts = one if counts is None else counts.unionByName(one)
    logged = audit_totals(run_log).groupBy("table_name").agg(
        F.sum("loaded").alias("loaded"), F.sum("skipped").alias("skipped"))
    return (logged.join(counts, "table_name", "full_outer")
            .withColumn("difference", F.coalesce("table_rows", F.lit(0)) - F.coalesce("loaded", F.lit(0))))
