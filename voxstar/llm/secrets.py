"""Secret scan in DataFrame functions alone: fixed forms and sliding-window entropy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Marks round a match; their own occurrences in a text become another character outside all patterns.
OPEN, CLOSE, END = "\ue000", "\ue001", "\ue002"


@dataclass(frozen=True)
class Form:
    """A fixed form: every leftmost match counts if ``measured`` ($0 or a group) has ``least`` characters."""

    kind: str
    pattern: str
    measured: str
    least: int


@dataclass(frozen=True)
class Entropy:
    """A character class: runs of at least ``window`` of its characters are candidates; a window counts from ``bits`` on."""

    kind: str
    alphabet: str
    characters: str
    window: int
    bits: float
    skip: str = ""


_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The base forms. What looks ahead or behind only spares attempts that cannot match.
FORMS = (
    Form("assign", "(?=[AaPpSsTt])((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "$2", 12),
    Form("access", "AKIA[A-Z0-9]+", "$0", 18),
    Form("hex", "(?<![0-9a-f])[0-9a-f]{16,}", "$0", 16),  # whole runs of one class: the short ones fail anyway
)
CLASSES = (
    Entropy("entropy_hex", "[0-9A-Fa-f]", "0123456789abcdefABCDEF", 20, 3.0),
    Entropy("entropy_base64", "[A-Za-z0-9+/_=-]", _LOWER + _LOWER.upper() + "0123456789+/_=-", 24, 4.1, skip="^[0-9A-Fa-f]*$"),
)
#: Candidates that are no secrets: UUIDs, words without a digit, placeholders, alphabets and counts written out.
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^[^0-9]*$",
    "(?i)example|placeholder|changeme|x{6}",
    "(?i)abcdefghij|0123456789|1234567890",
)


def _parts(text: Column, pattern: str, measured: str) -> Column:
    """Per match: its characters (``size``), those measured, those up to the next match (``rest``) and the match; before them a row for the beginning."""
    marked = F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}{measured}{END}")

    def row(part: Column, index: Column) -> Column:
        found = F.when(index > 0, F.substring_index(part, CLOSE, 1)).otherwise("")
        return F.struct(F.length(found).cast("long").alias("size"),
                        F.length(F.substring_index(F.substring_index(part, END, 1), CLOSE, -1)).alias("measured"),
                        F.length(F.substring_index(part, END, -1)).cast("long").alias("rest"), found.alias("found"))

    return F.when(text.rlike(pattern), F.transform(F.split(marked, OPEN), row))


def _log_weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def entropy_spans(found: Column, kind: Entropy) -> Column:
    """(low, high) stretches of the candidate covered by windows of enough Shannon entropy.

    One pass over the characters with a counter per character of the class. A character that enters or leaves changes one counter and the
    sum of c * log2(c); the entropy is log2(window) less that sum over the window.
    """
    w, size = kind.window, len(kind.characters)
    codes = F.transform(F.filter(F.split(found, ""), lambda c: c != ""), lambda c: F.instr(F.lit(kind.characters), c) - 1)
    span = "array<struct<low:int,high:int>>"
    # the state carries the codes, or every step would derive them anew
    start = F.struct(codes.alias("codes"), F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("weight"),
                     F.array().cast(span).alias("done"), F.lit(-1).alias("low"), F.lit(-1).alias("high"))

    def step(state: Column, i: Column) -> Column:
        """i is the place of the entering character, from 1."""
        enters = F.element_at(state["codes"], i)
        leaves = F.when(i > w, F.element_at(state["codes"], F.when(i > w, i - w).otherwise(1))).otherwise(-1)
        up = F.element_at(state["counts"], enters + 1)
        down = F.when(leaves >= 0, F.element_at(state["counts"], F.greatest(leaves + 1, F.lit(1)))).otherwise(0)
        same = enters == leaves
        weight = state["weight"] + F.when(same, 0.0).otherwise(
            _log_weight(up + 1) - _log_weight(up) + F.when(leaves >= 0, _log_weight(down - 1) - _log_weight(down)).otherwise(0.0))
        counts = F.when(same, state["counts"]).otherwise(F.transform(
            state["counts"], lambda c, k: c + F.when(k == enters, 1).when(k == leaves, -1).otherwise(0)))
        hot = (i >= w) & (F.log2(F.lit(float(w))) - weight / w >= kind.bits)
        apart = hot & (state["low"] >= 0) & (i - w > state["high"])
        done = F.when(apart, F.concat(state["done"], F.array(F.struct(state["low"].alias("low"), state["high"].alias("high"))))) \
            .otherwise(state["done"])
        return F.struct(state["codes"].alias("codes"), counts.alias("counts"), weight.alias("weight"), done.alias("done"),
                        F.when(hot & ((state["low"] < 0) | apart), i - w).otherwise(state["low"]).alias("low"),
                        F.when(hot, i).otherwise(state["high"]).alias("high"))

    def finish(state: Column) -> Column:
        last = F.array(F.struct(state["low"].alias("low"), state["high"].alias("high")))
        return F.when(state["low"] >= 0, F.concat(state["done"], last)).otherwise(state["done"])

    return F.aggregate(F.sequence(F.lit(1), F.length(found)), start, step, finish)


def _pieces(found: Column, patterns: list[str], window: int) -> Column:
    """The candidate without its placeholders, as (at, piece).

    A placeholder takes the letters and digits round it if there are at most ``window`` of them on either side, and else only itself.
    """
    some, near = "|".join(f"(?:{p})" for p in patterns), f"[A-Za-z0-9]{{0,{window}}}"
    marked = F.regexp_replace(found, f"(?<![A-Za-z0-9]){near}(?:{some}){near}(?![A-Za-z0-9])|{some}", f"{OPEN}$0{CLOSE}")
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,piece:string>>").alias("done"))

    def step(state: Column, part: Column) -> Column:
        piece = F.substring_index(part, CLOSE, -1)
        at = state["end"] + F.when(F.contains(part, F.lit(CLOSE)), F.length(F.substring_index(part, CLOSE, 1))).otherwise(0)
        return F.struct((at + F.length(piece)).alias("end"),
                        F.concat(state["done"], F.array(F.struct(at.alias("at"), piece.alias("piece")))).alias("done"))

    whole = F.array(F.struct(F.lit(0).alias("at"), found.alias("piece")))
    return F.when(found.rlike(some), F.aggregate(F.split(marked, OPEN), start, step, lambda s: s["done"])).otherwise(whole) if patterns else whole


def scan(docs: DataFrame, forms: tuple[Form, ...] = FORMS, classes: tuple[Entropy, ...] = CLASSES,
         allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``rk``, ``kind_no``, ``kind``, ``low``, ``high``: every span of a secret in every whole text, in code points, end exclusive.

    ``rk`` is the 64-bit hash of (doc_id, text). Fixed forms come first in ``kind_no``, character classes after them. A candidate run that an
    ``allowed`` pattern beginning with ^ matches gives no entropy span; other ``allowed`` patterns are placeholders, which windows must not
    touch, and the rest of the run is searched. Spans of fixed forms stay. Rows with equal doc_id and text share one set of spans. Null and
    empty texts and an empty table give no spans; other columns are not read.

    Only lengths and candidates leave the scan, not texts; places follow from running sums over a text's matches.
    """
    marks, text = OPEN + CLOSE + END, F.col("clean")
    clean = F.when(F.col("text").rlike(f"[{marks}]"), F.translate("text", marks, "\ufffd" * 3)).otherwise(F.col("text"))
    patterns = [(f.pattern, f.measured) for f in forms] + [
        (f"(?<!{c.alphabet}){c.alphabet}{{{c.window},}}", "$0") for c in classes]
    cleaned = docs.select(F.xxhash64("doc_id", "text").alias("rk"), clean.alias("clean"))

    def placed(numbers: range) -> DataFrame:
        """The matches of some patterns with their ``start``."""
        every = F.array(*[F.struct(F.lit(i).alias("kind_no"), _parts(text, *patterns[i]).alias("parts")) for i in numbers])
        rows = (cleaned.select("rk", F.explode(every).alias("x")).where("x.parts is not null")
                .select("rk", "x.kind_no", F.posexplode("x.parts").alias("i", "part")).select("rk", "kind_no", "i", "part.*")
                .repartition("rk", "kind_no").dropDuplicates(["rk", "kind_no", "i"]))
        before = Window.partitionBy("rk", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("start", F.coalesce(F.sum(F.col("size") + F.col("rest")).over(before), F.lit(0))).where("i > 0")

    least = F.lit(0)
    for i, f in enumerate(forms):
        least = F.when(F.col("kind_no") == i, f.least).otherwise(least)
    fixed = placed(range(len(forms))).where(F.col("measured") >= least) \
        .select("rk", "kind_no", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high"))
    fine = F.lit(False)
    for pattern in allowed:
        if pattern.startswith("^"):
            fine = fine | F.col("found").rlike(pattern)
    rest = _pieces(F.col("found"), [p for p in allowed if not p.startswith("^")], max((c.window for c in classes), default=0))
    spans = F.lit(None).cast("array<struct<low:int,high:int>>")
    for i, c in enumerate(classes):
        mine = (F.col("kind_no") == len(forms) + i) & ~(F.col("found").rlike(c.skip) if c.skip else F.lit(False))
        spans = F.when(mine & (F.length("piece") >= c.window), entropy_spans(F.col("piece"), c)).otherwise(spans)
    dense = placed(range(len(forms), len(patterns))).where(~fine).select("rk", "kind_no", "start", "found", F.explode(rest).alias("r")) \
        .select("rk", "kind_no", "found", (F.col("start") + F.col("r.at")).alias("start"), F.col("r.piece").alias("piece")) \
        .select("rk", "kind_no", "start", F.explode(spans).alias("s")) \
        .select("rk", "kind_no", (F.col("start") + F.col("s.low")).alias("low"), (F.col("start") + F.col("s.high")).alias("high"))
    kinds = F.array(*[F.lit(x.kind) for x in (*forms, *classes)])
    return fixed.unionByName(dense).withColumn("kind", F.element_at(kinds, F.col("kind_no") + 1))


def listed(docs: DataFrame, found: DataFrame, forms: tuple[Form, ...] = FORMS) -> DataFrame:
    """Per row of ``docs`` its ``doc_id`` and ``spans``, an array of (low, kind_no, high, kind) in that order; empty without any.

    The spans of one document are gathered in one place; they are bounded by its text.
    """
    each = found.groupBy("rk").agg(F.array_sort(F.collect_list(F.struct("low", "kind_no", "high", "kind"))).alias("spans"))
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk"))
    empty = F.array().cast("array<struct<low:bigint,kind_no:int,high:bigint,kind:string>>")
    return keyed.join(each, "rk", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))
