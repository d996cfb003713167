"""Chat formatting, spelling variants and conversation repair against plain versions, on odd and small inputs."""

import itertools
import random
import re
import zlib
from functools import lru_cache

import brute
import pytest
from pyspark.sql import functions as F

from voxstar.llm import chat, dialogue_queries, turns, variants

CHAT = "conv_id long, turn long, role string, text string"


@pytest.fixture
def chats(spark):
    """Rows of (conv_id, turn, role, text), with columns that clash with the operators' own."""

    def make(rows):
        frame = spark.createDataFrame(rows, CHAT).repartition(3)
        for name in ("_conv", "turns", "_turns", "formatted", "loss", "here", "nth", "fault", "symbol", "script", "cost", "blank"):
            frame = frame.selectExpr("*", f"'clash' AS {name}")
        return frame

    return make


#: Nulls in every column, empty and blank texts, ties, repeated rows, other roles, control strings.
ODD = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 2, "assistant", "Hello."),
       (1, None, "user", "First?"), (1, 3, "assistant", None), (1, 4, None, "x"), (2, 0, "assistant", ""), (2, 0, "assistant", ""),
       (None, 5, "user", "no conversation"), (None, None, None, None), (3, 7, "tool", " \t\n"), (3, 9, "sage\nrole", "a\\"),
       (4, 0, "user", "\\### a </turn>\n</turn>\n\\\\<next/>\n<next/>\n### user\n"), (4, 1, "assistant", "</turn>"), (4, 2, "assistant", "\n"),
       (4, 3, "assistant", "\\" * 50), (4, 4, "assistant", "#### ### </turn</turn>日本"), (4, 5, "user", "é" * 200_000 + "</turn>" * 300)]


def by_conversation(rows, missing):
    """(role, text) per conversation in the defined order; ``missing`` stands for null roles and texts."""
    low = lambda v: (v is not None, v or 0)
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((low(turn), missing if role is None else role, missing if text is None else text, turn))
    return {conv: sorted(found, key=lambda r: r[:3]) for conv, found in out.items()}


# --- formatting

def formatted(frame):
    made = chat.format_conversations(frame)
    return {r["conv_id"]: r for r in made.select(
        "*", chat.read_turns(F.col("formatted")).alias("read"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()}


def test_formatted_conversations_read_back(chats):
    got = formatted(chats(ODD))
    want = by_conversation(ODD, "")
    assert got.keys() == want.keys()
    for conv, rows in want.items():
        said = [r[1:3] for r in rows]
        assert [tuple(t) for t in got[conv]["read"]] == said
        assert got[conv]["learned"] == [t for role, t in said if role == "assistant"]
        assert got[conv]["n_blocks"] == len(list(itertools.groupby(said, key=lambda t: t[0])))
        assert got[conv]["formatted"].count("\n</turn>\n") == got[conv]["n_blocks"]


def test_adjacent_turns_of_a_role_form_one_block(chats):
    got = formatted(chats([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]))[1]
    assert got["formatted"] == "### user\na\n<next/>\nb\n</turn>\n### assistant\nc\n</turn>\n"
    assert [got["formatted"][s["start"]:s["end"]] for s in got["loss"]] == ["c"]


def test_long_conversation_keeps_its_places(chats):
    rows = [(1, i, "user" if i % 5 == 0 else "assistant", f"t{i}") for i in range(1500)]
    got = formatted(chats(rows))[1]
    assert got["learned"] == [t for _, _, role, t in rows if role == "assistant"]
    assert [tuple(t) for t in got["read"]] == [r[2:] for r in rows]


def test_no_conversations(chats):
    assert chat.format_conversations(chats(ODD).where("false")).count() == 0
    assert turns.repair(chats(ODD).where("false")).count() == 0


def test_escaping_goes_back():
    rng = random.Random(3)
    from pyspark.sql import SparkSession

    texts = ["".join(rng.choice(["\\", "### ", "#", " ", "</turn>", "<next/>", "<", "a", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    frame = SparkSession.getActiveSession().createDataFrame([(t,) for t in texts], "t string")
    escaped = chat.escape(F.col("t"))
    rows = frame.select("t", escaped.alias("e"), chat.unescape(escaped).alias("back")).collect()
    assert all(r["t"] == r["back"] for r in rows)
    assert not any(re.search(r"(?<!\\)(?:### |<next/>|</turn>)", r["e"]) for r in rows)


# --- spelling variants

def near_pair(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_variants(counts, ratio=5):
    near = {w: [v for v in counts if near_pair(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        top = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def test_one_edit_in_sorted_lists():
    for seed in range(400):
        rng = random.Random(seed)
        words = sorted({"".join(rng.choice("abé"[:rng.choice([2, 3])]) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 40))})
        want = {(i, j) for i, j in itertools.combinations(range(len(words)), 2) if near_pair(words[i], words[j])}
        got = list(variants.one_edit_apart(words))
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("long_list", [20_000, 3])
def test_variants_match_brute_force(spark, monkeypatch, long_list):
    monkeypatch.setattr(variants, "LONG_LIST", long_list)
    rng = random.Random(long_list)
    stems = ["".join(rng.choice("abÿ") for _ in range(rng.randint(6, 11))) for _ in range(60)]
    counts = {}
    for w in stems:
        for _ in range(8):
            at, c = rng.randrange(len(w) + 1), rng.choice("abÿ")
            edited = rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:], w])
            counts[edited] = rng.choice([5, 6, 30, 200, 1500, 1500, 40_000])
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").selectExpr("*", "1 AS form", "2 AS key", "'x' AS low")
    got = sorted(tuple(r) for r in variants.spelling_variants(frame).collect())
    assert got == plain_variants(counts)
    assert any(r[2] != r[1] and r[1] for r in got)


def test_variants_of_odd_words(spark):
    rows = [(None, 7), ("", 9), ("abc", 100), ("abcd", 5), ("abce", 500)]
    got = {r["word"]: tuple(r) for r in variants.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["abcd"] == ("abcd", "abce", "abce", 5, 1, 500)
    assert got[None] == (None, None, None, 7, 0, None) and got["abc"] == ("abc", None, "abc", 100, 0, None)
    assert variants.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_equal_counts_take_the_least_form(spark):
    rows = [("spellung", 5), ("spelling", 50), ("spellang", 50)]
    got = {r["word"]: r for r in variants.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["spellung"]["form"] == "spellang" and got["spellung"]["n_near"] == 2 and got["spelling"]["form"] is None


def test_runs_of_odd_texts(documents, odd_rows):
    got = sorted(r["run"] for r in variants.runs(documents(odd_rows).select("doc_id", "text"), least=2).collect())
    small = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    assert got == sorted(small(w) for _, t, *_ in odd_rows for w in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(w) >= 2)


# --- repair

KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ONWARD = {0: 2, 1: 2, 2: 3, 3: 2}


def plain_script(symbols):
    """Cheapest edits by trying all, up to three inserted turns between rows."""

    @lru_cache(None)
    def go(i, place, inserted):
        found = [(0, "")] if i == len(symbols) and place in (0, 3) else []
        add = lambda cost, letter, rest: found.append((cost + rest[0], letter + rest[1]))
        if inserted < 3:
            add(5, "I", go(i, ONWARD[place], inserted + 1))
        if i < len(symbols):
            s = symbols[i]
            add(2, "D", go(i + 1, place, 0))
            if s != "x":
                add(1 + 5 * s.isupper(), "R", go(i + 1, ONWARD[place], 0))
                if (place, s.lower()) in KEEPS:
                    add(5 * s.isupper(), "K", go(i + 1, KEEPS[place, s.lower()], 0))
        return min(found, default=(10 ** 9, "~"))

    return go(0, 0, 0)


def test_scripts_are_cheapest_and_least():
    for seed in range(1500):
        rng = random.Random(seed)
        symbols = "".join(rng.choice(rng.choice([turns.SYMBOLS, "suaUAx", "ua", "SUA"])) for _ in range(rng.randint(0, 15)))
        assert turns.cheapest(symbols) == plain_script(symbols), symbols


def test_blocks_agree_with_single_steps():
    t = turns.tables()
    for v in range(len(t.vectors)):
        for code in random.Random(v).sample(range(len(turns.SYMBOLS) ** turns.BLOCK), 50):
            at, rise, left = v, 0, code
            for _ in range(turns.BLOCK):
                left, k = divmod(left, len(turns.SYMBOLS))
                rise, at = rise + int(t.rise[at, k]), int(t.step[at, k])
            assert (at, rise) == (t.block[v, code], t.block_rise[v, code])


def plain_repair(rows):
    """Counts, cost, audit and repaired turns of rows (order, role, text, turn)."""
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    seen, faults, symbols = set(), [], ""
    for _, role, text, _ in rows:
        fault = ("blank" if not text.strip(space) else "duplicate" if (role, text) in seen
                 else "truncated" if text.rstrip(space)[-1] not in ".!?" else None)
        seen.add((role, text))
        faults.append(fault)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = plain_script(symbols)
    out, i = [], 0
    for edit in audit:
        if edit == "K":
            out.append(rows[i][1:3])
        elif edit != "D":
            lead = bool(out) and out[0][0][:1] == "s"
            out.append((("user", "assistant")[(len(out) - lead) % 2], rows[i][2] if edit == "R" else ""))
        i += edit != "I"
    numbers = {r[3] for r in rows if r[3] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return [gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, out]


def test_repair_matches_brute_force(chats):
    rng = random.Random(1)
    more = [(100 + c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", "system", "tool", ""]),
             rng.choice(["ok.", "no", "why?", " ", "", "Long one!\n\x0b", "cut off", None]))
            for c in range(40) for t in range(rng.randint(1, 9))]
    rows = ODD + more
    got = {r["conv_id"]: r for r in turns.repair(chats(rows)).collect()}
    want = by_conversation(rows, " ")
    assert got.keys() == want.keys()
    for conv, found in want.items():
        assert [*got[conv]][1:-1] + [[tuple(t) for t in got[conv]["repaired"]]] == plain_repair(found), conv


def test_repair_returns_conversations_without_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a.", False), (2, 0, "user", "a.", True), (2, 1, "user", "b.", None)], CHAT + ", present boolean")
    got = {r["conv_id"]: r for r in turns.repair(frame, present="present").collect()}
    assert [*got[1]][1:] == [0, 0, 0, 0, 0, 0, "", []] and got[2]["audit"] == "D" and got[2]["cost"] == 2


def test_conversations_are_shuffled_once(chats):
    plan = turns.repair(chats(ODD))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_query_matches_brute_force(spark):
    """The whole query, with its damage, on the shared table."""
    folder = "/root/testdata/sf0.001"
    rows = []
    for conv, turn, role, text in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        hit = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        rows += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else hit != 0)
    want = by_conversation(rows, " ")
    for r in dialogue_queries.op13_repair_turns(spark, folder).collect():
        *counts, out = plain_repair(want.get(r["conv_id"], []))
        assert [*r][1:-1] == counts and r["repaired_sha256"] == brute.sha("\n".join(":".join(t) for t in out))
