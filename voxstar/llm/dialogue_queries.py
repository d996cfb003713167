"""Registered queries of the operators on conversations and on the vocabulary, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxstar.llm import chat, turns, variants


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The conversation added to the table: both texts hold marks of common templates.
TRICKY_ID, TRICKY = -7, r"\### Assistant: </turn> ok"


def op11_format_chats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(F.lit(TRICKY_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    made = chat.format_conversations(rows.unionByName(tricky))
    read = made.select("conv_id", "formatted", "n_blocks", chat.read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(chat.read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "n_blocks")


OP11_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(t)),
ordered AS (
  SELECT *, row_number() OVER w AS i, (lag(role) OVER w IS DISTINCT FROM role)::INT AS opens,
         regexp_replace(text, '(\\*(?:### |<next/>|</turn>))', '\\\1', 'g') AS escaped
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + CASE opens WHEN 1 THEN length('### ' || role) + 1 + 9 ELSE 9 END)::BIGINT AS formatted_chars,
       sum(opens)::BIGINT AS n_blocks
FROM ordered GROUP BY conv_id
"""


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    at = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    cut = (at % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    found = variants.runs(docs, least=6).select(F.when(at % 199 == 0, slipped).otherwise(F.col("run")).alias("word"))
    words = found.where(F.length("word") >= 6).groupBy("word").agg(F.count("*").alias("n")).where("n >= 5")
    return variants.spelling_variants(words)


#: crc32 in SQL: its table of 256 entries by rule, and the checksum of the bytes that ``k`` has in hexadecimal.
_CRC = r"""crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b)))"""
_CRC_OF_K = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(k), 2), lambda i: ('0x' || k[i + 1:i + 2])::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

OP12_SQL = rf"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
each AS (SELECT doc, run, count(*) AS c, hex(encode(doc || ':' || run)) AS k FROM runs WHERE length(run) >= 6 GROUP BY doc, run),
hit AS (SELECT run, c, {_CRC_OF_K} AS h FROM each, crc),
results AS (SELECT c, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hit),
words AS (SELECT word, sum(c)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (SELECT DISTINCT word, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) t(i)),
near AS (SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT c.word, rest FROM cuts c JOIN words w ON w.word = rest UNION SELECT rest, c.word FROM cuts c JOIN words w ON w.word = rest),
best AS (SELECT a, count(*) AS n_near, arg_min(struct_pack(b, n), struct_pack(m := -n, b)) AS top FROM near JOIN words w ON w.word = b
         JOIN (SELECT word AS a FROM words) USING (a) GROUP BY a),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top.n >= 5 * words.n THEN top.b END AS form,
                 CASE WHEN top.n >= 5 * words.n THEN top.n END AS form_n FROM words LEFT JOIN best ON a = word),
chain AS (SELECT word, word AS root, 0 AS d FROM words UNION ALL SELECT c.word, f.form, d + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM forms JOIN (SELECT word, arg_max(root, d) AS root FROM chain GROUP BY word) USING (word)
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fault in one row of four: by a checksum of its place a row goes, is emptied, loses its full stops, stands twice
    or is the user's. Rows that went stay with ``present`` false."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return (rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), hit.alias("hit"))
            .select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    (F.col("hit") != 0).alias("present"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy")))


def op13_repair_turns(spark: SparkSession, folder: str) -> DataFrame:
    mended = turns.repair(damaged(table(spark, folder, "conversations")), present="present")
    said = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return mended.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(said, 256).alias("repaired_sha256"))


def _edit(letter: str, cost: str, after: str) -> str:
    return f"lpad((left({after}, 9)::INT + {cost})::VARCHAR, 9, '0') || '{letter}' || {after}[10:]"


def _place(own: str, onward: str, keep: str) -> str:
    """The least of deleting, re-labelling and keeping a row, as nine digits of cost and the edits."""
    return (f"least({_edit('D', '2', own)}, CASE WHEN sym <> 'x' THEN {_edit('R', '1 + more', onward)} END, "
            + f"CASE {keep} END)")


_KEEP_U = f"lower(sym) WHEN 'u' THEN {_edit('K', 'more', 'u')}"
_KEEP_A = f"lower(sym) WHEN 'a' THEN {_edit('K', 'more', 'a')}"

OP13_SQL = rf"""
WITH RECURSIVE {_CRC},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS k FROM conversations),
hit AS (SELECT *, {_CRC_OF_K} % 20 AS h FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) r(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
         CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS letter,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
marked AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(letter) ELSE letter END AS sym,
                  CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM judged),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) AS n_rows,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
walk AS (
  SELECT conv_id, n_rows + 1 AS i, '000000000' AS e, '000000010II' AS s, '000000005I' AS u, '000000000' AS a FROM counted
  UNION ALL
  SELECT conv_id, i, least(e, {_edit('I', '5', 'u1')}), least(s, {_edit('I', '5', 'u1')}), u1, least(a, {_edit('I', '5', 'u')})
  FROM (SELECT *, least(u, {_edit('I', '5', 'a')}) AS u1 FROM (
    SELECT conv_id, m.i, {_place('e', 'u', _KEEP_U + f" WHEN 's' THEN {_edit('K', 'more', 's')}")} AS e, {_place('s', 'u', _KEEP_U)} AS s,
           {_place('u', 'a', _KEEP_A)} AS u, {_place('a', 'u', _KEEP_U)} AS a
    FROM walk JOIN (SELECT conv_id, i, sym, more FROM marked) m USING (conv_id) WHERE m.i = walk.i - 1))),
scripts AS (SELECT conv_id, left(e, 9)::BIGINT AS cost, e[10:] AS audit FROM walk WHERE i = 1),
letters AS (SELECT conv_id, j, audit[j] AS edit, length(replace(audit[:j], 'I', '')) AS i
            FROM scripts, unnest(range(1, length(audit) + 1)) r(j)),
kept AS (SELECT l.conv_id, j, edit, CASE WHEN edit <> 'I' THEN m.text ELSE '' END AS text, m.role, lower(m.sym) AS sym,
                row_number() OVER (PARTITION BY l.conv_id ORDER BY j) AS o
         FROM letters l LEFT JOIN marked m ON m.conv_id = l.conv_id AND m.i = l.i WHERE edit <> 'D'),
led AS (SELECT *, max((o = 1 AND edit = 'K' AND sym = 's')::INT) OVER (PARTITION BY conv_id) AS lead FROM kept),
repaired AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                        chr(10) ORDER BY j) AS said FROM led GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counted USING (conv_id) LEFT JOIN scripts USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

QUERIES = {
    "op11_format_chats": (op11_format_chats, OP11_SQL),
    "op12_spelling_variants": (op12_spelling_variants, OP12_SQL),
    "op13_repair_turns": (op13_repair_turns, OP13_SQL),
}
