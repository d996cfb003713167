"""Registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxstar.llm import dialogue_queries, langid, lines, mixing, near, packing, quality, repeats, revisit, search, secrets


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), mixing.words_in("text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secrets.listed(docs, secrets.scan(docs))
    base = F.filter("spans", lambda s: s["kind_no"] < len(secrets.FORMS))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind_no"] == i)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["low"], s["high"])), ",")
    return found.select("doc_id", *[count(i).alias(f"n_{f.kind}") for i, f in enumerate(secrets.FORMS)],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"), width=4).drop("rk", "head")


def op6_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, folder, "documents"), width=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_dedup_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP7_SQL = r"""
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM rows q JOIN rows c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INT AS rank FROM scores) WHERE rank <= 5
"""


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    model = langid.fit(docs, ~F.col("held_out") & F.col("doc_id").isNotNull())
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of the pages: a response each, and a revisit of the same URL by another route some time later.

    Page n is captured n minutes into 2024. Its revisit follows (n mod 5) - 1 hours later, so one in five comes an hour earlier; one in four
    carries another entity tag, one in six none, with a last-modified that one time in three has moved.
    """
    n = F.coalesce(F.col("page_id"), F.lit(0))
    hour = F.lit(3600)
    start = F.lit(1704067200) + n * 60
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    day = lambda shift: F.date_format(F.timestamp_seconds(F.lit(1672531200) + (n % 300 + shift) * 86400), "yyyy-MM-dd")
    full = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.length("html").cast("string"),
                        F.lit("etag"), tag, F.lit("last-modified"), day(F.lit(0)), F.lit("server"), F.lit("s1"))
    changed = F.when(n % 4 == 3, F.concat(F.lit('"x'), n, F.lit('"'))).otherwise(F.concat(F.lit("W/"), tag))
    with_tag = F.create_map(F.lit("etag"), changed, F.lit("content-length"), F.lit("0"), F.lit("age"), (n % 7).cast("string"))
    no_tag = F.create_map(F.lit("last-modified"), day(F.when(n % 3 == 2, 1).otherwise(0)), F.lit("server"), F.lit("s2"))
    again = F.concat(F.lit("HTTPS://www."), F.regexp_replace(F.split("url", "#")[0], "^https?://(www\\.)?", ""))
    pages = pages.withColumn("digest", F.md5(F.coalesce("html", F.lit(""))))
    responses = pages.select(F.concat(F.lit("p"), n).alias("record_id"), "url", F.timestamp_seconds(start).alias("captured"),
                             F.lit("response").alias("kind"), "digest", full.alias("headers"))
    revisits = pages.select(F.concat(F.lit("v"), n).alias("record_id"), again.alias("url"),
                            F.timestamp_seconds(start + (n % 5 - 1) * hour).alias("captured"), F.lit("revisit").alias("kind"),
                            "digest", F.when(n % 6 == 5, no_tag).otherwise(with_tag).alias("headers"))
    return responses.unionByName(revisits)


def op10_resolve_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisit.resolve(captures(table(spark, folder, "pages")))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.select("record_id", "url_key", F.unix_timestamp("captured").alias("captured"), "status", "response_id",
                        F.array_join(fields, "\n").alias("headers"))


OP10_SQL = r"""
WITH pages AS (
  SELECT page_id AS n, url, html, md5(coalesce(html, '')) AS digest, '"' || md5(coalesce(html, ''))[1:16] || '"' AS tag,
         'HTTPS://www.' || regexp_replace(string_split(url, '#')[1], '^https?://(www\.)?', '') AS again FROM pages),
places AS (
  SELECT *, regexp_replace(regexp_replace(trim(u), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS plain
  FROM (SELECT n, digest, tag, html, true AS is_full, 1704067200 + n * 60 AS ts, url AS u FROM pages
        UNION ALL SELECT n, digest, tag, html, false, 1704067200 + n * 60 + (n % 5 - 1) * 3600, again FROM pages)),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(plain, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_extract(plain, '^[^/?]*([^?]*)', 1), '/+$', '') AS page,
         list_sort(list_filter(string_split(regexp_extract(plain, '^[^?]*\?(.*)$', 1), '&'),
                               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS asked FROM places),
captures AS (SELECT *, page || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS url_key FROM keyed),
day AS (SELECT k, strftime(TIMESTAMP '2023-01-01' + to_days(k::INT), '%Y-%m-%d') AS d FROM range(0, 302) t(k)),
matched AS (
  SELECT v.n, v.url_key, v.ts, v.digest, v.tag, max_by(r.n, (r.ts, 'p' || r.n)) AS m
  FROM captures v LEFT JOIN captures r ON r.is_full AND r.url_key = v.url_key AND r.ts < v.ts WHERE NOT v.is_full GROUP BY ALL),
paired AS (
  SELECT x.*, r.tag AS old_tag, length(r.html) AS old_length, a.d AS old_day, b.d AS new_day,
         CASE WHEN x.n % 6 = 5 THEN NULL WHEN x.n % 4 = 3 THEN '"x' || x.n || '"' ELSE x.tag END AS new_tag
  FROM matched x LEFT JOIN pages r ON r.n = x.m LEFT JOIN day a ON a.k = x.m % 300
  LEFT JOIN day b ON b.k = x.n % 300 + CASE WHEN x.n % 3 = 2 THEN 1 ELSE 0 END),
judged AS (
  SELECT *, CASE WHEN m IS NULL THEN 'unresolved' WHEN coalesce(new_tag = old_tag, new_day = old_day) THEN 'resolved' ELSE 'mismatch' END AS status FROM paired)
SELECT 'v' || n AS record_id, url_key, ts AS captured, status, CASE WHEN status = 'resolved' THEN 'p' || m END AS response_id,
       CASE WHEN status <> 'resolved' THEN NULL
            WHEN n % 6 = 5 THEN concat_ws(chr(10), 'content-length: ' || old_length, 'content-type: text/html', 'etag: ' || old_tag,
                                          'last-modified: ' || new_day, 'server: s2')
            ELSE concat_ws(chr(10), 'age: ' || n % 7, 'content-length: ' || old_length, 'content-type: text/html', 'etag: W/' || new_tag,
                           'last-modified: ' || old_day, 'server: s1') END AS headers
FROM judged
"""

OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, i AS line_no, l[i] AS line, list_distinct(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS s
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) t(i)),
long AS (SELECT doc_id, line_no, list_sort(s) AS s FROM lines WHERE len(s) >= 1),
sets AS (SELECT s, len(s) AS n, min(struct_pack(doc_id, line_no)) AS first, row_number() OVER () AS id FROM long GROUP BY s),
items AS (SELECT id, n, unnest(s) AS x FROM sets),
often AS (SELECT x, count(*) AS c FROM items GROUP BY x),
ranked AS (SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY c, x) AS r FROM items JOIN often USING (x)),
heads AS (SELECT id, n, x FROM ranked WHERE r <= n - (80 * n + 99) // 100 + 1),
near AS (SELECT DISTINCT a.id AS a, b.id AS b FROM heads a JOIN heads b ON a.x = b.x AND a.id < b.id
         WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
pairs AS (SELECT a.first AS fa, b.first AS fb, a.id AS ia, b.id AS ib, len(list_intersect(a.s, b.s)) AS c, a.n AS na, b.n AS nb
          FROM near JOIN sets a ON near.a = a.id JOIN sets b ON near.b = b.id),
beaten AS (SELECT DISTINCT CASE WHEN fa < fb THEN ib ELSE ia END AS id FROM pairs WHERE 100 * c >= 80 * (na + nb - c)),
gone AS (SELECT doc_id, line_no FROM long JOIN sets ON long.s = sets.s
         WHERE sets.id IN (FROM beaten) OR struct_pack(doc_id, line_no) <> sets.first),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS k FROM lines ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(g, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(k, '')) END AS kept_sha256
FROM documents LEFT JOIN counts USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = r"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
places AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM texts, unnest(range(1, len(w) - 33)) t(i) WHERE len(w) >= 35),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM places) WHERE n > 1),
gone AS (SELECT DISTINCT r, c FROM (SELECT r, unnest(range(i, i + 35)) AS c FROM twice)),
words AS (SELECT r, i, w[i] AS x FROM texts, unnest(range(1, len(w) + 1)) t(i)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS k, count(*) AS n FROM words ANTI JOIN gone ON words.r = gone.r AND words.i = gone.c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

OP2_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                          ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS c
           FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM common WHERE 100 * c >= 80 * (nu + nv - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, v FROM reach JOIN links ON b = u),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = a
"""

OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, ''))[1:13] AS digits FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3)]::DOUBLE AS weight FROM sums),
levels AS (
  SELECT *, max(t) OVER () AS level FROM (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(2.0::DOUBLE * sum(source_size) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS t
    FROM weighed
    WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, encode(source)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight)::DOUBLE AS target,
         CASE WHEN source_size > 0 THEN least(2.0::DOUBLE * source_size, level * weight) / source_size ELSE 0 END AS rate FROM levels)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + (('0x' || digits)::BIGINT::DOUBLE / 4503599627370496.0
                               < rate - floor(rate))::INT))::BIGINT AS taken
FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
"""

OP9_SQL = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
places AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8),
grams AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM places),
twice AS (SELECT r, unnest(list(i)) AS i FROM grams GROUP BY r, g HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT c) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS c FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM texts)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
counts AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
ruled AS (
  SELECT *, [(n_words < 20)::INT, (100 * n_repeat_words > 30 * n_words)::INT, (10 * n_symbols > word_chars)::INT,
             (10 * n_dup_lines > 3 * n_lines)::INT] AS fails FROM counts),
rated AS (SELECT source, k, count(*) AS n, sum(fails[k]) AS f FROM ruled, range(1, 5) t(k) WHERE source IS NOT NULL GROUP BY source, k),
pooled AS (SELECT k, sum(f) / sum(n) AS m FROM rated GROUP BY k),
prior AS (SELECT k, m, sum(n * (f / n - m) ** 2) / sum(n) AS v FROM rated JOIN pooled USING (k) GROUP BY k, m),
shrunk AS (
  SELECT source, (f + m * s) / (n + s) AS rate
  FROM rated JOIN (SELECT k, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6) ELSE 1e6 END AS s FROM prior) USING (k)),
hosts AS (SELECT source, max(rate) > 0.5 AS rejected FROM shrunk GROUP BY source)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (fails[1] + fails[2] > 0) AS base_failed,
       (fails[1] + fails[2] = 0 AND NOT coalesce(rejected, false)) AS kept
FROM ruled LEFT JOIN hosts USING (source)
"""

QUERIES = {
    "op1_secret_scan": (op1_secret_scan, None),
    "op2_near_duplicates": (op2_near_duplicates, OP2_SQL),
    "op3_pack_sequences": (op3_pack_sequences, None),
    "op4_dedup_lines": (op4_dedup_lines, OP4_SQL),
    "op5_mix_sources": (op5_mix_sources, OP5_SQL),
    "op6_remove_repeats": (op6_remove_repeats, OP6_SQL),
    "op7_top_k": (op7_top_k, OP7_SQL),
    "op8_language_id": (op8_language_id, None),
    "op9_quality_rules": (op9_quality_rules, OP9_SQL),
    "op10_resolve_revisits": (op10_resolve_revisits, OP10_SQL),
    **dialogue_queries.QUERIES,
}
