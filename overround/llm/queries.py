"""Registered queries of the operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from overround.llm import (
    align, ann, bpe, chat, decontaminate, langid, minhash, packing, quality, runs, substring, toxicity, urls,
)
from overround.llm.shared import read_table

#: The block list and permissions of the crawl (fixed values).
RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "dedup.n_words", "dedup.n_removed", F.sha2("dedup.kept_text", 256).alias("kept_sha256"))


def fold(column: str, parts: int) -> Column:
    """crc32 of an id's text modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                 fold("doc_id", 5) == 0)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), RULES)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify_languages(documents, fold("doc_id", 5) == 0).select("doc_id", "language.*")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_toxicity(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  read_table(spark, sf_dir, "labels"), fold("doc_id", 3) == 1)
    return out.select("doc_id", "toxicity.*")


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.gather_turns(read_table(spark, sf_dir, "conversations"))
    return chat.format_preferences(chat.contrast_last_reply(conversations))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.mark_leaks(documents, read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_leaks"),
                      F.array_sort(F.array_distinct("leaks.item_id")).alias("item_ids"), "leaks")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.align_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), groups_as="sha256")
    return out.withColumnRenamed("groups", "groups_sha256")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_texts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def periodic_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text): of each document with h % 10 = 0 (h: crc32 of its id) the words from a on repeat the first p of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(
        F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")))
    placed = chosen.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10")).withColumn(
        "a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.expr("array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, moved).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.periodic_runs(periodic_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Runs come by start, then period, so the first of those with the greatest exponent is the one wanted.
    top = F.expr("""aggregate(runs, cast(null as struct<start: long, length: long, period: long>), (best, r) ->
        if(best is null or r.length * best.period > best.length * r.period, r, best))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = out.select("doc_id", "runs", "collapsed", top.alias("top"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


OP2_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT shared.a, shared.b FROM shared JOIN sizes x ON x.doc_id = shared.a JOIN sizes y ON y.doc_id = shared.b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN component USING (doc_id)
"""

OP3_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM split
), windows AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 19], ' ')) AS k FROM starts
), marked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) > 1 AS later FROM windows
), covered AS (
  SELECT words.doc_id, words.pos, word, max(CASE WHEN later THEN 1 ELSE 0 END) OVER (
    PARTITION BY words.doc_id ORDER BY words.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN marked ON marked.doc_id = words.doc_id AND marked.pos = words.pos
), cut AS (
  SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept
  FROM covered GROUP BY doc_id
)
SELECT split.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN cut USING (doc_id)
"""

OP5_SQL = r"""
WITH RECURSIVE parsed AS (
  SELECT page_id, url, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, url, html,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parsed
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), ruled AS (
  SELECT s.*, (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
    WHERE (s.host = rhost OR suffix(s.host, '.' || rhost)) AND prefix(s.path, rpath)) AS rule,
    CASE WHEN strpos(url, '://') > 0 THEN s.host || regexp_replace(s.path, '/$', '') || coalesce('?' || nullif(
      array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
        lambda f: f <> '' AND NOT regexp_matches(f, '^(utm_[a-z]+|gclid|fbclid|msclkid)(=|$)')), '&'), ''), '') END AS address
  FROM split s
), own AS (
  SELECT r.*, (SELECT verdict FROM rules WHERE rhost || rpath = r.rule) AS verdict FROM ruled r
), links AS (
  SELECT address AS a, unnest(regexp_extract_all(html, '<link[^>]*rel="canonical"[^>]*href="https?://([^"]*)"', 1)) AS b FROM own
), edges AS (
  SELECT a, regexp_replace(b, '/$', '') AS b FROM links UNION SELECT regexp_replace(b, '/$', ''), a FROM links
), reach AS (
  SELECT DISTINCT address AS a, address AS b FROM own WHERE address IS NOT NULL
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), placed AS (
  SELECT a, min(b) AS component FROM reach GROUP BY a
), bad AS (
  SELECT component FROM placed JOIN own ON own.address = placed.a GROUP BY component
  HAVING bool_or(coalesce(verdict = 'block', false)) AND NOT bool_or(coalesce(verdict = 'allow', false))
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(verdict, CASE WHEN placed.component IN (SELECT component FROM bad) THEN 'block' ELSE 'allow' END) AS verdict,
  address, placed.component
FROM own LEFT JOIN placed ON own.address = placed.a
"""

OP9_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, 'user'), text := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), said AS (
  SELECT conv_id, t, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS last,
    list_filter(t, lambda x: x.role = 'assistant') AS s FROM turns
), pair AS (
  SELECT conv_id AS pair_id, t[1:last] AS chosen, t[1:last - 1] || [struct_pack(role := 'assistant', text :=
    CASE WHEN len(s) > 1 AND s[len(s) - 1].text <> s[len(s)].text THEN s[len(s) - 1].text
         ELSE substr(s[len(s)].text, 1, length(s[len(s)].text) // 2) END)] AS rejected
  FROM said WHERE last IS NOT NULL
), cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, len(chosen) + 1), lambda i: chosen[i] <> rejected[i])) - 1, len(chosen)) AS n
  FROM pair
), parts AS (
  SELECT pair_id, n, chosen[1:n] AS p, chosen[n + 1:] AS c, rejected[n + 1:] AS r FROM cut
), texts AS (
  SELECT *, list_transform(p, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS ps,
    list_transform(c, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS cs,
    list_transform(r, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS rs FROM parts
)
SELECT pair_id, n AS prompt_turns, coalesce(array_to_string(ps, ''), '') AS prompt,
  coalesce(array_to_string(cs, ''), '') AS chosen_completion, coalesce(array_to_string(rs, ''), '') AS rejected_completion,
  list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i: struct_pack(
    start := CAST(length(array_to_string(cs[1:i - 1], '')) + 14 AS BIGINT), stop := CAST(length(array_to_string(cs[1:i], '')) AS BIGINT))) AS chosen_mask,
  list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'), lambda i: struct_pack(
    start := CAST(length(array_to_string(rs[1:i - 1], '')) + 14 AS BIGINT), stop := CAST(length(array_to_string(rs[1:i], '')) AS BIGINT))) AS rejected_mask,
  len(list_filter(c, lambda x: x.role = 'assistant')) > 0 AND len(list_filter(r, lambda x: x.role = 'assistant')) > 0 AS informative
FROM texts
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality": op4_quality,
    "op5_url_filters": op5_url_filters,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_preference_format": op9_preference_format,
    "op10_decontaminate": op10_decontaminate,
    "op11_token_alignment": op11_token_alignment,
    "op12_bpe": op12_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op2_minhash_dedup": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op5_url_filters": OP5_SQL,
    "op9_preference_format": OP9_SQL,
}
