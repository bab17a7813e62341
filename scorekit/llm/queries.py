"""The registered queries of this package: each applies its operator with production parameters to its
whole table and returns the columns of its contract; SQL stands next to those that it can express."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm import (decontam, langid, mixing, quality, repair, sharding, simhash, spelling, tokencounts, tokens, topk, urls, warc)
from scorekit.llm.common import held_out, load, python_workers, shared_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SHARDS = 24
KEEP = 0.3  # score from which a document is predicted to be good

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


class Query(NamedTuple):
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def training_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of documents that are not held out."""
    return load(spark, sf, "labels").where(~held_out(F.col("doc_id"), 5, 0))


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    return (warc.archive_pages(load(spark, sf, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op2_topk(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    return topk.search(load(spark, sf, "embeddings"), F.col("id") % 50 == 0, 5)


OP2 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


def op3_tokens(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    contents = tokens.write_token_files(load(spark, sf, "documents"), shared_path(spark, "tokens"), tokenizer_path(), END_ID)
    return (tokens.read_token_files(contents, ids=False)
            .select("doc_id", F.col("first").alias("start"), "n_tokens", "ids_crc32"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    docs = load(spark, sf, "documents")
    model = quality.fit(docs, training_labels(spark, sf))
    found = docs.select("doc_id", quality.scored(model, docs, F.col("text")).alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                        (F.col("score") >= KEEP).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.plan_mix(load(spark, sf, "documents"))
    return plan.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


OP5 = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS digest FROM documents),
placed AS (
  SELECT *, CAST(floor(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || digest), 1, 8)
                            AS BIGINT) / 4294967296.0 * 4096) AS INTEGER) AS bucket FROM docs),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, bucket, doc_id, digest) AS n FROM placed),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM docs GROUP BY source),
limits AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            AS level FROM limits),
targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target,
         CAST('0x' || substr(md5('1|' || coalesce(source, 'null')), 1, 8) AS BIGINT) / 4294967296.0 AS shift FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(n * rate + shift) - floor((n - 1) * rate + shift)) AS BIGINT) AS taken
FROM numbered JOIN rates ON numbered.source IS NOT DISTINCT FROM rates.source"""


def op6_decontam(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    docs = load(spark, sf, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, load(spark, sf, "benchmark"))
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        F.size(c["items"]).cast("long").alias("n_items"),
                        decontam.digest_of_items(c["items"]).alias("items_sha256"),
                        decontam.contaminated(c).alias("contaminated"))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    return simhash.classes(load(spark, sf, "documents")).select(
        F.col("key").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def url_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(URL_RULES, "host string, path string, verdict string")


def op8_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(load(spark, sf, "pages"), url_rules(spark))


OP8 = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)"""


def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    dealt = sharding.assign_shards(load(spark, sf, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op10_langid(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    docs = load(spark, sf, "documents")
    tables = langid.fit(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    found = docs.select("doc_id", langid.predicted(tables, docs, F.col("text")).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "p.lang_pred", "p.score")


# The table of crc32, from its polynomial
CRC_TABLE = """
WITH RECURSIVE bits(b, crc, step) AS (
  SELECT b, CAST(b AS BIGINT), 0 FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT list(crc ORDER BY b) AS entries FROM bits WHERE step = 8),"""


def op11_repair(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    found = repair.summary(repair.repair(repair.damage(load(spark, sf, "conversations"))))
    return found.withColumnsRenamed({"conv": "conv_id", "sha256": "repaired_sha256"})


# States of the role grammar: nothing yet (e), after s (s), after a turn u (u), after a pair (p); each is the cheapest cost in nine
# digits followed by its least audit.
OP11 = CRC_TABLE + r"""
originals AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
                                                                              || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                                                 lambda c: CAST(unicode(c) AS BIGINT))),
             lambda crc, byte: xor(crc >> 8, entries[CAST(xor(crc & 255, byte) + 1 AS INTEGER)])), 4294967295) % 20 AS part
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN part = 1 THEN '' WHEN part = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN part = 3 THEN 2 ELSE 1 END)) AS copy
  FROM originals WHERE part <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS i, left(lag(role) OVER (PARTITION BY conv_id ORDER BY n), 1) || left(role, 1) AS pair,
         CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM numbered),
edits AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faulty),
parse(conv_id, n, e, s, u, p) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000', '400000000', '400000000', '400000000' FROM conversations
  UNION ALL
  SELECT conv_id, n,
         list_min(list_transform([{x: e, k: 2, l: 'D'}], lambda w: printf('%09d', CAST(substr(w.x, 1, 9) AS BIGINT) + w.k) || substr(w.x, 10) || w.l)),
         list_min(list_transform([{x: s, k: 2, l: 'D'}, {x: e, k: CASE WHEN i = 's' AND NOT must THEN extra ELSE 400000000 END, l: 'K'}],
                                 lambda w: printf('%09d', CAST(substr(w.x, 1, 9) AS BIGINT) + w.k) || substr(w.x, 10) || w.l)),
         list_min(list_transform([{x: u, k: 2, l: 'D'}, {x: e, k: ku, l: 'K'}, {x: s, k: ku, l: 'K'}, {x: p, k: ku, l: 'K'}, {x: u, k: ku + 5, l: 'IK'},
             {x: e, k: kr, l: 'R'}, {x: s, k: kr, l: 'R'}, {x: p, k: kr, l: 'R'}, {x: u, k: kr + 5, l: 'IR'}],
                                 lambda w: printf('%09d', CAST(substr(w.x, 1, 9) AS BIGINT) + w.k) || substr(w.x, 10) || w.l)),
         list_min(list_transform([{x: p, k: 2, l: 'D'}, {x: u, k: ka, l: 'K'}, {x: u, k: kr, l: 'R'},
             {x: e, k: ka + 5, l: 'IK'}, {x: s, k: ka + 5, l: 'IK'}, {x: p, k: ka + 5, l: 'IK'},
             {x: e, k: kr + 5, l: 'IR'}, {x: s, k: kr + 5, l: 'IR'}, {x: p, k: kr + 5, l: 'IR'}],
                                 lambda w: printf('%09d', CAST(substr(w.x, 1, 9) AS BIGINT) + w.k) || substr(w.x, 10) || w.l))
  FROM (SELECT parse.conv_id, edits.n, i, must, extra, least(e, '400000000') AS e, least(s, '400000000') AS s, least(u, '400000000') AS u,
               least(p, '400000000') AS p, CASE WHEN i = 'u' AND NOT must THEN extra ELSE 400000000 END AS ku,
               CASE WHEN i = 'a' AND NOT must THEN extra ELSE 400000000 END AS ka, CASE WHEN NOT must THEN 1 + extra ELSE 400000000 END AS kr
        FROM parse JOIN edits ON parse.conv_id IS NOT DISTINCT FROM edits.conv_id AND edits.n = parse.n + 1)),
ends AS (
  SELECT conv_id, list_min([e, p, printf('%09d', CAST(substr(u, 1, 9) AS BIGINT) + 5) || substr(u, 10) || 'I',
                            printf('%09d', CAST(substr(s, 1, 9) AS BIGINT) + 10) || substr(s, 10) || 'II']) AS best
  FROM parse QUALIFY n = max(n) OVER (PARTITION BY conv_id)),
moves AS (  -- one row per edit that leaves a turn; the audit's k-th letter that is no insertion edits the k-th row
  SELECT conv_id, pos, substr(audit, pos, 1) AS move, pos - length(regexp_replace(substr(audit, 1, pos), '[^I]', '', 'g')) AS n
  FROM (SELECT conv_id, substr(best, 10) AS audit, unnest(range(1, length(best) - 8)) AS pos FROM ends)),
turns AS (
  SELECT m.conv_id, pos, move, role, text, row_number() OVER (PARTITION BY m.conv_id ORDER BY pos) AS place
  FROM moves m LEFT JOIN edits d ON m.conv_id IS NOT DISTINCT FROM d.conv_id AND m.n = d.n WHERE move <> 'D'),
begun AS (SELECT *, CAST(first_value(move = 'K' AND role LIKE 's%') OVER (PARTITION BY conv_id ORDER BY pos) AS INTEGER) AS shift FROM turns),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN move = 'K' THEN role WHEN (place - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                             || CASE WHEN move = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS lines
  FROM begun GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(substr(best, 1, 9) AS BIGINT) AS cost,
       substr(best, 10) AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON e.conv_id IS NOT DISTINCT FROM r.conv_id"""


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    return spelling.spelling_variants(spelling.count_words(load(spark, sf, "documents")))


OP12 = CRC_TABLE + r"""
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
in_documents AS (SELECT doc_id, run, count(*) AS n, length(run) AS letters FROM runs GROUP BY doc_id, run HAVING length(run) >= 5),
hashed AS (
  SELECT run, n, letters,
         xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
               lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
             lambda crc, byte: xor(crc >> 8, entries[CAST(xor(crc & 255, byte) + 1 AS INTEGER)])), 4294967295) AS h
  FROM in_documents, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % letters AS INTEGER)) || substr(run, CAST(h % letters AS INTEGER) + 2)
                    ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM gaps),
links AS (
  SELECT a.word, b.word AS near, b.n FROM shorter a JOIN shorter b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON b.word = a.head || a.tail),
ranked AS (
  SELECT word, near, n AS near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM links),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
chains(word, last) AS (
  SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.last AS root FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN roots USING (word)"""


def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    python_workers(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = load(spark, sf, "documents").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        tokencounts.token_count(text, public_tokenizers.path(PIECES)).alias("n_tokens"))
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES = [Query("op1_warc", op1_warc), Query("op2_topk", op2_topk, OP2), Query("op3_tokens", op3_tokens),
           Query("op4_quality", op4_quality), Query("op5_mixing", op5_mixing, OP5), Query("op6_decontam", op6_decontam),
           Query("op7_simhash", op7_simhash), Query("op8_urls", op8_urls, OP8), Query("op9_sharding", op9_sharding),
           Query("op10_langid", op10_langid), Query("op11_repair", op11_repair, OP11), Query("op12_spelling", op12_spelling, OP12), Query("op13_token_counts", op13_token_counts)]
