"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.llm import (ann, byte_bpe, centroids, chat, decontaminate, langid, licences, ngram_join, quality, spelling,
                           token_counts, toxicity, warc)
from tidyspark.llm.common import crc_mod, table
from tidyspark.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    out, name = toxicity.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), F.col(f"{name}.*"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages. A page's path is that of its url; a document's is made of its source, language and id."""
    none = F.lit(None).cast("long")
    path = F.concat_ws("/", F.lit(""), F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                       F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", none.alias("page_id")).alias("id"), "text",
                                                    path.alias("path"))
    place = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "/web/")
    pages = table(spark, sf_dir, "pages").select(
        F.struct(none.alias("doc_id"), "page_id").alias("id"), F.regexp_replace("html", "<[^>]*>", "\n").alias("text"),
        place.alias("path"))
    return (licences.licences(docs.unionByName(pages), F.col("path"), id_col="id")
            .select("id.*", "licence", "score", "how", "from_directory"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = langid.train(docs, ~held_out, public_tokenizers.path("piece_bpe_32k.model"))
    out, name = langid.predict(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), F.col(f"{name}.*"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.plan_records(pages), path)
    # archives just written have no gaps: one would mean a lost page, and ends the job
    lost = F.raise_error(F.concat(F.lit("gap in an archive just written: "), "reason"))
    return (warc.read_archives(spark, path, with_payload=False)
            .select(F.when(F.col("kind") == "record", F.col("record_id")).otherwise(lost.cast("long")).alias("page_id"),
                    "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     r AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM r)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM m
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


OP9_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT conv_id, count(*) AS n_turns,
                  list(role || chr(31) || text ORDER BY turn NULLS FIRST, role, sha256(text)) AS turns,
                  string_agg('<|im_start|>' || role || chr(10) || replace(text, '<|im_', '< |im_')
                             || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text)) AS rendered
           FROM t GROUP BY conv_id),
     p AS (SELECT DISTINCT i AS n_turns, md5(array_to_string(turns[1:i], chr(30))) AS prefix
           FROM (SELECT turns, n_turns, unnest(range(1, n_turns)) AS i FROM c)),
     w AS (SELECT min(conv_id) AS conv_id, n_turns, any_value(rendered) AS rendered, count(*) AS n_copies,
                  md5(array_to_string(turns, chr(30))) AS prefix
           FROM c GROUP BY turns, n_turns)
SELECT conv_id, CAST(0 AS BIGINT) AS part, n_turns, n_copies, rendered
FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n_turns = w.n_turns AND p.prefix = w.prefix)
"""


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                       public_tokenizers.PATTERN, ["doc_id"])


def misspelt(doc_id: str, run: str) -> str:
    """One in 199 runs of a document loses a letter, chosen by a checksum."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 199:
        return run
    cut = h % len(run)
    return run[:cut] + run[cut + 1:]


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), alter=misspelt)
    return spelling.variant_groups(words)


# The checksum is computed byte by byte from its polynomial; near words are found by equal rests after one
# letter is taken away, not by bitsets.
OP11_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          i) ORDER BY i) AS steps
  FROM range(256) AS t(i)),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[a-z\u00C0-\u00FF]+')) AS run
        FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n,
         xor(list_reduce(flatten(list_transform(string_split(doc_id || ':' || run, ''),
                                                lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                                                               ELSE [195::BIGINT, unicode(c) - 64] END)),
                         lambda c, b: xor(c >> 8, steps[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
  FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
rests AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM rests a JOIN rests b
  ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, {'n': -other_n, 'w': other}) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
path AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT p.word, f.form FROM path p JOIN forms f ON p.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, p.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN path p ON p.word = f.word JOIN forms e ON e.word = p.at AND e.form IS NULL
"""


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def _op12_sql(rounds: int = 10) -> str:
    """Plain rounds without bounds, one after the other, over components as rows."""
    steps = ["""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (
  SELECT r, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, unnest(range(1, 65)) AS i FROM kept)),
firsts AS (
  SELECT r, CAST(row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) - 1
                 AS INTEGER) AS c
  FROM kept QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, i, x AS y FROM firsts JOIN parts USING (r))"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, arg_min(c, {{'d': d, 'c': c}}) AS c, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT r, c, sum((x - y) * (x - y)) AS d FROM parts JOIN c{n} USING (i) GROUP BY r, c) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
s{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN parts USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN y ELSE CAST((s - (s % n + n) % n) // n AS BIGINT) END AS y
  FROM c{n} LEFT JOIN s{n} USING (c, i))""")
    return "WITH" + ",".join(steps) + f"""
SELECT k.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM kept k JOIN a{rounds} a USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h
ON h.c = a.c
"""


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    out, name = quality.score(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), F.col(f"{name}.*"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_licences": op2_licences,
    "op3_language": op3_language,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_ngram_join": op6_ngram_join,
    "op7_token_counts": op7_token_counts,
    "op8_nearest": op8_nearest,
    "op9_chat": op9_chat,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling": op11_spelling,
    "op12_centroids": op12_centroids,
    "op13_quality": op13_quality,
}
ORACLE = {"op4_warc": OP4_SQL, "op9_chat": OP9_SQL, "op11_spelling": OP11_SQL,
          "op12_centroids": _op12_sql()}
