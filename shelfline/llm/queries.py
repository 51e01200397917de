"""The registered queries of the operators, and SQL counterparts where SQL can state them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import (
    byte_bpe, exact_dedup, lexical, mixing, near_dup, quality, secrets, spelling, stream_bpe, suffix_dedup, token_counts,
    warc, wrappers,
)
from shelfline.llm.common import table
from shelfline.session import materialize

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
MERGE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
TOKEN_LIMIT = 4096


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    search = suffix_dedup.RepeatedStrings(table(spark, folder, "documents"), depth=200)
    rows = search.mark().select(
        "doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    try:
        return materialize(rows)
    finally:
        search.close()


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = byte_bpe.decode(byte_bpe.encode(docs, RANK_FILE, PATTERN), RANK_FILE, PATTERN)
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = _fresh("digest_index")
    decisions = exact_dedup.deduplicate(table(spark, folder, "documents"), index, batch="first")
    exact_dedup.drop_index(spark, index)
    return decisions.drop("n_chars")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op6_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), words_in_shingle=3, percent=85)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = _fresh("archive")
    warc.write_archive(table(spark, folder, "pages"), archive, min_revisit_bytes=0)
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), PIECE_FILE, budgets=(TOKEN_LIMIT,))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).drop("text")


def op11_stream_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = stream_bpe.decode(stream_bpe.encode(docs, MERGE_FILE).drop("text"), MERGE_FILE)
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_mixing, op2_suffix_dedup, op3_byte_bpe, op4_exact_dedup, op5_secret_scan, op6_near_dup, op7_warc,
        op8_html_extraction, op9_token_counts, op10_quality_rules, op11_stream_bpe,
        op12_lexical_search, op13_spelling_variants,
    )
}

ORACLES: dict[str, str] = {
    "op1_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS weight
  FROM sized GROUP BY source
), held AS (
  SELECT *, 3 * source_size AS most,
         COALESCE(sum(3 * source_size) OVER before, 0) AS held, COALESCE(sum(weight) OVER before, 0) AS held_weight,
         sum(source_size) OVER () AS everything, sum(weight) OVER () AS all_weight
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source IS NULL, encode(source)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
  SELECT *, CAST(everything - held AS DOUBLE) / CAST(all_weight - held_weight AS DOUBLE) AS level FROM held
), targets AS (
  SELECT source, source_size,
         CASE WHEN most <= level * weight THEN CAST(most AS DOUBLE)
              ELSE (SELECT arg_min(level, held_weight) FROM levelled WHERE NOT most <= level * weight) * weight END AS target
  FROM levelled
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) - 1 AS place,
         CAST(CAST('0x' || substr(sha256('17:' || COALESCE('=' || d.source, 'null')), 1, 12) AS BIGINT) AS DOUBLE)
           / 281474976710656 AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, least(CAST(floor(rate * (place + 1) + start) - floor(rate * place + start) AS BIGINT), 3) AS copies FROM placed
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM taken""",
    "op4_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, length(COALESCE(text, '')) AS n,
         sha256(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), placed AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place
  FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM placed""",
    "op6_near_dup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), named AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, COALESCE(s.n, 0) AS n_shingles, COALESCE(c.component_id, d.doc_id) AS component_id,
       COALESCE(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN named c ON c.doc_id = d.doc_id""",
    "op7_warc": r"""
WITH payloads AS (
  SELECT page_id, encode(COALESCE(html, '')) AS payload FROM pages
), hashed AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM payloads
), digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(
           [15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST((CAST('0x' || substr(hex, 1 + 5 * i, 5) AS BIGINT) >> s) & 31 AS INTEGER), 1)), '')), '') AS payload_digest
  FROM hashed
), placed AS (
  SELECT *, first_value(page_id) OVER same AS first_id, row_number() OVER same AS place
  FROM digests WINDOW same AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM placed""",
    "op12_lexical_search": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), found AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM texts
), tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM found GROUP BY ALL
), df AS (SELECT t, count(*) AS df FROM tf GROUP BY t
), total AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM texts
), asked AS (
  SELECT DISTINCT i, item_id, t FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
), scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN df USING (t) JOIN tf USING (t), total GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50""",
    "op13_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), told AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, 1 + octet_length(encode(doc_id || ':' || run))),
      lambda i: CAST('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i - 1, 2) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM told
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY ALL HAVING length(word) >= 6 AND sum(n) >= 5
), cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS k, left(word, k - 1) || substr(word, k + 1) AS rest FROM words
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, encode(near))) AS form, max(n) AS form_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, COALESCE(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS at, form AS ahead FROM formed
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN formed f ON f.word = k.ahead
)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk k ON k.word = f.word AND k.ahead IS NULL""",
}
