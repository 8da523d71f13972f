"""The registered queries of the text operators and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    alignment, bitplanes, chat, contamination, language, licenses, near_dup, neighbours, passages, pieces,
    quality, simhash, warc,
)
from tickloom.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents")).drop("text_id")


def op3_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no capture times; pages are taken to have been captured a second apart.
    seconds = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)))
    date = F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return warc.archived(table(spark, sf_dir, "pages"), date).drop("position")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match",
        "longest_word", "longest_item", "longest_item_word",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = quality.word_vectors(docs)
    network = quality.fit(docs, table(spark, sf_dir, "labels"), vectors)
    found = quality.scored(docs, network, vectors).select("row.doc_id", "score", "predicted")
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encoded(docs, pieces.vocabulary())
    return found.select("row.doc_id", "n_tokens", "n_bytes", "exact", "tokens")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.formatted(chat.text_parts(rows.unionByName(added))))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identified(docs.select("doc_id", "text"), language.learned(docs))
    found = found.select("row.doc_id", "lang_pred", "score", "rejected")
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"))


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.clustering(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_passages, op3_warc_merge, op4_decontamination, op5_quality,
        op6_near_duplicates, op7_neighbours, op8_sentencepiece, op9_chat_format, op10_language_id,
        op11_simhash, op12_bit_planes, op13_alignment,
    )}


OP3_SQL = """
WITH captures AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), originals AS (
    SELECT payload_digest, min(page_id) AS original FROM captures WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM captures LEFT JOIN originals USING (payload_digest)
"""

OP9_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(
           length('<|im_start|>' || regexp_replace(
               replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'
           ) || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10))
       ) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


OP12_START = """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS number, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
), centroids_0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept WHERE vec_id IS NOT NULL
    ORDER BY c LIMIT 8
)"""

OP12_ASSIGN = """, assigned_{n} AS MATERIALIZED (
    SELECT vec_id, k.v, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(k.v, m.v)]) AS d
    FROM kept k, centroids_{n} m
    QUALIFY row_number() OVER (PARTITION BY number ORDER BY d, c) = 1
)"""

OP12_ROUND = """, means_{n} AS (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
        SELECT c, place, sum(x) AS s, count(*) AS n
        FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM assigned_{last}) GROUP BY c, place
    ) GROUP BY c
), centroids_{n} AS MATERIALIZED (
    SELECT c, coalesce(means_{n}.v, centroids_{last}.v) AS v FROM centroids_{last} LEFT JOIN means_{n} USING (c)
)"""

OP12_END = """
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM assigned_{last} JOIN centroids_{last} m USING (c)
"""


def _op12_sql(rounds: int = bitplanes.ROUNDS) -> str:
    """Every round spelled out."""
    parts = [OP12_START, OP12_ASSIGN.format(n=0)]
    for n in range(1, rounds + 1):
        parts += [OP12_ROUND.format(n=n, last=n - 1), OP12_ASSIGN.format(n=n)]
    return "".join([*parts, OP12_END.format(last=rounds)])


def all_sql() -> dict[str, str]:
    return {"op3_warc_merge": OP3_SQL, "op9_chat_format": OP9_SQL, "op12_bit_planes": _op12_sql()}
