"""Inputs that the given tables lack, shaped from them: web captures from ``pages``, a file tree from ``documents``.

They only give rows of the schema that an operator reads, and do none of its work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import read_table

#: Captures of each page.
CAPTURES = 6


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, record_type, target_uri, captured long (seconds), status, headers map, payload_digest): some captures
    of a page carry its body, the others are not-modified revisits; addresses and validators differ now and then."""
    k, page = F.col("k"), F.col("page_id")
    full = (page + k) % 3 == 0
    url = (F.when(k % 3 == 1, F.concat(F.regexp_replace("url", "^http:", "HTTP:"), F.lit("#part")))
           .when(k % 3 == 2, F.regexp_replace("url", "^https:", "http:")).otherwise(F.col("url")))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.concat_ws(":", page, F.floor(k / 4))), 1, 10), F.lit('"'))
    pair = lambda name, value: F.struct(F.lit(name).alias("k"), value.cast("string").alias("v"))
    headers = F.map_from_entries(F.filter(F.array(
        pair("Date", F.col("captured")),
        pair("ETag", F.when((page + k) % 5 > 0, F.when(k % 2 == 1, F.concat(F.lit("W/"), tag)).otherwise(tag))),
        pair("Last-Modified", F.when(page % 4 == 0, F.floor(k / 4))),
        pair("Content-Type", F.when(full, F.lit("text/html")).otherwise(F.lit("text/plain"))),
        pair("Content-Length", F.when(full, F.length("html")).otherwise(F.lit(0))),
        pair("Cache-Control", F.concat(F.lit("max-age="), (k * 60).cast("string")))),
        lambda x: x["v"].isNotNull()))
    return (read_table(spark, sf_dir, "pages").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(CAPTURES - 1))))
            .withColumn("captured", (F.lit(1_700_000_000) + (page * 7919 + k * 86_400 * (1 + page % 5)) % 7_776_000).cast("long"))
            .select((page * CAPTURES + k).alias("record_id"), F.when(full, "response").otherwise("revisit").alias("record_type"),
                    url.alias("target_uri"), "captured", F.when(full, 200).otherwise(304).alias("status"),
                    headers.alias("headers"), F.when(full, F.md5("html")).alias("payload_digest")))


CAPTURES_SQL = r"""
captures AS (
  SELECT page_id * 6 + k AS record_id, page_id, k, html, (page_id + k) % 3 = 0 AS is_full,
         CASE WHEN k % 3 = 1 THEN regexp_replace(url, '^http:', 'HTTP:') || '#part'
              WHEN k % 3 = 2 THEN regexp_replace(url, '^https:', 'http:') ELSE url END AS target_uri,
         (1700000000 + (page_id * 7919 + k * 86400 * (1 + page_id % 5)) % 7776000)::BIGINT AS captured,
         CASE WHEN (page_id + k) % 5 > 0 THEN (CASE WHEN k % 2 = 1 THEN 'W/' ELSE '' END)
              || '"' || md5(page_id::VARCHAR || ':' || (k // 4)::VARCHAR)[1:10] || '"' END AS etag,
         CASE WHEN page_id % 4 = 0 THEN (k // 4)::VARCHAR END AS modified
  FROM pages, range(6) r(k))"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, path, text): every document is a file of its source's tree; some are named as licence files."""
    i = F.col("doc_id")
    folder = F.concat(F.col("source"), F.lit("/d"), i % 211, F.when(i % 3 > 0, F.concat(F.lit("/s"), i % 2)).otherwise(""))
    return read_table(spark, sf_dir, "documents").select(
        i.alias("file_id"), F.concat(folder, F.when(i % 40 == 0, "/LICENSE").otherwise(F.concat(F.lit("/f"), i, F.lit(".txt"))))
        .alias("path"), "text")


FILES_SQL = r"""
files AS (
  SELECT doc_id AS file_id, text, source || '/d' || (doc_id % 211) || (CASE WHEN doc_id % 3 > 0 THEN '/s' || (doc_id % 2) ELSE '' END)
         || (CASE WHEN doc_id % 40 = 0 THEN '/LICENSE' ELSE '/f' || doc_id || '.txt' END) AS path FROM documents)"""
