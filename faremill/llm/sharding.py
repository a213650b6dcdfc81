"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows are shuffled by a seeded hash within their source and ranked 1..n; rank k of n stands at the
fraction (k - 1/2) / n. In the order of fractions (ties: source, null last) every run of rows has
each source's share, so cutting the order into equal runs gives shards whose row counts differ by
at most one, and whose rows of a source differ by about one.

Ranks need no large window: a source's hash range is cut into buckets of about ``bucket_rows``
rows, and so is the range of fractions; ranks are bucket offsets plus a row number in the bucket.

Defined cases: null text has size 8 and the checksum of the empty text; a null source is a source
of its own; null or repeated ids are ordered by checksum and size, and rows equal in all of these
are interchangeable; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from faremill.llm import common

OVERHEAD = 8  # bytes a stored row takes besides its text


def _offsets(counts: DataFrame, order: str, *within: str) -> DataFrame:
    """Rows in the buckets before each bucket; at most one row per bucket comes in."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def shard(df: DataFrame, shards: int = 24, seed: int = 7, key: str = "doc_id",
          text: str = "text", source: str = "source", bucket_rows: int = 4_000) -> DataFrame:
    """(key, source, size, text_crc32, shard, slot) for every row of ``df``."""
    body = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(body)
    rows = common.stored(df.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        common.source_key(F.col(source)).alias("stratum"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), crc.alias("crc"),
        common.seeded_hash(seed, F.col(key), crc).alias("h")), "shard-rows")
    strata = common.stored(rows.groupBy("stratum").agg(F.count("*").alias("n")), "shard-strata")
    total = strata.agg(F.sum("n")).first()[0] or 0
    fine = common.hash_bucket(F.col("h"), F.ceil(F.col("n") / bucket_rows))
    placed = rows.join(common.small_side(strata), "stratum").withColumn("bucket", fine)
    offsets = _offsets(placed.groupBy("stratum", "bucket").agg(F.count("*").alias("rows")),
                       "bucket", "stratum").select("stratum", "bucket", "before")
    own = Window.partitionBy("stratum", "bucket").orderBy("h", "key", "crc", "size")
    rank = F.col("before") + F.col("own")
    coarse = max(1, -(-total // bucket_rows))
    ranked = common.stored(
        placed.withColumn("own", F.row_number().over(own))
        .join(offsets, ["stratum", "bucket"])
        .withColumn("at", (2 * rank - 1) / (2 * F.col("n")))
        .withColumn("run", F.floor(F.col("at") * coarse).cast("long"))
        .select("key", "source", "stratum", "size", "crc", "at", "run"), "shard-ranked")
    runs = _offsets(ranked.groupBy("run").agg(F.count("*").alias("rows")), "run")
    in_run = Window.partitionBy("run").orderBy("at", "stratum")
    n, place = F.lit(total), F.col("place")
    return (ranked.withColumn("own", F.row_number().over(in_run))
            .join(runs.select("run", "before"), "run")
            .withColumn("place", F.col("before") + F.col("own") - 1)
            .withColumn("shard", F.expr(f"place * {shards} div {max(total, 1)}").cast("int"))
            .withColumn("slot", place - F.floor((F.col("shard") * n + (shards - 1)) / shards))
            .select(F.col("key").alias(key), F.col("source").alias(source), "size",
                    F.col("crc").alias("text_crc32"), "shard",
                    F.col("slot").cast("long").alias("slot")))


def query(spark, sf_dir: str) -> DataFrame:
    return shard(common.documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


# DuckDB has no CRC-32, so the SQL builds its table by the polynomial and folds each text's bytes.
SQL = """
WITH RECURSIVE step(i, c, k) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
crc AS (
  SELECT doc_id, source, body, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(range(1, octet_length(encode(body)) + 1),
               lambda i: ('0x' || substr(hex(encode(body)), 2 * i - 1, 2))::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
  FROM (SELECT doc_id, source, coalesce(text, '') AS body FROM documents), crc_table),
ranked AS (
  SELECT *, octet_length(encode(body)) + 8 AS size,
    row_number() OVER (PARTITION BY source ORDER BY
      ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null') || ':' || text_crc32), 1, 15)
      )::BIGINT, doc_id, text_crc32, octet_length(encode(body))) AS k,
    count(*) OVER (PARTITION BY source) AS n FROM crc),
placed AS (
  SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY
      (2 * k - 1)::DOUBLE / (2 * n)::DOUBLE, source NULLS LAST) - 1 AS place FROM ranked),
cut AS (SELECT *, place * 24 // total AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard::INT AS shard,
  (place - (shard * total + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM cut
"""
