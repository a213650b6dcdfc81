"""Mixing sources to target weights by systematic sampling.

Sources share a budget of words by weight. A source gets at most ``most`` times its own words; what
it cannot take is shared again by weight. Each document of a source then expects the same number of
copies, target / source words. The documents are put in order of size (classes of about 19 %, then
hash buckets, then size), expected copies are summed along that order, one random offset per source
is added, and a document is emitted once per integer its sum crosses. Copies are thus the expected
number rounded up or down, and the order by size keeps the words taken near the target: they differ
by about the size of the source's largest document at most.

A hot source needs no large window: sums are offsets of buckets of about ``bucket_rows`` documents
plus a row number in the bucket.

Defined cases: null text and text without words have size 0 and take 0; a null source is a source
of its own, last in order; a source without words has target 0; rows with equal id are told apart by
their size, and rows equal in both are interchangeable; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from faremill.llm import common

WEIGHTS = (5, 2, 1)


def size_class(size):
    """Bit length and the two bits after the highest: about four classes per doubling."""
    bits = F.concat(F.bin(size), F.lit("00"))
    return (4 * F.length(bits) + F.when(F.substring(bits, 2, 1) == "1", 2).otherwise(0)
            + F.when(F.substring(bits, 3, 1) == "1", 1).otherwise(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share_percent: int = 150, most: int = 2):
    """Adds weight and target to (stratum, source_size), one row per source.

    A source is cut off at ``most`` times its words if that is below its share of what the sources
    cut off before it leave; in the order of cap per weight this is a prefix. All sums are of
    integers, so a target is one correctly rounded division."""
    by_name = Window.orderBy("stratum")
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when((F.row_number().over(by_name) - 1) % len(weights) == i, w).otherwise(weight)
    everything = Window.partitionBy()
    ascending = Window.orderBy("ratio", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    first_free = F.min(F.when(~F.col("capped"), F.struct(
        "ratio", "stratum", "left", "weights_left"))).over(everything)
    return (sources.withColumn("weight", weight.cast("long"))
            .withColumn("cap", (most * F.col("source_size")).cast("long"))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            # hundredths of words that the sources before leave, and the weights that share them
            .withColumn("left", share_percent * F.sum("source_size").over(everything)
                        - 100 * F.coalesce(F.sum("cap").over(ascending), F.lit(0)))
            .withColumn("weights_left", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(ascending), F.lit(0)))
            .withColumn("capped", 100 * F.col("cap") * F.col("weights_left")
                        < F.col("left") * F.col("weight"))
            .withColumn("free", first_free)
            .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
                (F.col("weight") * F.col("free.left")).cast("double")
                / (100 * F.col("free.weights_left")).cast("double")))
            .select("stratum", "source_size", "weight", "target"))


def sampled(rows: DataFrame, seed: int = 11, bucket_rows: int = 4_000, **shares) -> DataFrame:
    """Adds source_size, target and copies to stored rows (key, stratum, size, h)."""
    rows = rows.withColumn("class", size_class(F.col("size")))
    classes = common.stored(rows.groupBy("stratum", "class").agg(
        F.count("*").alias("n"), F.sum("size").alias("words")), "mix-classes")
    sources = common.stored(targets(classes.groupBy("stratum").agg(
        F.sum("words").alias("source_size")), **shares), "mix-sources")
    placed = (rows.join(common.small_side(classes.select("stratum", "class", "n")),
                        ["stratum", "class"])
              .withColumn("bucket", common.hash_bucket(
                  F.col("h"), F.ceil(F.col("n") / bucket_rows))).drop("n"))
    bucket = ["stratum", "class", "bucket"]
    before = Window.partitionBy("stratum").orderBy("class", "bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(bucket).agg(F.count("*").alias("rows"))
               .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
               .join(common.small_side(sources), "stratum")
               .select(*bucket, "before", "source_size", "target"))
    own = Window.partitionBy(bucket).orderBy("size", "h", "key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = common.seeded_hash(seed, F.col("stratum")) / F.lit(float(1 << 60))
    place = F.col("before") + F.col("own")
    return (placed.withColumn("own", F.row_number().over(own)).join(offsets, bucket)
            .withColumn("rate", rate).withColumn("offset", offset)
            .withColumn("copies", (F.floor(place * F.col("rate") + F.col("offset"))
                                   - F.floor((place - 1) * F.col("rate") + F.col("offset")))
                        .cast("long"))
            .drop("class", "bucket", "own", "before", "rate", "offset"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: int = 11, bucket_rows: int = 4_000, **shares) -> DataFrame:
    """(key, size, source_size, target, taken, copies) for every row of ``df``."""
    rows = common.stored(df.select(
        F.col(key).alias("key"), common.source_key(F.col(source)).alias("stratum"),
        common.word_count(F.col(text)).alias("size"),
        common.seeded_hash(seed, F.col(key)).alias("h")), "mix-rows")
    return sampled(rows, seed, bucket_rows, **shares).select(
        F.col("key").alias(key), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          seed: int = 11, bucket_rows: int = 4_000, **shares) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as its copies say.

    Rows that agree in id, source and text share their copies: all are given to one of them. The id
    itself is part of the name, so texts whose hashes collide stay apart."""
    identity = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")),
                           F.xxhash64(F.col(source), F.col(text)).cast("string"))
    rows = common.stored(df.select(
        F.col(key).alias("key"), identity.alias("identity"),
        common.source_key(F.col(source)).alias("stratum"),
        common.word_count(F.col(text)).alias("size"),
        common.seeded_hash(seed, F.col(key)).alias("h")), "mix-rows")
    copies = (sampled(rows, seed, bucket_rows, **shares).groupBy("identity")
              .agg(F.sum("copies").alias("copies")).filter("copies > 0"))
    first = Window.partitionBy("identity").orderBy("identity")
    return (df.select(common.whole_row(df).alias("row"), identity.alias("identity"))
            .withColumn("at", F.row_number().over(first)).filter("at = 1")
            .join(copies, "identity")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return mix(common.documents(spark, sf_dir)).drop("copies")


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce('0' || source, '1') AS stratum,
    CASE WHEN text IS NULL THEN 0
      ELSE len(regexp_extract_all(text, '[^ 	-
]+')) END::BIGINT AS size FROM documents),
sources AS (
  SELECT stratum, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY stratum) - 1) % 3 + 1]::BIGINT AS weight
  FROM docs GROUP BY stratum),
ordered AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight::DOUBLE AS ratio,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM sources),
shared AS (
  SELECT *, 150 * total - 100 * coalesce(sum(cap) OVER before, 0) AS left_over,
    weights - coalesce(sum(weight) OVER before, 0) AS weights_left FROM ordered
  WINDOW before AS (ORDER BY ratio, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
decided AS (SELECT *, 100 * cap * weights_left < left_over * weight AS capped FROM shared),
free AS (SELECT left_over AS free_left, weights_left AS free_weights FROM decided
         WHERE NOT capped ORDER BY ratio, stratum LIMIT 1),
targets AS (
  SELECT stratum, source_size, CASE WHEN capped THEN cap::DOUBLE
    ELSE (weight * free_left)::DOUBLE / (100 * free_weights)::DOUBLE END AS target
  FROM decided LEFT JOIN free ON true),
classed AS (
  SELECT *, bin(size) || '00' AS bits,
    ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY
      4 * length(bits) + 2 * (substr(bits, 2, 1) = '1')::INT + (substr(bits, 3, 1) = '1')::INT,
      size, h, doc_id) AS place FROM classed),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
    ('0x' || substr(md5('11:' || stratum), 1, 15))::BIGINT::DOUBLE / 1152921504606846976::DOUBLE
      AS off FROM placed JOIN targets USING (stratum))
SELECT doc_id, size, source_size, target,
  ((floor(place::DOUBLE * rate + off) - floor((place - 1)::DOUBLE * rate + off)) * size)::BIGINT
    AS taken
FROM rated
"""
