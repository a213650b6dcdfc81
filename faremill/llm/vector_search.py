"""Exact top-k search over a vector-approximation file, for a stated query set.

Vectors are turned into integers. Every dimension's range is cut into 2^bits cells; a vector's
approximation is its cell in each dimension. For a query the cells bound every candidate's inner
product from above and below. In a block, candidates are visited by falling upper bound (the same as
rising lower bound of distance), their exact vectors are read in that order, and reading stops when
the kth best exact score exceeds the next upper bound. Candidates whose upper bound is below the kth
best lower bound are never read.

Queries and candidates meet block by block: candidates are cut into blocks of about ``block_rows``
by hash of their id, queries likewise, and each pair of blocks is one task's work; per query and
block at most k rows leave, and a window keeps the best k of them.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null
id, take no part; a shorter vector, also an empty one, counts as padded with zeros; of several rows with a query's
id the smallest vector is the query, and none of them is its candidate; other rows with equal ids
are candidates of their own; ties go to the smaller id; an empty table gives no rows; other columns
are ignored. Scores are exact while they fit a long."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from faremill.llm import common


def integers(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, v) of the rows that take part, v an array of longs."""
    values = F.col(vector)
    good = F.forall(values, lambda x: common.finite(x.cast("double")))
    return (df.filter(F.col(key).isNotNull() & values.isNotNull())
            .filter(F.coalesce(good, F.lit(False)))
            .select(F.col(key).alias("key"), F.transform(
                values, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v")))


def ranges(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Least and greatest value of each dimension; one row a dimension reaches the driver."""
    def local(batches):
        low: dict[int, int] = {}
        high: dict[int, int] = {}
        for batch in batches:
            for values in batch.column(0).to_numpy(zero_copy_only=False):
                for d, x in enumerate(values.tolist()):
                    if x < low.get(d, x + 1):
                        low[d] = x
                    if x > high.get(d, x - 1):
                        high[d] = x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int32()), pa.array(list(low.values()), pa.int64()),
             pa.array([high[d] for d in low], pa.int64())], names=["d", "low", "high"])

    found = (rows.select("v").mapInArrow(local, "d int, low long, high long")
             .groupBy("d").agg(F.min("low"), F.max("high")).collect())
    # zero is in every range, as short vectors are padded with it; empty ones have one dimension
    return {d: (min(0, low), max(0, high)) for d, low, high in found} or {0: (0, 0)}


class Cells:
    """The grid: integer cell borders of every dimension."""

    def __init__(self, spans: dict[int, tuple[int, int]], bits: int):
        self.low = np.array([spans[d][0] for d in range(len(spans))], np.int64)
        self.width = np.array([spans[d][1] for d in range(len(spans))], np.int64) - self.low + 1
        self.count = 1 << bits

    def of(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.low) * self.count // self.width).astype(np.uint8)

    def middles(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width of the integers that each cell holds."""
        c = cells.astype(np.int64)
        first = -(-c * self.width // self.count)
        last = -(-(c + 1) * self.width // self.count) - 1
        return self.low + (first + last) / 2, (last - first) / 2


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes),
        np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def block_search(ids, vectors, query_ids, queries, cells: Cells, k: int, step: int = 64):
    """(query_id, vec_id, score) of the best k candidates of each query in one block."""
    middle, half = cells.middles(cells.of(vectors))
    for start in range(0, len(queries), 256):
        some = queries[start:start + 256]
        about = some @ middle.T
        slack = np.abs(some) @ half.T + 1e-6 * np.abs(about) + 1e-6  # also covers rounding
        for q, own, mid, off in zip(some, query_ids[start:start + 256], about, slack):
            other = ids != own
            upper = np.where(other, mid + off, -np.inf)
            places = min(k, int(other.sum()))
            if not places:
                continue
            lower = np.where(other, mid - off, -np.inf)
            sure = np.partition(lower, len(lower) - places)[len(lower) - places]
            order = np.flatnonzero(other & (upper >= sure))
            order = order[np.argsort(-upper[order], kind="stable")]
            best_ids, best = np.empty(0, ids.dtype), np.empty(0, np.int64)
            for at in range(0, len(order), step):
                if len(best) >= places and best[places - 1] > upper[order[at]]:
                    break
                read = order[at:at + step]
                best = np.concatenate([best, vectors[read] @ q])
                best_ids = np.concatenate([best_ids, ids[read]])
                keep = np.lexsort((best_ids, -best))[:places]
                best, best_ids = best[keep], best_ids[keep]
            yield own, best_ids, best


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20,
           k: int = 20, scale: int = 64, bits: int = 5, block_rows: int = 8192,
           query_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row with key % every = 0."""
    kind = df.schema[key].dataType.simpleString()
    rows = common.stored(integers(df, key, vector, scale), "search-vectors")
    spans = ranges(rows)
    cells = Cells(spans, bits)
    asked = rows.filter(F.col("key") % every == 0).groupBy("key").agg(F.min("v").alias("v"))
    cuts = max(1, -(-rows.count() // block_rows))
    query_cuts = max(1, -(-asked.count() // query_rows))

    def blocks(n):
        return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")

    def every_block(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select("*", blocks(cuts).alias("c"), every_block(query_cuts).alias("q"))
    queries = asked.select("*", blocks(query_cuts).alias("q"), every_block(cuts).alias("c"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            found = list(block_search(
                left.column("key").to_numpy(), _matrix(left.column("v"), len(spans)),
                right.column("key").to_numpy(), _matrix(right.column("v"), len(spans)), cells, k))
        ids, hits, scores = zip(*found) if found else ((), (), ())
        return pa.table([
            pa.array(np.repeat(np.array(ids, np.int64), [len(h) for h in hits]), pa.int64()),
            pa.array(np.concatenate(hits) if hits else [], pa.int64()),
            pa.array(np.concatenate(scores) if scores else [], pa.int64())],
            names=["query_id", "vec_id", "score"])

    found = (candidates.groupBy("c", "q").cogroup(queries.groupBy("c", "q"))
             .applyInArrow(meet, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select(F.col("query_id").cast(kind).alias("query_id"), "rank",
                    F.col("vec_id").cast(kind).alias("vec_id"), "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH vectors AS (
  SELECT vec_id, list_resize(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)),
    (SELECT greatest(1, max(len(embedding))) FROM embeddings), 0) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.v, c.v)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.vec_id
      ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
