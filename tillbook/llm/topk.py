"""Exact top-k search (4): columnar branch and bound over integer vectors.

Vectors are scaled to floor(scale * x). Candidates stay in their partitions, in tiles of
``TILE`` vectors kept column by column; queries come in blocks of about ``QUERY_BLOCK`` vectors,
one pass over the candidates each, so only a block of known size is sent to the tasks.

For a query and a tile the inner products grow by ``DIMS`` dimensions at a time, the query's
heaviest dimensions first. What the other dimensions can still add is at most the product of the
two remaining norms (Cauchy-Schwarz). Candidates whose sum and bound stay below the query's
current k-th best score are dropped and the others compacted before the next dimensions are read.
The first k-th best score comes from the block itself: the queries are candidates of each other.

Scores are exact: sums run in float64 while every possible sum is below 2**53, in int64 below
2**63; larger values raise an error. Ties go to the smaller vec_id, and the pruning keeps equal
scores, so they are not lost.

Vectors that are null or hold null or non-finite components take no part. Vectors are compared
with those of their own length. Candidates exclude all rows with the query's vec_id; other repeated
rows count as often as they occur. A query id that occurs several times is asked once, by its
first vector in component order. A null vec_id is neither query nor candidate. Empty tables give
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import keep, table
from tillbook.session import configure

SCALE = 1024
K = 10
EVERY = 100
TILE = 4096
DIMS = 16
QUERY_BLOCK = 4096


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors as integers; v is an array<long>."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0**52 / scale))
    infinite = F.exists(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) >= 2.0**52 / scale)
                        & (F.abs(c.cast("double")) != float("inf")))
    ok = F.when(F.coalesce(infinite, F.lit(False)), F.raise_error(F.lit("components beyond 2**52 have no exact score"))).otherwise(finite)
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ok.cast("boolean")).select(
        "vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact_type(q: np.ndarray, v: np.ndarray) -> type:
    """The type in which no partial sum of q and v can lose a digit."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if top >= 2.0**62:
        raise OverflowError("inner products beyond 64 bits")
    return np.float64 if top < 2.0**53 else np.int64


def _kth(scores: np.ndarray, k: int) -> float:
    return -np.inf if len(scores) < k else float(np.partition(scores, len(scores) - k)[len(scores) - k])


def first_bounds(ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """For each query of a block the k-th best score among the block's other queries."""
    kind, out = _exact_type(q, q), np.empty(len(q))
    for a in range(0, len(q), 512):
        s = (q[a:a + 512].astype(kind) @ q.astype(kind).T).astype(np.float64)
        for i in range(len(s)):
            out[a + i] = _kth(np.delete(s[i], a + i), k)
    return out - 1  # float64 may round a score above 2**53 up


def search_tile(ids: np.ndarray, cols: np.ndarray, q_id: int, q: np.ndarray, bound: float, k: int,
                dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """(vec_ids, scores) of the tile's best k for one query, of scores >= bound; ``cols`` is (dimension, vector)."""
    order = np.argsort(-np.abs(q), kind="stable")
    alive = np.flatnonzero(ids != q_id)
    total = np.zeros(len(alive), cols.dtype)
    rest = np.square(cols.astype(np.float64)).sum(axis=0)[alive]
    q_rest = float(np.square(q.astype(np.float64)).sum())
    for a in range(0, len(order), dims):
        some = order[a:a + dims]
        part = cols[np.ix_(some, alive)]
        total = total + q[some] @ part
        rest = np.maximum(rest - np.square(part.astype(np.float64)).sum(axis=0), 0)
        q_rest = max(q_rest - float(np.square(q[some].astype(np.float64)).sum()), 0)
        slack = np.sqrt(rest * q_rest) * (1 + 1e-9) + 1
        bound = max(bound, _kth(total - slack, k))
        on = total + slack >= bound
        if not on.all():
            alive, total, rest = alive[on], total[on], rest[on]
        if not len(alive):
            break
    best = np.lexsort((ids[alive], -total))[:k]
    return ids[alive[best]], total[best].astype(np.int64)


def _search(q_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, k: int, tile: int, dims: int):
    def run(batches):
        now = bounds.copy()
        best: list[list] = [[] for _ in q_ids]  # at most k (score, id) of this task for each query
        for batch in batches:
            for a in range(0, batch.num_rows, tile):
                part = batch.slice(a, tile)
                v = _matrix(part.column("v"))
                kind = _exact_type(q, v)
                cols, mine = np.ascontiguousarray(v.T).astype(kind), q.astype(kind)
                ids = part.column("vec_id").to_numpy()
                for i, q_id in enumerate(q_ids):
                    got, scores = search_tile(ids, cols, q_id, mine[i], now[i], k, dims)
                    if len(got):
                        best[i] = sorted([*best[i], *zip((-scores).tolist(), got.tolist(), strict=True)])[:k]
                        if len(best[i]) == k:
                            now[i] = max(now[i], -best[i][-1][0])
        rows = [(int(q_ids[i]), c, -s) for i, own in enumerate(best) for s, c in own]
        if rows:
            x = np.array(rows, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, j]) for j in range(3)], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, query_block: int = QUERY_BLOCK,
          tile: int = TILE, dims: int = DIMS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best; ``vectors`` has vec_id and embedding and
    ``is_query`` is a condition on them."""
    spark = configure(vectors.sparkSession)
    usable = scaled(vectors, scale)
    asked = keep(vectors.where(is_query).transform(lambda d: scaled(d, scale)).groupBy("vec_id").agg(F.min("v").alias("v"))
                 .withColumn("length", F.size("v")), "topk-queries")
    out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for row in asked.groupBy("length").count().collect():  # lengths of vectors: one, or a few
        blocks = -(-row["count"] // query_block)
        same = usable.where(F.size("v") == row["length"])
        for b in range(blocks):
            block = asked.where((F.col("length") == row["length"]) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)).toArrow()
            if not block.num_rows:
                continue
            ids, q = block.column("vec_id").to_numpy(), _matrix(block.column("v")).reshape(block.num_rows, row["length"])
            run = _search(ids, q, first_bounds(ids, q, k), k, tile, dims)
            out = out.unionByName(same.mapInArrow(run, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the vectors whose vec_id is divisible by 100 against all embeddings."""
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH ok AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
           row_number() OVER () AS line
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS (
    SELECT vec_id, line, len(v) AS d, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM ok
), scores AS (
    SELECT q.vec_id AS query_id, c.line, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM cells q JOIN cells c ON q.i = c.i AND q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % {EVERY} = 0 GROUP BY ALL
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
