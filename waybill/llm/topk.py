"""Exact top-k inner products by norm order, rotated partial sums and Cauchy-Schwarz bounds.

Vectors are turned into integers and rotated by the singular vectors of a
sample, so that the leading coordinates carry most of each product. Within a
partition, vectors come in order of length, longest first, in blocks. The
product of a query and a vector is at most the partial product of the leading
coordinates plus the product of the lengths of what is left (Cauchy-Schwarz).
Only pairs whose bound reaches the query's k-th best score so far are scored,
in integers; once the lengths alone can't reach it for any query, the rest of
the partition is skipped. Queries start with the k-th best score among the
longest vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import cut, partitions, python_ready, table
from ._repeats import numbers

#: Vectors in the sample that the rotation is fitted on, and longest vectors for the first thresholds. Neither affects results.
SAMPLE = 4096
#: Queries compared at once; more are taken in several rounds of about this many.
QUERY_BLOCK = 16_384
BLOCK = 1024
LONG = np.iinfo(np.int64)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """id, v (array<long>, floor(scale * x) of each component), length; without rows that take no part."""
    x = F.transform(vector_col, lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select("id", F.transform("x", lambda e: F.floor(e * float(scale))).alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))))


def _matrix(rows, dims: int) -> np.ndarray:
    """Vectors as rows of equal length; shorter ones are filled up with zeros."""
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _from_arrow(column: pa.Array, dims: int) -> np.ndarray:
    flat, off = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (off == dims).all():
        return flat.reshape(len(off), dims).astype(np.int64)
    return _matrix(column.to_pylist(), dims)


class Queries:
    """A block of queries with their rotation, and what is known of their k best scores."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, lead: int, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rotation, self.lead = rotation, lead
        z = vectors.astype(np.float64) @ rotation
        self.front, self.rest = z[:, :lead], np.sqrt((z[:, lead:] ** 2).sum(axis=1))
        self.length = np.sqrt((z**2).sum(axis=1))
        self.least = np.full(len(ids), -np.inf)

    def scores(self, q: np.ndarray, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Exact products of queries q and rows ``of`` of x; beyond 64 bits, the nearest number that fits."""
        if not len(q):
            return np.zeros(0, np.int64)
        most = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
        if most < 2**53 and len(q) * 4 > len(x) * len(self.ids):
            return (self.vectors.astype(np.float64) @ x.T.astype(np.float64))[q, of].astype(np.int64)
        if most < 2**62:
            out = np.empty(len(q), np.int64)
            for s in range(0, len(q), 65_536):
                out[s : s + 65_536] = np.einsum("ij,ij->i", self.vectors[q[s : s + 65_536]], x[of[s : s + 65_536]])
            return out
        exact = (sum(int(a) * int(b) for a, b in zip(self.vectors[i], x[j])) for i, j in zip(q, of))
        return np.array([min(max(s, LONG.min), LONG.max) for s in exact], dtype=np.int64)

    def start(self, x: np.ndarray, ids: np.ndarray) -> None:
        """Thresholds a little under the k-th best score among the vectors x."""
        if len(ids) <= self.k:
            return
        x = x.astype(np.float64)
        for s in range(0, len(self.ids), BLOCK):
            score = self.vectors[s : s + BLOCK].astype(np.float64) @ x.T
            score[self.ids[s : s + BLOCK, None] == ids] = -np.inf
            kth = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1]
            slack = 1 + 1e-9 * self.length[s : s + BLOCK] * np.sqrt((x**2).sum(axis=1).max())
            self.least[s : s + BLOCK] = self.held(np.minimum(kth, LONG.max) - slack)

    @staticmethod
    def held(least: np.ndarray) -> np.ndarray:
        """Thresholds at the smallest number that fits exclude nothing."""
        return np.where(least <= LONG.min, -np.inf, least)

    def reach(self, x: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) whose bound reaches the query's threshold."""
        live = np.flatnonzero(self.length * length.max(initial=0) * (1 + 1e-9) >= self.least)
        y = x.astype(np.float64) @ self.rotation
        rest = np.sqrt((y[:, self.lead :] ** 2).sum(axis=1))
        slack = 1e-9 * np.outer(self.length[live], length) + 1e-6
        bound = self.front[live] @ y[:, : self.lead].T + np.outer(self.rest[live], rest) + slack
        q, of = np.nonzero(bound >= self.least[live, None])
        return live[q], of


def best(q: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first k of their query, by score and then smaller id; ordered by query."""
    order = np.lexsort((ids, -score.astype(np.float64), q))
    if len(score) and np.abs(score).max() >= 2**53:
        order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -int(score[i]), ids[i])), dtype=np.int64)
    first = np.flatnonzero(np.append(True, q[order][1:] != q[order][:-1])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < k]


def _search(block, dims: int):
    """Top k of each query within a partition."""

    def run(batches):
        qs: Queries = block.value
        least = qs.least.copy()
        top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        local = Queries.__new__(Queries)
        local.__dict__ |= qs.__dict__ | {"least": least}
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                length = numbers(pa.chunked_array([part.column("length")]))
                # Vectors come longest first.
                if not (local.length * length.max(initial=0) * (1 + 1e-9) >= least).any():
                    continue
                ids, x = numbers(pa.chunked_array([part.column("id")])), _from_arrow(part.column("v"), dims)
                q, of = local.reach(x, length)
                other = ids[of] != local.ids[q]
                q, of = q[other], of[other]
                score = local.scores(q, x, of)
                q, score, ids = np.concatenate([top[0], q]), np.concatenate([top[1], score]), np.concatenate([top[2], ids[of]])
                keep = best(q, score, ids, local.k)
                top = (q[keep], score[keep], ids[keep])
                full = np.flatnonzero(np.bincount(top[0], minlength=len(least)) >= local.k)
                last = np.searchsorted(top[0], full, side="right") - 1
                least[full] = np.maximum(least[full], local.held(top[1][last].astype(np.float64) * (1 - 1e-15 * np.sign(top[1][last]))))
        yield pa.RecordBatch.from_arrays([pa.array(top[0]), pa.array(local.ids[top[0]] if len(top[0]) else np.zeros(0, np.int64)), pa.array(top[2]), pa.array(top[1])], names=["q", "query_id", "vec_id", "score"])

    return run


def exact_topk(vectors: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``query_every``. Rows whose id
    or vector is null, or whose vector holds a null or non-finite component, take
    no part. Shorter vectors count as filled up with zeros. Rows with the query's
    own id are not its candidates; repeated rows are candidates of their own, and
    repeated queries each get a result. Scores beyond 64 bits are held at the
    nearest number. Other columns are not read; an empty table gives an empty
    result. Queries are broadcast in blocks of about ``query_block`` at most.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    rows = cut(integer_vectors(vectors, id_col, vector_col, scale))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    queries = rows.filter(F.pmod("id", F.lit(query_every)) == 0)
    n = queries.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    sample = _matrix([r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()], dims).astype(np.float64)
    longest = rows.orderBy(F.desc("length"), "id").limit(SAMPLE).collect()
    rotation = np.linalg.svd(sample.T @ sample)[0] if dims else np.zeros((0, 0))
    seeds, seed_ids = _matrix([r.v for r in longest], dims), np.array([r.id for r in longest], dtype=np.int64)
    # Partitions of consecutive lengths, and in them the longest first.
    ordered = rows.repartitionByRange(partitions(spark), F.desc("length"), "id").sortWithinPartitions(F.desc("length"))
    blocks, found = math.ceil(n / query_block), []
    for b in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", "v").collect()
        if not own:
            continue
        qs = Queries(np.array([r.id for r in own], dtype=np.int64), _matrix([r.v for r in own], dims), rotation, max(1, dims // 2), k)
        qs.start(seeds, seed_ids)
        block = spark.sparkContext.broadcast(qs)
        part = ordered.mapInArrow(_search(block, dims), "q long, query_id long, vec_id long, score long")
        part = part.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(part if blocks == 1 else cut(part))
        if blocks > 1:
            block.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_exact_topk": op6_exact_topk}
ORACLES = {
    "op6_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
}
