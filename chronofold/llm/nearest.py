"""Nearest neighbours by a block matrix join of int8 tiles with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal
from chronofold.sources.staging import staged

BLOCK = 4_096  # vectors of a block, on average
TILE_DIMENSIONS = 1_024  # products of this many int8 pairs are exact in a 32-bit float


def valid(embedding: Column) -> Column:
    """No null, no null or non-finite component, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component lies in [0.5, 1): no square over- or underflows, no digit changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8, with scale, the length of the rounded vector and the length of the error, per row."""
    units = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    scales = np.abs(units).max(1) / 127
    codes = np.rint(units / scales[:, None]).astype(np.int8)
    rounded = codes * scales[:, None]
    return codes, scales, np.sqrt((rounded**2).sum(1)), np.sqrt(((units - rounded) ** 2).sum(1)) + 1e-12


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows; float arithmetic on at most 1,024 dimensions at a time stays below 2**24."""
    total = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], TILE_DIMENSIONS):
        total += a[:, d : d + TILE_DIMENSIONS].astype(np.float32) @ b[:, d : d + TILE_DIMENSIONS].astype(np.float32).T
    return total


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    dots = (others * query).sum(1)
    return dots / (np.sqrt((query * query).sum()) * np.sqrt((others * others).sum(1)))


def tile_nearest(query_ids, queries, ids, vectors, k: int) -> Iterator[tuple[int, int, float]]:
    """(query, candidate, cosine) of the ``k`` nearest of one block for each query, itself left out.

    Products of int8 codes bound each cosine from both sides. Candidates whose upper bound lies below the
    ``k``-th best lower bound are out; the others are computed in double precision and kept in a heap.
    """
    queries, vectors = levelled(queries), levelled(vectors)
    qc, qs, ql, qe = quantise(queries)
    vc, vs, _, ve = quantise(vectors)
    for i in range(0, len(queries), 256):
        near = int8_products(qc[i : i + 256], vc) * qs[i : i + 256, None] * vs
        # |u.v - u'.v'| <= |u - u'| |v| + |u'| |v - v'| with |v| = 1
        slack = qe[i : i + 256, None] + ql[i : i + 256, None] * ve
        low = np.where(ids[None] == query_ids[i : i + 256, None], -np.inf, near - slack)
        for r, (row, high) in enumerate(zip(low, near + slack, strict=True)):
            other = ids != query_ids[i + r]
            least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
            left = np.flatnonzero(other & (high >= least))
            exact = cosines(queries[i + r], vectors[left])
            heap = zip(exact.tolist(), (-ids[left]).tolist(), strict=True)
            for score, name in heapq.nlargest(k, heap):
                yield int(query_ids[i + r]), -name, score


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest cosine for each query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows of another vec_id; ties go
    to the smaller vec_id. Rows with a null vec_id or a vector that is null, zero, holds null or non-finite
    components, or has another length than the query's take no part. Fewer candidates give fewer ranks. Candidates with a
    repeated vec_id count each; of repeated queries the smallest vector answers. An empty table gives no row; other columns are not read.

    Both sides are dealt to blocks by hash; every block of queries meets every block of candidates of its length
    in an equi-join on the blocks' names. Only block sizes depend on a count of the rows. Each pair of blocks returns ``k``
    rows per query.
    """
    rows = staged(
        embeddings.where(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).select(
            F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
        ),
        "vectors",
    )
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    parts = max(1, -(-rows.count() // block))
    query_parts = max(1, -(-parts // every))

    def dealt(df: DataFrame, n: int, name: str) -> DataFrame:
        spread = F.xxhash64("vec_id", F.hash("v"), F.monotonically_increasing_id() if name == "c" else F.lit(0))
        return (
            df.groupBy(F.size("v").alias("size"), F.pmod(spread, F.lit(n)).alias(f"{name}_part"))
            .agg(F.collect_list(F.struct("vec_id", "v")).alias(name))
            .select("size", f"{name}_part", F.col(f"{name}.vec_id").alias(f"{name}_ids"), F.flatten(f"{name}.v").alias(f"{name}_vectors"))
        )

    candidates = dealt(rows, parts, "c").withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    pairs = candidates.withColumn("q_part", F.col("q_part").cast("bigint")).join(dealt(queries, query_parts, "q"), ["size", "q_part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q_ids, q, c_ids, c = (batch.column(n)[r].values.to_numpy(zero_copy_only=False) for n in range(4))
                found = list(tile_nearest(q_ids, q.reshape(len(q_ids), -1), c_ids, c.reshape(len(c_ids), -1), k))
                columns = list(zip(*found, strict=True)) or [(), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"]
                )

    bounded_batches(embeddings.sparkSession)
    found = (
        pairs.select("q_ids", "q_vectors", "c_ids", "c_vectors")
        .repartition(max(8, min(parts * query_parts, 4096)))
        .mapInArrow(frugal(run), "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
