"""Centroid clustering in whole numbers: a table of pivot distances spares most centroids their exact distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.batches import bounded_batches, frugal
from chronofold.sources.staging import staged

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 8
PIVOT_SAMPLE = 256  # vectors that the pivots are chosen from
LARGEST = 2**27  # of a component: squared distances of 64 components stay below 2**62


def whole_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, the components as floor(scale * x), of the vectors of that length without null or non-finite components."""

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    return embeddings.where((F.size("embedding") == dimensions) & ~F.coalesce(F.exists("embedding", bad), F.lit(True))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", whole).alias("v")
    )


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 rows to one point."""
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the one with the largest sum of distances to those before it."""
    chosen: list[int] = []
    reach = np.zeros(len(sample))
    for _ in range(min(n, len(sample))):
        at = int(reach.argmax())
        chosen.append(at)
        reach += np.sqrt(squared(sample, sample[at]))
        reach[chosen] = -1.0
    return sample[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(np.float64))


def assign(
    vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each vector, ties to the smaller number, and the exact distances that took.

    No centroid is nearer than its distance to a pivot differs from the vector's. The centroid of the least bound is measured
    first; of the others only those whose bound does not exceed the best distance so far.
    """
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(to_pivots.shape[1]):
        mine, theirs = to_pivots[:, p, None], centroid_pivots[None, :, p]
        np.maximum(bound, np.abs(mine - theirs) - 1e-12 * (mine + theirs), out=bound)  # less the rounding of the roots
    bound = np.square(bound) * (1 - 1e-12)
    first = bound.argmin(1)
    cluster, best = first.copy(), np.empty(len(vectors), np.int64)
    exact = len(vectors)
    for c in np.unique(first).tolist():
        rows = np.flatnonzero(first == c)
        best[rows] = squared(vectors[rows], centroids[c])
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
        exact += len(rows)
        found = squared(vectors[rows], centroids[c])
        nearer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        best[rows[nearer]], cluster[rows[nearer]] = found[nearer], c
    return cluster, best, exact


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def cluster_vectors(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that ``whole_vectors`` keeps.

    The centroids start as the vectors with the smallest hex sha256 of ``1:<vec_id>``; each round assigns all vectors and
    moves every centroid to floor(sum / count) of its vectors, in exact whole numbers. Fewer vectors give fewer centroids; an
    empty table gives no row. Rows with a null vec_id are clustered, and start a centroid only if there are too few
    others; of equal ids the smaller vector comes first. Repeated rows count each. Components beyond 2**27 count as 2**27.
    Inertias stop at the largest long. Vectors of other lengths, null vectors and those with null or non-finite components have no row; other
    columns are not read.

    Pivots are fixed: ``pivots`` of 256 vectors drawn by a hash. Distances to them are stored beside the vectors once. A round returns
    sums per task and cluster; the driver holds the centroids, the pivots and that sample, nothing that grows with the table.
    """
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, dimensions, scale)
    by_hash = [F.col("vec_id").isNull(), F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256), F.col("v")]
    centroids = np.array([r["v"] for r in rows.orderBy(*by_hash).limit(clusters).collect()], np.int64)
    if not len(centroids):
        none = ("cluster int", "distance bigint", "cluster_inertia bigint", "inertia bigint", "centroid_sha256 string")
        return rows.select("vec_id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in none])
    sample = rows.orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE).select("v").collect()
    fixed = choose_pivots(np.array([r["v"] for r in sample], np.int64), pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = pivot_distances(_matrix(batch.column(1), dimensions, np.int64), fixed)
            offsets = pa.array(np.arange(len(far) + 1) * len(fixed), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))], ["vec_id", "v", "pivots"]
            )

    bounded_batches(spark)
    table = staged(rows.mapInArrow(frugal(measure), "vec_id bigint, v array<int>, pivots array<double>"), "pivot-table")

    def assigned(batch: pa.RecordBatch, centres: np.ndarray, their_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vectors = _matrix(batch.column("v"), dimensions, np.int64)
        cluster, best, _ = assign(vectors, _matrix(batch.column("pivots"), len(fixed), np.float64), centres, their_pivots)
        return vectors, cluster, best

    def totals(centres: np.ndarray) -> dict[int, list[int]]:
        """Per non-empty cluster the sums of its vectors' components, and last their number."""
        their_pivots = pivot_distances(centres, fixed)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(centres), dimensions + 1), np.int64)
            for batch in batches:
                vectors, cluster, _ = assigned(batch, centres, their_pivots)
                np.add.at(sums, cluster, np.column_stack([vectors, np.ones(len(vectors), np.int64)]))
            used = np.flatnonzero(sums[:, -1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["cluster", "sums"]
            )

        parts = table.select("v", "pivots").mapInArrow(frugal(run), "cluster int, sums array<bigint>")
        found = (
            parts.select("cluster", F.posexplode("sums").alias("place", "value"))
            .groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
            .orderBy("cluster", "place").collect()
        )
        whole: dict[int, list[int]] = {}
        for r in found:
            whole.setdefault(r["cluster"], []).append(int(r["value"]))
        return whole

    for _ in range(rounds):
        for c, (*sums, n) in totals(centroids).items():
            centroids[c] = [s // n for s in sums]

    final, final_pivots = centroids.copy(), pivot_distances(centroids, fixed)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, best = assigned(batch, final, final_pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(best)], ["vec_id", "cluster", "distance"]
            )

    done = staged(table.mapInArrow(frugal(settle), "vec_id bigint, cluster int, distance bigint"), "assigned")
    inertia = {
        r["cluster"]: int(r["total"])
        for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()
    }
    largest = 2**63 - 1
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    of_cluster = [
        (c, min(total, largest), min(sum(inertia.values()), largest), names[c]) for c, total in sorted(inertia.items())
    ]
    about = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return done.join(F.broadcast(about), "cluster").select(  # a row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
