"""Centroid clustering whose lower bounds are loosened by planar geometry."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import sent
from demandspark.session import shared_path, staged

#: The contract's sizes.
CLUSTERS, ROUNDS, DIM, SCALE, SEED = 8, 10, 64, 1024, "3:"
#: Vectors in a block, blocks in a bucket, and as many buckets as Spark allows.
BLOCK_ROWS, BUCKET_BLOCKS, MOST_BUCKETS = 4096, 32, 100_000
#: Largest part of an integer vector for which squared distances fit into a long.
LARGEST = 2 ** 27
#: Room for rounding where a bound decides; vectors within it are compared exactly.
SLACK = 1e-9

BLOCKS = "block long, ids array<long>, matrix binary"
STATE = "block long, cluster binary, upper binary, lower binary, moved array<long>, radius array<double>, scanned long"
RESULT = "vec_id long, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id, q``: vectors of ``dim`` finite parts, each part x as floor(scale * x)."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    parts = F.transform("v", lambda x: F.when(F.abs(x) * scale <= LARGEST, F.floor(x * F.lit(float(scale)))).otherwise(
        F.raise_error(F.lit(f"a part times {scale} is beyond {LARGEST}")).cast("long")))
    return rows.filter((F.size("v") == dim) & good).select("id", parts.cast("array<long>").alias("q"))


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The k vectors whose seeded id has the smallest hashes; null ids last, ties by the vector."""
    chance = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    picked = rows.select(chance.alias("chance"), "q").orderBy(F.col("chance").asc_nulls_last(), "q").limit(k).collect()
    return np.array([r.q for r in picked], np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows from integer centroids."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer any other centroid can have come to a point of its sphere.

    Let a centroid move from a to b, D = |b - a|, with m the middle. For a point x the gain
    |x - a| - |x - b| equals 2 (x - m).(b - a) / (|x - a| + |x - b|), and the divisor is 2 |x - m| at
    least, so the gain is at most D cos(angle at m between x and b). Gain and sphere are symmetric about
    the line through a and b, so it suffices to look at the plane through that line and the sphere's centre c:
    there the sphere is a disc seen from m under the half angle arcsin(radius / |c - m|), and the smallest
    angle any of its points can have is that of c less the half angle. Nothing is lost beyond a right
    angle; the full drift D only counts when the disc reaches the line or holds m.
    """
    out = np.zeros(len(old))
    middle, move = (old + new) / 2, (new - old).astype(float)
    drift = np.sqrt((move * move).sum(1))
    for i in np.flatnonzero(radius >= 0):
        away = old[i] - middle
        far = np.sqrt((away * away).sum(1))
        gain = drift.copy()
        seen = (far > radius[i]) & (drift > 0)
        angle = np.arccos(np.clip((away[seen] * move[seen]).sum(1) / (far[seen] * drift[seen]), -1, 1))
        nearest = np.maximum(angle - np.arcsin(radius[i] / far[seen]), 0)
        gain[seen] *= np.maximum(np.cos(nearest), 0)
        gain[i] = 0
        out[i] = gain.max()
    return out


def reassign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray,
             drift: np.ndarray, loose: np.ndarray) -> int:
    """Move the bounds along with the centroids and update the three arrays in place; the number scanned.

    A vector whose upper bound stays below its lower bound keeps its cluster. Others first get their
    exact distance from their centroid, and if that does not settle it, from all centroids; of equally
    near ones the smaller number wins.
    """
    known = cluster >= 0
    upper[known] += drift[cluster[known]]
    lower[known] -= loose[cluster[known]]
    unsure = lambda at: np.flatnonzero(~(upper[at] + SLACK * (1 + upper[at] + np.abs(lower[at])) < lower[at]))
    maybe = np.flatnonzero(~known) if not known.any() else unsure(slice(None))
    own = maybe[known[maybe]]
    away = x[own] - centroids[cluster[own]]
    upper[own] = np.sqrt((away * away).sum(1).astype(float))
    scan = np.concatenate([maybe[~known[maybe]], own[unsure(own)]])
    all_of = squared(x[scan], centroids)
    cluster[scan] = all_of.argmin(1)
    near = np.sort(all_of, 1).astype(float)
    upper[scan] = np.sqrt(near[:, 0])
    lower[scan] = np.sqrt(near[:, 1]) if len(centroids) > 1 else np.inf
    return len(scan)


def _pack(dim: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for rows in batches:
            for at in range(0, rows.num_rows, block_rows):
                part = rows.slice(at, block_rows)
                matrix = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([part.column(0)], pa.list_(pa.int64())), pa.array([matrix.tobytes()], pa.binary())],
                    ["block", "ids", "matrix"])
                block += 1
    return run


def _each_block(dim: int, model: Callable, work: Callable) -> Callable:
    """Run ``work`` on every block with its matrix, its arrays of state and the model of the round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, drift, loose = model()
        for rows in batches:
            for row in rows.to_pylist():
                x = np.frombuffer(row["matrix"], np.int32).reshape(-1, dim).astype(np.int64)
                if row.get("cluster") is None:
                    state = np.full(len(x), -1, np.int16), np.full(len(x), np.inf), np.zeros(len(x))
                else:
                    state = (np.frombuffer(row["cluster"], np.int16).copy(), np.frombuffer(row["upper"]).copy(), np.frombuffer(row["lower"]).copy())
                before = state[0].copy()
                scanned = reassign(x, *state, centroids, drift, loose)
                yield from work(row, x, before, *state, centroids, scanned)
    return run


def _keep_state(row, x, before, cluster, upper, lower, centroids, scanned):
    """The block's new state, what left and joined each cluster, and the radius of its part of each."""
    k, dim = centroids.shape
    moved, n, radius = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.full(k, -1.0)
    for c in range(k):
        came, left = (cluster == c) & (before != c), (cluster != c) & (before == c)
        moved[c], n[c] = x[came].sum(0) - x[left].sum(0), came.sum() - left.sum()
        radius[c] = upper[cluster == c].max(initial=-1.0)
    yield pa.RecordBatch.from_arrays(
        [pa.array([row["block"]], pa.int64())] + [pa.array([a.tobytes()], pa.binary()) for a in (cluster, upper, lower)]
        + [pa.array([np.concatenate([moved.reshape(-1), n])], pa.list_(pa.int64())), pa.array([radius], pa.list_(pa.float64())),
           pa.array([scanned], pa.int64())],
        ["block", "cluster", "upper", "lower", "moved", "radius", "scanned"])


def _final_rows(row, x, before, cluster, upper, lower, centroids, scanned):
    away = x - centroids[cluster]
    yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(cluster.astype(np.int32)), pa.array((away * away).sum(1))],
                                     ["vec_id", "cluster", "distance"])


class _Tables:
    """Tables bucketed by block, so that rounds join state to vectors without moving the vectors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names, self.buckets = spark, [], 0

    def write(self, rows: DataFrame) -> DataFrame:
        name = f"drift_{uuid4().hex}"
        self.names.append(name)
        (rows.write.bucketBy(self.buckets, "block").option("path", shared_path(self.spark, "drift")).saveAsTable(name))
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


def lloyd(rows: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, np.ndarray, list[int]]:
    """``vec_id, cluster, distance`` after ``rounds`` rounds, the last centroids, and the vectors scanned in each round.

    ``rows`` has ``id`` and ``q``. Vectors are packed once into blocks, bucketed by block. A round
    reads them with the former round's assignments and bounds, 18 bytes a vector, and writes the new ones with what
    left and joined each cluster; only sums, counts and radii of the clusters reach the driver.
    """
    spark, (k, dim) = rows.sparkSession, centroids.shape
    tables = _Tables(spark)
    parallel = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        tables.buckets = min(max(parallel, rows.count() // (block_rows * BUCKET_BLOCKS)), MOST_BUCKETS)
        blocks = tables.write(rows.mapInArrow(_pack(dim, block_rows), BLOCKS).repartition(tables.buckets, "block"))
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        drift, loose, state, scanned = np.zeros(k), np.zeros(k), None, []
        for step in range(rounds + 1):
            model = sent(spark, (centroids, drift, loose))
            known = blocks if state is None else blocks.join(state.select("block", "cluster", "upper", "lower").hint("shuffle_hash"), "block")
            if step == rounds:
                return staged(known.mapInArrow(_each_block(dim, model, _final_rows), RESULT)), centroids, scanned
            state = tables.write(known.drop("ids").mapInArrow(_each_block(dim, model, _keep_state), STATE))
            sums = state.select(F.posexplode("moved").alias("at", "moved")).groupBy("at").agg(F.sum("moved").alias("moved")).collect()
            gone = np.zeros(k * dim + k, np.int64)
            gone[[r["at"] for r in sums]] = [r["moved"] for r in sums]
            total, n = total + gone[:k * dim].reshape(k, dim), n + gone[k * dim:]
            *radius, looked = state.agg(*[F.max(F.col("radius")[i]) for i in range(k)], F.sum("scanned")).first()
            scanned.append(looked)
            moved = centroids.copy()
            moved[n > 0] = total[n > 0] // n[n > 0, None]
            drift = np.sqrt(((moved - centroids).astype(float) ** 2).sum(1)) * (1 + SLACK)
            loose = loosening(centroids, moved, np.array(radius, float) * (1 + SLACK)) * (1 + SLACK)
            centroids = moved
    finally:
        tables.drop()


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED,
                    vec_id: str = "vec_id", embedding: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable row of ``vectors``.

    Usable are vectors of ``dim`` parts, none null or without a finite value; others give no row. Results are
    those of plain rounds over integer vectors, bit for bit. Repeated rows count each. Rows with a null id
    are clustered, but start a centroid only where ids run out; with fewer than ``k`` vectors there are fewer
    centroids; equal starts leave the later ones empty. No usable row gives no rows. A part beyond 2^27 after
    scaling raises, as its squared distance may not fit a long. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, dim, scale, vec_id, embedding)
    start = first_centroids(rows, k, seed)
    if not len(start):
        return spark.createDataFrame([], RESULT + ", cluster_inertia long, inertia long, centroid_sha256 string")
    found, centroids, _ = lloyd(rows, start, rounds, block_rows)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    by_cluster = [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()]  # a row a cluster
    facts = spark.createDataFrame(by_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
