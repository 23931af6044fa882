"""Centroid clustering of integer vectors by bit-plane popcounts.

Components become integers, and the integers two's complement bit planes: plane ``i`` holds bit
``i`` of all 64 components in one 64-bit word. With ``w_i`` the weight of a plane (the top one
counts negative), ``x . c = sum w_i w_j popcount(X_i & C_j)``: exact, whatever the order of terms.

The planes are written once; every round is one scan of them that leaves ``k`` counts and ``k x
64`` sums a task, which Spark adds up. The driver holds the centroids, a fixed number of integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm.tables import ship
from tiercast.plans.staging import stage

DIM = 64
K = 16
ROUNDS = 3
SCALE = 64
SEED = 1
# 64 squared differences of components below this fit a signed 64-bit distance.
LARGEST = 1 << 27


def plane_weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts, the sign plane last."""
    weights = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Planes (rows x planes, 64-bit words) of integer vectors of 64 components."""
    bits = (values[:, None, :] >> np.arange(planes, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8").reshape(len(values), planes)


def dot(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of every row of planes ``x`` with one row of planes ``c``."""
    weights = plane_weights(len(c))
    out = np.zeros(len(x), np.int64)
    for j, word in enumerate(c):
        out += weights[j] * (np.bitwise_count(x & word).astype(np.int64) @ weights)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Squared lengths of rows of planes."""
    weights = plane_weights(x.shape[1])
    out = np.zeros(len(x), np.int64)
    for i in range(x.shape[1]):
        out += weights[i] * (np.bitwise_count(x & x[:, i : i + 1]).astype(np.int64) @ weights)
    return out


def assign(x: np.ndarray, lengths: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number on ties) and squared distance of rows of planes."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    cluster = np.zeros(len(x), np.int32)
    for k, (c, length) in enumerate(zip(centroids, norms(centroids))):
        distance = lengths + length - 2 * dot(x, c)
        nearer = distance < best
        best[nearer], cluster[nearer] = distance[nearer], k
    return cluster, best


def sums_of(x: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and componentwise sums of each cluster, from the bits of the planes."""
    weights = plane_weights(x.shape[1])
    counts, sums = np.zeros(k, np.int64), np.zeros((k, DIM), np.int64)
    for c in np.unique(cluster):
        mine = np.ascontiguousarray(x[cluster == c])
        bits = np.unpackbits(mine.view(np.uint8).reshape(len(mine), -1, 8), axis=2, bitorder="little")
        counts[c], sums[c] = len(mine), weights @ bits.sum(axis=0, dtype=np.int64)
    return counts, sums


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, values`` of the vectors that take part: 64 components, none null or not finite."""
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    fit = rows.where(F.coalesce((F.size("x") == DIM) & F.forall("x", number), F.lit(False)))
    return fit.select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("values"))


def starts(rows: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The first ``k`` vectors by the hash of seed and id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["values"]) for r in rows.select(name.alias("name"), "values").orderBy("name", "values").limit(k).collect()]


def planes_needed(rows: DataFrame) -> int:
    """Bits of the widest component, sign included."""
    low, high = rows.select(F.array_min("values").alias("low"), F.array_max("values").alias("high")).agg(F.min("low"), F.max("high")).first()
    if low < -LARGEST or high >= LARGEST:
        raise ValueError(f"components reach from {low} to {high}: squared distances do not fit 64 bits")
    return max(int(high).bit_length(), int(~low).bit_length() if low < 0 else 0) + 1


def _words(column: pa.Array, planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, planes)


def packed_planes(rows: DataFrame, planes: int) -> DataFrame:
    """Staged: ``vec_id, planes, length`` with the squared length."""
    ship(rows.sparkSession)

    def in_task(batches):
        for batch in batches:
            if batch.num_rows:
                x = pack(np.asarray(batch.column("values").flatten(), np.int64).reshape(-1, DIM), planes)
                words = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), words, pa.array(norms(x))], names=["vec_id", "planes", "length"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return stage(rows.mapInArrow(in_task, f"vec_id {kind}, planes binary, length bigint"), "planes")


def moved(table: DataFrame, planes: int, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the floor of every cluster's mean; a centroid without vectors stays."""
    k, current = len(centroids), pack(np.array(centroids, np.int64), planes)

    def in_task(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, DIM), np.int64)
        for batch in batches:
            x = _words(batch.column("planes"), planes)
            n, s = sums_of(x, assign(x, batch.column("length").to_numpy(), current)[0], k)
            counts, sums = counts + n, sums + s
        rows = [*sums.ravel(), *counts]  # the last k are the counts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(rows, pa.int64())], names=["cell", "part"])

    parts = table.mapInArrow(in_task, "cell int, part bigint").groupBy("cell").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    total = {r.cell: int(r.total) for r in parts.collect()}  # k x 65 numbers
    out = []
    for c, old in enumerate(centroids):
        n = total.get(k * DIM + c, 0)
        out.append([total[c * DIM + d] // n for d in range(DIM)] if n else old)
    return out


def assigned(table: DataFrame, planes: int, centroids: list[list[int]]) -> DataFrame:
    """``vec_id, cluster, distance``."""
    current = pack(np.array(centroids, np.int64), planes)

    def in_task(batches):
        for batch in batches:
            x = _words(batch.column("planes"), planes)
            cluster, distance = assign(x, batch.column("length").to_numpy(), current)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(in_task, f"vec_id {kind}, cluster int, distance bigint")


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Vectors with ``cluster, distance``, and the clusters: ``cluster, size, cluster_inertia, centroid``.

    Vectors that are null, of another length, or hold a null or a component that is no finite
    number take no part; zero vectors do. Rows that repeat an id or a vector each count; a null id
    counts as the empty text when starts are drawn, equal hashes are settled by the components.
    Other columns are ignored. With fewer vectors than ``k`` every vector starts a cluster; an
    empty table gives empty results. Components of 2^27 and more are refused, as squared distances
    would not fit a long.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, scale)
    centroids = starts(rows, k, seed)
    if not centroids:
        kind = rows.schema["vec_id"].dataType.simpleString()
        none = spark.createDataFrame([], "cluster int, size bigint, cluster_inertia bigint, centroid array<bigint>")
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint"), none
    planes = planes_needed(rows)
    table = packed_planes(rows, planes)
    for _ in range(rounds):
        centroids = moved(table, planes, centroids)
    found = stage(assigned(table, planes, centroids), "clusters")
    sums = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # at most k rows
    held = {r.cluster: (r.n, int(r.d)) for r in sums}
    made = [(c, *held.get(c, (0, 0)), centroid) for c, centroid in enumerate(centroids)]
    return found, spark.createDataFrame(made, "cluster int, size bigint, cluster_inertia bigint, centroid array<bigint>")


def report(vectors: DataFrame) -> DataFrame:
    """A row per vector that takes part: its cluster and distance, the inertias, and a digest of its centroid."""
    found, groups = clusters(vectors)
    inertia = groups.agg(F.coalesce(F.sum("cluster_inertia"), F.lit(0))).first()[0]
    digest = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    named = groups.select("cluster", "cluster_inertia", F.lit(inertia).cast("bigint").alias("inertia"), digest.alias("centroid_sha256"))
    return found.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def digest_of(centroid: list[int]) -> str:
    """The digest that ``report`` gives, for checks."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
