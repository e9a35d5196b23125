"""Centroid clustering of integer vectors packed as bit planes.

Plane b of a vector is one 64-bit word: bit i of it is bit b of component i, in two's complement. The dot product
of two vectors is the sum over pairs of planes of weight * popcount(plane AND plane), with weight 2^(a+b) and
a minus sign for the top planes, so dot products and squared distances are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from marketloom.errors import BatchError
from marketloom.llm.common import store

SIZE = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = "2:"
# 64 components of this many bits keep every squared distance below 2^63.
MOST_BITS = 28
BLOCK = 4096


def pack_planes(vectors: np.ndarray) -> np.ndarray:
    """(n, 64) integers as (n, planes) words; the last plane is the sign."""
    bits = max(2, int(np.abs(vectors).max(initial=0)).bit_length() + 1)
    shifts = np.arange(bits)
    planes = ((vectors[:, None, :] >> shifts[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(planes, axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(len(planes), planes.shape[1], 8), axis=2, bitorder="little")
    return np.tensordot(bits.astype(np.int64), plane_weights(planes.shape[1]), axes=(1, 0))


def plane_weights(bits: int) -> np.ndarray:
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def dots(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """(n, k) dot products: AND-popcounts of every pair of planes, those of one weight added before they are weighed."""
    n, bits = planes.shape
    k, other_bits = others.shape
    out = np.zeros((n, k), np.int64)
    for start in range(0, n, BLOCK):
        block = planes[start : start + BLOCK]
        same: dict[int, np.ndarray] = {}
        for a in range(bits):
            for b in range(other_bits):
                counts = np.bitwise_count(block[:, a, None] & others[None, :, b])
                negative = (a == bits - 1) != (b == other_bits - 1)
                weight = -(1 << (a + b)) if negative else 1 << (a + b)
                if weight in same:
                    same[weight] += counts
                else:
                    same[weight] = counts.astype(np.uint16)
        for weight, counts in same.items():
            out[start : start + BLOCK] += weight * counts.astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and the squared distance."""
    lengths = np.einsum("ij,ij->i", centroids, centroids)
    partial = lengths[None, :] - 2 * dots(planes, pack_planes(centroids))
    at = partial.argmin(axis=1)
    own = unpack_planes(planes)
    return at, np.einsum("ij,ij->i", own, own) + partial[np.arange(len(at)), at]


def pack_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and the planes of every usable vector; components x become floor(256 * x).

    Vectors with another number of components, or with a component that is null, not a number or infinite, are left out.
    A component that does not fit 28 bits ends the job, as its squared distances would not fit a long.
    """
    good = "size(embedding) = 64 AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                values = part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)
                scaled = np.floor(values * SCALE)
                if np.abs(scaled).max(initial=0) >= 1 << (MOST_BITS - 1):
                    raise BatchError(f"a component times {SCALE} does not fit {MOST_BITS} bits")
                planes = pack_planes(scaled.astype(np.int64))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(planes.view(np.int64).ravel()), planes.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), lists], names=["vec_id", "planes"])

    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(good)
    return kept.mapInArrow(packed, "vec_id long, planes array<long>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, planes) of vectors with equally many planes; fewer planes are extended by their sign."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            lists = part.column("planes")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().view(np.uint64)
            counts = np.diff(offsets)
            at = np.minimum(np.arange(counts.max(initial=1))[None, :], counts[:, None] - 1)
            yield part.column("vec_id"), flat[offsets[:-1, None] + at]


def _first_centroids(packed: DataFrame, count: int, seed: str) -> np.ndarray:
    """The vectors with the smallest sha256 of seed and id. Rows with one id are ordered by their planes, null ids come last."""
    name = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = packed.orderBy(name.asc_nulls_last(), "planes").limit(count).collect()
    return np.array([unpack_planes(np.array([r.planes], np.int64).view(np.uint64))[0] for r in rows], np.int64).reshape(-1, SIZE)


def _moved(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. A task sends at most one row of sums per centroid, so a hot cluster is no hot key."""
    names = [f"s{i}" for i in range(SIZE)]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), SIZE), np.int64)
        for _, planes in _blocks(batches):
            at, _ = nearest(planes, centroids)
            order = np.argsort(at, kind="stable")
            used, first = np.unique(at[order], return_index=True)
            sums[used] += np.add.reduceat(unpack_planes(planes)[order], first, axis=0)
            counts += np.bincount(at, minlength=len(centroids))
        used = np.flatnonzero(counts)
        columns = [used.astype(np.int32), counts[used], *sums[used].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "n", *names])

    schema = "cluster int, n long, " + ", ".join(f"{c} long" for c in names)
    parts = packed.mapInArrow(summed, schema)
    totals = parts.groupBy("cluster").agg(F.sum("n"), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in names])
    moved = centroids.copy()
    for row in totals.collect():
        moved[row[0]] = [int(s) // row[1] for s in row[2:]]
    return moved


def cluster_vectors(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster and distance of every usable vector; the centroids, numbered as ``cluster`` says).

    Repeated rows are clustered one by one, null ids too; fewer vectors than ``count`` give as many centroids; an empty table
    gives no rows. Other columns are not read. The driver sees the centroids only: ``count`` rows a round.
    """
    packed = store(pack_vectors(vectors), "planes")
    centroids = _first_centroids(packed, count, seed)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, planes in _blocks(batches):
            at, distance = nearest(planes, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    if len(centroids):
        for _ in range(rounds):
            centroids = _moved(packed, centroids)
    return packed.mapInArrow(assigned, "vec_id long, cluster int, distance long"), centroids


def cluster_report(spark: SparkSession, vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    found, centroids = cluster_vectors(vectors, count, rounds, seed)
    found = store(found, "assigned")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row per centroid
    total = sum(row.cluster_inertia for row in sums)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(row.cluster, row.cluster_inertia, total, digests[row.cluster]) for row in sums]
    types = {"cluster": IntegerType(), "cluster_inertia": LongType(), "inertia": LongType(), "centroid_sha256": StringType()}
    schema = StructType([StructField(name, kind) for name, kind in types.items()])
    return found.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
