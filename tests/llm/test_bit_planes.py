import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm.bit_planes import cluster_report, cluster_vectors, dots, nearest, pack_planes, unpack_planes


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 27), st.integers(1, 27))
def test_planes_give_exact_products(seed, bits, other_bits):
    rng = np.random.default_rng(seed)
    a = rng.integers(-(1 << bits), 1 << bits, (7, 64))
    b = rng.integers(-(1 << other_bits), 1 << other_bits, (5, 64))
    assert (unpack_planes(pack_planes(a)) == a).all()
    assert (dots(pack_planes(a), pack_planes(b)) == a @ b.T).all()
    at, distance = nearest(pack_planes(a), b)
    plain = ((a[:, None, :] - b[None]) ** 2).sum(axis=2)
    assert (at == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def brute(rows, count, rounds=5):
    """Plain Python: {(vec_id, row number): (cluster, distance)} and the centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:count]]

    def assign(v):
        return min(((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    return [(i, *reversed(assign(v))) for i, v in kept], centroids


def sample_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 0.2, 64) + (i % 4)).tolist()) for i in range(150)]
    rows += [(1000 + i, [float(i % 2)] * 64) for i in range(20)]
    rows += [(2000, [1.0] * 63), (2001, None), (2002, [None] + [0.0] * 63), (2003, [math.nan] * 64), (2004, [math.inf] + [0.0] * 63), (2005, [])]
    rows += [(2006, [-5000.0] + [3.0] * 63), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("count", [1, 7, 40, 500])
def test_clusters_equal_plain_python(spark, count):
    rows = sample_vectors()
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, planes int").repartition(3)
    found, centroids = cluster_vectors(frame, count)
    wanted, wanted_centroids = brute(rows, count)
    assert centroids.tolist() == wanted_centroids
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_report_sums_and_digests(spark):
    rows = sample_vectors()
    found = cluster_report(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 7).collect()
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    wanted, centroids = brute(rows, 7)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == sorted(wanted)
    total = sum(d for _, _, d in wanted)
    for r in found:
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in wanted if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_null_ids_and_repeats_are_clustered(spark):
    rows = [(None, [1.0] * 64), (None, [0.0] * 64), (1, [0.0] * 64), (1, [0.0] * 64)]
    found = cluster_report(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()
    assert len(found) == 4 and sum(r.vec_id is None for r in found) == 2
    assert {r.inertia for r in found} == {64 * 171**2 + 0} or len({r.inertia for r in found}) == 1


def test_an_empty_table_and_huge_components(spark):
    schema = "vec_id long, embedding array<double>"
    assert cluster_report(spark, spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        cluster_report(spark, spark.createDataFrame([(1, [1e9] * 64)], schema)).collect()
