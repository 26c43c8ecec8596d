import hashlib
import math

import numpy as np
import pytest

from lodestar.llm import lookup_kmeans as K


def brute(rows, k=8, rounds=10, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) with Python integers."""
    kept = [(i, [math.floor(1024 * v) for v in x]) for i, x in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(x) for _, x in first]

    def place():
        out = []
        for _, x in kept:
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds if centres else 0):
        at = place()
        for c in range(len(centres)):
            own = [x for (_, x), (a, _) in zip(kept, at) if a == c]
            if own:
                centres[c] = [sum(col) // len(own) for col in zip(*own)]
    at = place() if centres else []
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    inertia = [sum(d for a, d in at if a == c) for c in range(len(centres))]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in zip(kept, at)), key=repr)


def found(spark, rows, parts=3):
    df = spark.createDataFrame([(i, x, 0, 1) for i, x in rows], "vec_id long, embedding array<double>, cluster int, id int")
    return sorted([tuple(r) for r in K.cluster(df.repartition(parts)).collect()], key=repr)


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, 64))
    return [(i, (centre[i % 12] + 0.3 * rng.normal(size=64)).tolist()) for i in range(n)]


def test_matches_brute_force_whatever_the_layout(spark):
    rows = vectors(240)
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows[::-1], parts=7) == want


def test_unusable_repeated_and_tied_vectors(spark):
    rows = vectors(30)
    x = rows[0][1]
    rows += [(100, None), (101, []), (102, x[:63]), (103, x + [0.0]), (104, x[:63] + [None]), (105, x[:63] + [float("nan")]), (106, x[:63] + [float("inf")]),
             (0, x), (0, x), (None, x), (200, [0.0] * 64), (201, [-0.0005] * 64), (202, [0.0] * 64)]
    assert found(spark, rows) == brute(rows)


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [0.25] * 64) for i in range(20)]
    got = found(spark, rows)
    assert got == brute(rows) and {r[1] for r in got} == {0}


def test_few_and_no_vectors(spark):
    assert found(spark, vectors(3)) == brute(vectors(3))
    assert found(spark, []) == [] and found(spark, [(1, None)]) == []


def test_components_beyond_64_bit_sums_are_refused(spark):
    with pytest.raises(Exception, match="cannot be clustered"):
        found(spark, [(1, [1e300] * 64), (2, [0.0] * 64)])


def test_table_distances_equal_direct_ones():
    rng = np.random.default_rng(0)
    v = rng.integers(-50, 50, (200, 5))
    values, codes = zip(*(np.unique(v[:, d], return_inverse=True) for d in range(5)))
    block = K.Block.__new__(K.Block)
    block.n, block.values, block.codes = 200, list(values), np.stack(codes)
    centres = rng.integers(-50, 50, (4, 5))
    best, far = block.nearest(centres)
    direct = ((v[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == direct.argmin(axis=1)).all() and (far == direct.min(axis=1)).all()
    assert (block.sums(best, 4) == np.stack([v[best == c].sum(axis=0) for c in range(4)])).all()
