import numpy as np
import pytest

from lodestar.llm import pq_dedup as Q

SCHEMA = "vec_id long, embedding array<double>, label int, guest string, n string"


def brute(rows, t):
    good = []
    for k, (_, v, lab) in enumerate(rows):
        x = None if v is None or lab is None or any(e is None for e in v) else np.array(v, dtype=float)
        if x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
            x = x / np.abs(x).max()
            good.append((k, lab, x / np.sqrt((x * x).sum())))
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for i, (a, la, x) in enumerate(good):
        for b, lb, y in good[:i]:
            if la == lb and len(x) == len(y) and x @ y >= t:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, links[k], least.get(root(k)), i is not None and i == least[root(k)]) for k, (i, _, _) in enumerate(rows)), key=str)


def data(seed=2, dim=16):
    rng = np.random.default_rng(seed)
    rows, at = [], 100
    for lab in (0, 1, 2):
        for _ in range(60):
            c = rng.normal(size=dim)
            for _ in range(rng.integers(1, 5)):
                rows.append((at, (c + rng.normal(size=dim) * rng.choice([0.0, 0.03, 0.1, 0.25])).tolist(), lab))
                at += 1
    c = rng.normal(size=dim)
    rows += [(at + k, (c + rng.normal(size=dim) * 0.02).tolist(), 1) for k in range(150)]   # one dense group
    rows += [(at + 500 + k, c.tolist(), 1) for k in range(150)] + [(at + 700, (7 * c).tolist(), 1), (at + 701, c.tolist(), None), (at + 702, c.tolist(), 2)]
    bad = [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [None] + [1.0] * (dim - 1)]
    rows += [(k, v, 1) for k, v in enumerate(bad)] + [(10, [1.0, 2.0], 0), (11, [1.0, 2.0], 0), (12, [2.0, 4.1], 0), (None, c.tolist(), 1),
                                                      (100, rows[0][1], 0), (13, [-0.0, 1.0], 5), (14, [0.0, 1.0], 5), (15, [1e-200] * dim, 0), (16, [1e200] * dim, 0)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(Q, "LIST_ROWS", 20)
        monkeypatch.setattr(Q, "BLOCK_ROWS", 16)
        monkeypatch.setattr(Q, "BROADCAST_GROUPS", 1)
        monkeypatch.setattr(Q, "SAMPLE_ROWS", 200)
        monkeypatch.setattr(Q, "_CELLS", 256)
    rows = data()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    got = sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in Q.near_duplicates(df, cosine=0.98).collect()], key=str)
    assert got == brute(rows, 0.98)


def test_empty_and_all_bad(spark):
    df = spark.createDataFrame([(1, None, 1, "", ""), (2, [0.0], 1, "", "")], SCHEMA)
    assert sorted(map(tuple, Q.near_duplicates(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert Q.near_duplicates(df.limit(0)).count() == 0


def test_probes_and_codes_are_lossless():
    rng = np.random.default_rng(4)
    base = Q.unit(rng.normal(size=(400, 32)))
    x = np.concatenate((base, Q.unit(base + rng.normal(size=base.shape) * 0.02)))
    q = Q.fit(x, 400 * Q.LIST_ROWS)
    r = float(np.sqrt(2 - 2 * 0.98)) + 1e-7
    row, at, own = q.route(x, r)
    home = np.zeros(len(x), dtype=int)
    home[row[own]] = at[own]
    probes = set(zip(row.tolist(), at.tolist()))
    i, j = np.nonzero(x @ x.T >= 0.98)
    assert len(q.centres) > 4 and all((a, home[b]) in probes or (b, home[a]) in probes for a, b in zip(i, j))
    code, err = q.encode(x - q.centres[home])
    for k in range(len(q.centres)):
        members = np.flatnonzero(home == k)
        d = q.lookup(x - q.centres[k], code[members])
        true = np.sqrt(((x[:, None] - x[None, members]) ** 2).sum(axis=2))
        assert (true >= d - err[members][None, :] - 1e-6).all()
