import random

import numpy as np
import pytest
import xxhash

from lodestar.llm import simhash_vp as S
from lodestar.llm.components import components

WS = b" \t\n\r\x0b\x0c"


def brute_fp(text):
    words, w = [], b""
    for c in (text or "").encode():
        c = bytes([c])
        if c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"):
            if w:
                words.append(w)
            w = b""
        else:
            w += bytes([c[0] + 32]) if b"A" <= c <= b"Z" else c
    if w:
        words.append(w)
    if not words:
        return 0
    k = max(1, len(words) - 2)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(k)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(docs):
    fps = [(i, brute_fp(t)) for i, t in docs]
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 2:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            r = root(k)
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{f:016x}", least.get(root(k))) for k, (i, f) in enumerate(fps)), key=str)


def got(df):
    return sorted([(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()], key=str)


def test_matches_brute_force_with_edges(spark, docs_of):
    rnd = random.Random(5)
    vocab = ["Alpha", "beta", "GAMMA", "delta", "éps", "zeta", "eta x", "theta"]
    docs = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "two words"), (6, "a b c"), (7, "a  b\nC"),
            (None, "a b c"), (8, "x " * 5000), (8, "x " * 5000), (None, "lonely text here now")]
    for i in range(60):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 60))]
        docs.append((100 + 3 * i, " ".join(base)))
        base[rnd.randrange(len(base))] = "changed"
        docs.append((101 + 3 * i, " ".join(base)))
        docs.append((102 + 3 * i, "\n".join(base).lower()))
    df = docs_of(docs).withColumnRenamed("lang", "fp").withColumnRenamed("source", "id")
    assert got(S.near_duplicates(df)) == brute(docs)


def test_empty_table(spark, docs_of):
    out = S.near_duplicates(docs_of([]))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


@pytest.mark.parametrize("depth", [1, 4])
def test_tree_shards_lose_no_link(spark, monkeypatch, depth):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2 ** 63, size=120, dtype=np.uint64)
    fps = list(centre)
    for c in centre:
        for _ in range(4):
            for b in rng.integers(0, 64, size=rng.integers(1, 4)):
                c = c ^ np.uint64(1 << int(b))
            fps.append(c)
    fps = np.unique(np.array(fps, dtype=np.uint64))
    monkeypatch.setattr(S, "SHARD_ROWS", len(fps) / 2 ** depth)
    monkeypatch.setattr(S, "LEAF", 8)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(5)
    edges = S.link_forest(df, len(fps), 2)
    label = {r.node: r.label for r in components(edges).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    seen = np.zeros(len(fps), dtype=int) - 1
    for s in range(len(fps)):
        if seen[s] < 0:
            todo = [s]
            while todo:
                x = todo.pop()
                if seen[x] < 0:
                    seen[x] = s
                    todo.extend(np.flatnonzero(near[x]))
    ids = fps.view(np.int64).tolist()
    want = {}
    for k, x in enumerate(ids):
        want.setdefault(seen[k], set()).add(x)
    have = {}
    for x in ids:
        have.setdefault(label.get(x, x), set()).add(x)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_components_hot_star_and_chain(spark):
    edges = [(0, i) for i in range(1, 500)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (None, 3), (1001, 1000)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.label for r in components(df).collect()}
    assert all(label[i] == 0 for i in range(500)) and all(label[i] == 1000 for i in range(1000, 1101)) and len(label) == 601
