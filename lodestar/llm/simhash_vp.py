"""SimHash near-duplicates (operator 9): fingerprints linked through vantage-point trees.

A document's fingerprint has bit b set when more than half of its word shingles have
bit b set in their XXH64 (seed 42).  Equal fingerprints are one class.  Classes are
dealt to shards by a vantage-point tree over Hamming distance, fitted on a bounded
sample: an inner node sends a fingerprint to its near or far side by the distance to
its vantage point.  A class searches its own shard and every shard on the other side
of a boundary that lies within ``max_bits`` (triangle inequality), so no link is lost.
Inside a shard the same pruning runs on a local tree down to small leaves, which are
compared exactly.  Only one direction of a pair crosses a boundary, and each task
returns a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import Forest, cut, hash_sample, map_arrow, record_batch, shuffle_width, text_slices, texts_of
from lodestar.llm.components import components

SEED = 42
SHARD_ROWS = 4096          # classes per shard aimed at
SAMPLE_ROWS = 65536        # classes that fit the shard tree, at most about
LEAF_SAMPLE = 16           # sampled classes a shard must have, so at most 4,096 shards
LEAF = 96                  # fingerprints in a leaf of the local tree

_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def _bits_set(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, 64) counts of hashes per document that have each bit set."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = np.empty((n, 64), dtype=np.int64)
    base = doc * 256
    for k in range(8):
        seen = np.bincount(base + octets[:, k], minlength=n * 256).reshape(n, 256)
        out[:, 8 * k:8 * k + 8] = seen @ _BITS
    return out


def _fingerprint_block(texts: list[bytes], shingle: int) -> np.ndarray:
    """Fingerprints (uint64) of whole texts."""
    import xxhash
    digest = xxhash.xxh64_digest
    parts, counts = [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        words = t.lower().split()  # bytes: lowers A-Z and splits at 0x20 and 0x09-0x0D only
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            parts.append(digest(line, SEED))
            counts[i] = 1
            continue
        end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        start = np.concatenate(([0], end[:-1] + 1))
        k = len(words) - shingle + 1
        parts.extend(map(digest, map(line.__getitem__, map(slice, start[:k].tolist(), end[shingle - 1:].tolist())), repeat(SEED)))
        counts[i] = k
    if not parts:
        return np.zeros(len(texts), dtype=np.uint64)
    hashes = np.frombuffer(b"".join(parts), dtype=">u8").astype(np.uint64)
    out = np.zeros(len(texts), dtype=np.uint64)
    edges = np.concatenate(([0], np.cumsum(counts)))
    for lo in range(0, len(texts), 256):
        hi = min(lo + 256, len(texts))
        own = counts[lo:hi]
        ones = _bits_set(hashes[edges[lo]:edges[hi]], np.repeat(np.arange(hi - lo), own), hi - lo)
        up = (2 * ones > own[:, None]).astype(np.uint64)
        out[lo:hi] = (up << np.arange(64, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long.  Null, empty or blank text: 0."""
    def run(batches):
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col):
                fp = _fingerprint_block(texts_of(col.slice(lo, hi - lo)), shingle)
                yield record_batch(id=b.column("id").slice(lo, hi - lo), fp=pa.array(fp.view(np.int64)))

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "id long, fp long")


# -- vantage-point trees -------------------------------------------------------

def _distance(fps: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(v)).astype(np.int16)


def _split(fps: np.ndarray):
    """(vantage point, radius, distances): the candidate with the widest spread of
    distances, cut at its median; None when nothing can be cut."""
    best = None
    for c in fps[np.linspace(0, len(fps) - 1, num=min(5, len(fps))).astype(int)]:
        d = _distance(fps, c)
        mu = int(np.median(d))
        if not (d > mu).any():
            mu -= 1
        if mu >= 0 and (d > mu).any() and (best is None or d.std() > best[3]):
            best = (c, mu, d, d.std())
    return best[:3] if best else None


def fit_tree(fps: np.ndarray, depth: int, least: int) -> list:
    """Nodes (vantage point, radius, near, far); a child below 0 is shard -child-1."""
    nodes: list = []
    shards = 0

    def grow(own, depth):
        nonlocal shards
        cut_at = _split(own) if depth and len(own) >= 2 * least else None
        if cut_at is None:
            shards += 1
            return -shards
        v, mu, d = cut_at
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (int(v), mu, grow(own[d <= mu], depth - 1), grow(own[d > mu], depth - 1))
        return at

    root = grow(np.sort(fps), depth)
    return [root, nodes, shards]


def route(tree: list, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, home) for every shard that a ball of ``radius`` around a row meets."""
    root, nodes, _ = tree
    rows, shards, home = [], [], []
    todo = [(root, np.arange(len(fps)), np.ones(len(fps), dtype=bool))]
    while todo:
        at, idx, own = todo.pop()
        if not len(idx):
            continue
        if at < 0:
            rows.append(idx)
            shards.append(np.full(len(idx), -at - 1))
            home.append(own)
            continue
        v, mu, near, far = nodes[at]
        d = _distance(fps[idx], v)
        go = d <= mu + radius
        todo.append((near, idx[go], own[go] & (d[go] <= mu)))
        go = d > mu - radius
        todo.append((far, idx[go], own[go] & (d[go] > mu)))
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, dtype=t)
    return cat(rows, int), cat(shards, int), cat(home, bool)


class LocalTree:
    """Exact radius search among distinct fingerprints held in one task."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.root = self._grow(np.arange(len(fps)))

    def _grow(self, idx):
        at = _split(self.fps[idx]) if len(idx) > LEAF else None
        if at is None:
            return idx
        v, mu, d = at
        return (v, mu, self._grow(idx[d <= mu]), self._grow(idx[d > mu]))

    def pairs(self, asked: np.ndarray, radius: int):
        """Yield (asked index, own index) arrays of all pairs within ``radius``."""
        todo = [(self.root, np.arange(len(asked)))]
        while todo:
            node, q = todo.pop()
            if not len(q):
                continue
            if isinstance(node, tuple):
                v, mu, near, far = node
                d = _distance(asked[q], v)
                todo.append((near, q[d <= mu + radius]))
                todo.append((far, q[d > mu - radius]))
                continue
            own = self.fps[node]
            step = max(1, (1 << 20) // max(1, len(own)))
            for lo in range(0, len(q), step):
                part = q[lo:lo + step]
                i, j = np.nonzero(np.bitwise_count(asked[part][:, None] ^ own[None, :]) <= radius)
                yield part[i], node[j]


def link_forest(classes: DataFrame, total: int, max_bits: int = 2) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b): per task a spanning forest of all links at
    ``max_bits`` or fewer differing bits.  Exact; the sample only shapes the shards."""
    spark = classes.sparkSession
    depth = max(0, int(np.ceil(np.log2(max(1, total) / SHARD_ROWS))))
    if depth:
        picked = hash_sample(classes, ["fp"], SAMPLE_ROWS, total).select("fp").toArrow().column("fp").to_numpy()
        tree = fit_tree(np.asarray(picked, dtype=np.int64).view(np.uint64), depth, LEAF_SAMPLE)
    else:
        tree = [-1, [], 1]

    def deal(batches):
        for b in batches:
            fps = b.column("fp").to_numpy().view(np.uint64)
            rows, shards, home = route(tree, fps, max_bits)
            at_home = np.zeros(len(fps), dtype=int)
            at_home[rows[home]] = shards[home]
            keep = home | (shards > at_home[rows])
            yield record_batch(shard=shards[keep].astype(np.int32), guest=(~home[keep]).astype(np.int8), fp=fps[rows[keep]].view(np.int64))

    def search(batches):
        forest, shard, own, local = Forest(), None, [], None

        def found(tree_, asked):
            a, b = [], []
            for i, j in tree_.pairs(asked, max_bits):
                for x, y in zip(asked[i].view(np.int64).tolist(), tree_.fps[j].view(np.int64).tolist()):
                    if x != y and forest.join(x, y):
                        a.append(x)
                        b.append(y)
            return record_batch(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

        def close():
            """The shard's own rows are complete: build the tree, search it with them."""
            t = LocalTree(np.concatenate(own))
            return t, found(t, t.fps)

        for b in batches:
            sh, guest = b.column("shard").to_numpy(), b.column("guest").to_numpy()
            fp = b.column("fp").to_numpy().view(np.uint64)
            for s in np.unique(sh):  # ascending, as the rows are
                if s != shard:
                    if own and local is None:
                        yield close()[1]
                    shard, own, local = s, [], None
                mine = sh == s
                if (h := fp[mine & (guest == 0)]).size:
                    own.append(h)
                if (g := fp[mine & (guest == 1)]).size and own:
                    if local is None:
                        local, out = close()
                        yield out
                    yield found(local, g)
        if own and local is None:
            yield close()[1]

    dealt = map_arrow(classes.select("fp"), deal, "shard int, guest byte, fp long")
    n = min(max(1, tree[2]), shuffle_width(spark))
    return map_arrow(dealt.repartition(n, "shard").sortWithinPartitions("shard", "guest", "fp"), search, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per input row: (doc_id, fingerprint, component_id).

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest id
    reachable over links of ``max_bits`` or fewer bits, the document itself included.
    Null, empty or blank texts have fingerprint zero and are linked like any other.
    Repeated rows are all returned; a null id is returned as null and never names a
    component unless the whole component has none.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    edges = link_forest(classes, classes.count(), max_bits)
    label = cut(components(edges).select(F.col("node").alias("fp"), "label"))
    own = label.join(classes, "fp").groupBy("label").agg(F.min("least").alias("component_id"))
    linked = label.join(cut(own), "label").select("fp", "component_id")
    named = cut(classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return rows.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
