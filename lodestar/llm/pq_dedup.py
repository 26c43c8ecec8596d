"""Embedding near-duplicates (operator 6): product quantisation with an exact rerank.

Equal vectors of one label are one class with a weight, so copies are never paired.
Classes go to inverted lists by their nearest coarse centre; a residual is coded as one
centre per subspace, and its coding error is kept.  Links need cosine >= t, that is a distance of
at most r = sqrt(2 - 2t) between unit vectors, which makes both prunings lossless:

* a class must probe list j when its distance to the bisector of its own centre and
  centre j is at most r: only then can a vector of list j lie within r;
* a coded member y with error e can lie within r of x only if the table-lookup
  distance to its code is at most r + e.

What passes is compared by exact cosine in double precision.  The centres are fitted on a
bounded sample; every class is indexed.  Large (label, list) groups are cut into
blocks that all their guests visit, and each task returns link counts and a spanning
forest, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import Forest, cut, hash_sample, map_arrow, record_batch, shuffle_width
from lodestar.llm.components import components

SAMPLE_ROWS = 16_384       # classes the centres are fitted on, at most about
SAMPLE_BYTES = 64 << 20    # and of so many bytes
LIST_ROWS = 2_048          # classes per list aimed at, before labels cut them further
MOST_LISTS = 512           # the sample supports no more centres
SUBSPACES, CODES = 8, 256
BLOCK_ROWS = 8_192         # members of a (label, list) block
BROADCAST_GROUPS = 50_000  # (label, list) sizes are broadcast up to this many, else joined
_CELLS = 1 << 20           # numbers in one distance block


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :], 0)


def lloyd(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Centres of ``k`` groups; starts from evenly spaced rows, an empty group keeps its centre."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        near = np.concatenate([_squares(x[lo:lo + 4096], c).argmin(axis=1) for lo in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass
class Quantizer:
    """Coarse centres and the codebook of each subspace, for vectors of ``dim``."""
    dim: int
    centres: np.ndarray
    books: list

    def spans(self):
        lo = 0
        for b in self.books:
            yield lo, lo + b.shape[1], b
            lo += b.shape[1]

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, coding error) of residuals."""
        codes, off = [], np.zeros(len(residuals))
        for lo, hi, book in self.spans():
            d = _squares(residuals[:, lo:hi], book)
            code = d.argmin(axis=1)
            codes.append(code)
            off += ((residuals[:, lo:hi] - book[code]) ** 2).sum(axis=1)
        return np.stack(codes, axis=1), np.sqrt(off)

    def lookup(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of residuals to coded members, by table look-up."""
        out = np.zeros((len(residuals), len(codes)))
        for m, (lo, hi, book) in enumerate(self.spans()):
            out += _squares(residuals[:, lo:hi], book)[:, codes[:, m]]
        return np.sqrt(out)

    def route(self, x: np.ndarray, radius: float):
        """(row, list, at home) for each list that may hold a vector within ``radius``."""
        d = _squares(x, self.centres)
        home = d.argmin(axis=1)
        apart = np.sqrt(_squares(self.centres, self.centres))[home]
        gap = d - d[np.arange(len(x)), home][:, None]
        row, at = np.nonzero(gap <= 2 * apart * radius + 1e-9)
        own = at == home[row]
        keep = own | (at > home[row])  # a pair in two lists is found from the lower one
        return row[keep], at[keep], own[keep]


def fit(sample: np.ndarray, classes: int) -> Quantizer:
    """Centres from unit vectors; few sampled rows give few centres and codes."""
    n, dim = sample.shape
    k = int(np.clip(classes // LIST_ROWS, 1, min(MOST_LISTS, max(1, n // 16))))
    centres = lloyd(sample, k)
    residuals = sample - centres[_squares(sample, centres).argmin(axis=1)]
    parts = [p for p in np.array_split(np.arange(dim), min(SUBSPACES, dim)) if len(p)]
    return Quantizer(dim, centres, [lloyd(residuals[:, p], int(min(CODES, max(1, n // 8)))) for p in parts])


def _matrix(col) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


class Block:
    """Members of one (label, list) block, ready to be searched."""

    def __init__(self, q: Quantizer, at: int, x: np.ndarray, cid: np.ndarray, weight: np.ndarray, cosine: float):
        self.q, self.x, self.cid, self.weight, self.cosine = q, x, cid, weight, cosine
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-7
        self.coded = q.dim == x.shape[1]
        self.links = np.zeros(len(x), dtype=np.int64)
        if self.coded:
            self.centre = q.centres[at]
            self.codes, self.error = q.encode(x - self.centre)

    def search(self, x: np.ndarray, cid: np.ndarray, weight: np.ndarray, forest: Forest, own: bool):
        """Links of rows with the members: (links of each row, forest edges)."""
        links, edges = np.zeros(len(x), dtype=np.int64), []
        step = max(1, _CELLS // max(1, len(self.x)))
        for lo in range(0, len(x), step):
            part = x[lo:lo + step]
            if self.coded:
                near = self.q.lookup(part - self.centre, self.codes) <= self.radius + self.error[None, :] + 1e-7
            else:
                near = np.ones((len(part), len(self.x)), dtype=bool)
            i, j = np.nonzero(near)
            if own:
                i, j = i[j > i + lo], j[j > i + lo]
            ok = np.concatenate([np.einsum("ij,ij->i", part[i[a:a + 65536]], self.x[j[a:a + 65536]]) >= self.cosine
                                 for a in range(0, len(i), 65536)]) if len(i) else np.zeros(0, dtype=bool)
            i, j = i[ok] + lo, j[ok]
            if not len(i):
                continue
            links += np.bincount(i, self.weight[j], minlength=len(x)).astype(np.int64)
            self.links += np.bincount(j, weight[i], minlength=len(self.x)).astype(np.int64)
            for a, b in zip(*_stars(cid[i], self.cid[j])):
                if forest.join(a, b):
                    edges.append((a, b))
        if own:
            self.links += links
        return links, edges


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """Edges (node, smallest node of its component) of the graph of pairs (a, b)."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == old).all():
            break
    own = label != np.arange(len(ids))
    return ids[own].tolist(), ids[label[own]].tolist()


def _links(classes: DataFrame, quantizer: Quantizer, cosine: float) -> DataFrame:
    """(a, b, n): forest edges a-b, and with null b the number n of vectors linked to class a."""
    spark = classes.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-7

    def deal(batches):
        for b in batches:
            if not b.num_rows:
                continue
            vec, size = b.column("vec"), np.diff(b.column("vec").offsets.to_numpy())
            fit_rows = np.flatnonzero(size == quantizer.dim)
            row, at, own = np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
            if len(fit_rows):
                for lo in range(0, len(fit_rows), 4096):
                    rows = fit_rows[lo:lo + 4096]
                    r, a, o = quantizer.route(unit(_matrix(vec.take(pa.array(rows)))), radius)
                    row, at, own = np.concatenate((row, rows[r])), np.concatenate((at, a)), np.concatenate((own, o))
            odd = np.flatnonzero(size != quantizer.dim)  # another dimension: one list, no codes
            row, at, own = np.concatenate((row, odd)), np.concatenate((at, np.zeros(len(odd), int))), np.concatenate((own, np.ones(len(odd), bool)))
            take = pa.array(row)
            yield record_batch(grp=b.column("grp").take(take), list=at.astype(np.int32), guest=(~own).astype(np.int8),
                               cid=b.column("cid").take(take), w=b.column("w").take(take), vec=vec.take(take))

    kinds = "grp string, list int, guest byte, cid long, w long, vec array<double>"
    dealt = map_arrow(classes.select("grp", "cid", "w", "vec"), deal, kinds)
    sizes = cut(dealt.where("guest = 0").groupBy("grp", "list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")))
    if sizes.count() <= BROADCAST_GROUPS:
        sizes = F.broadcast(sizes)
    home = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    visits = F.when(F.col("guest") == 0, F.concat(
        F.array(F.struct(home.alias("block"), F.lit(0).cast("byte").alias("guest"))),
        F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k > home),
                    lambda k: F.struct(k.alias("block"), F.lit(1).cast("byte").alias("guest"))))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(k.alias("block"), F.lit(1).cast("byte").alias("guest"))))
    spread = dealt.join(sizes, ["grp", "list"]).withColumn("v", F.explode(visits)).select(
        "grp", "list", F.col("v.block").alias("block"), F.col("v.guest").alias("guest"), "cid", "w", "vec")

    def search(batches):
        forest, key, own, block, at = Forest(), None, [], None, 0

        def out(edges, cid=(), links=()):
            cid, links = np.asarray(cid, dtype=np.int64), np.asarray(links, dtype=np.int64)
            cid, links = cid[links > 0], links[links > 0]
            a = [x for x, _ in edges] + cid.tolist()
            b = [y for _, y in edges] + [None] * len(cid)
            return record_batch(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()), n=pa.array([None] * len(edges) + links.tolist(), pa.int64()))

        def build():
            x, cid, w = (np.concatenate(p) for p in zip(*own))
            made = Block(quantizer, at, x, cid, w, cosine)
            return made, made.search(x, cid, w, forest, True)[1]

        def finish():
            nonlocal block
            if own:
                edges = []
                if block is None:
                    block, edges = build()
                yield out(edges, block.cid, block.links)
            block = None

        for b in batches:
            if not b.num_rows:
                continue
            grp, lists, blocks = b.column("grp").to_pylist(), b.column("list").to_numpy(), b.column("block").to_numpy()
            guest = b.column("guest").to_numpy()
            keys = list(zip(grp, lists.tolist(), blocks.tolist()))
            lo = 0
            while lo < len(keys):
                hi = lo + 1
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != key:
                    yield from finish()
                    key, own, at = keys[lo], [], int(lists[lo])
                x = unit(_matrix(b.column("vec").slice(lo, hi - lo)))
                cid, w, g = b.column("cid").to_numpy()[lo:hi], b.column("w").to_numpy()[lo:hi], guest[lo:hi] == 1
                if (~g).any():
                    own.append((x[~g], cid[~g], w[~g]))
                if g.any() and own:
                    edges = []
                    if block is None:
                        block, edges = build()
                    links, more = block.search(x[g], cid[g], w[g], forest, False)
                    yield out(edges + more, cid[g], links)
                lo = hi
        yield from finish()

    n = shuffle_width(spark)
    return map_arrow(spread.repartition(n, "grp", "list", "block").sortWithinPartitions("grp", "list", "block", "guest", "cid"),
                     search, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = 0.98) -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Vectors link when labels are equal and not null and the cosine is ``cosine`` or more.
    Vectors that are null, empty, zero or hold null or non-finite numbers, or of different
    dimension, link with nothing; such a row is its own component.  Repeated rows are
    vectors of their own.  A null id never names a component unless it has no other.
    """
    vec = F.col("vec")
    fine = (F.col("label").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0.0))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + 0.0).alias("vec"))
    rows = rows.select("id", F.when(F.coalesce(fine, F.lit(False)), F.concat_ws("|", F.size(vec).cast("string"), "label")).alias("grp"), "vec",
                       F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))  # 128 bits name a vector
    narrow = cut(rows.select("id", "grp", "h1", "h2"))
    classes = (rows.where("grp is not null").groupBy("grp", "h1", "h2")
               .agg(F.first("vec").alias("vec"), F.min("id").alias("least"), F.count("*").alias("w")))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    total, widest = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    found = None
    if total:
        most = min(SAMPLE_ROWS, max(64, SAMPLE_BYTES // (8 * widest)))
        picked = hash_sample(classes, ["h1"], most, total).select("vec").toArrow().column("vec").combine_chunks()
        size = np.diff(picked.offsets.to_numpy())
        dim = int(np.bincount(size).argmax()) if len(size) else int(widest)
        sample = picked.take(pa.array(np.flatnonzero(size == dim))) if len(size) else classes.where(
            F.size("vec") == dim).select("vec").limit(64).toArrow().column("vec").combine_chunks()
        found = cut(_links(classes, fit(unit(_matrix(sample)), total), cosine))
    else:
        found = classes.select(F.col("cid").alias("a"), F.col("cid").alias("b"), F.col("w").alias("n"))
    counts = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    label = cut(components(found.where("b is not null").select("a", "b")).select(F.col("node").alias("cid"), F.col("label").alias("root")))
    least = cut(label.join(classes.select("cid", "least"), "cid").groupBy("root").agg(F.min("least").alias("component_id")))
    named = label.join(least, "root").select("cid", "component_id")
    named = cut(classes.select("grp", "h1", "h2", "cid", "least", "w").join(counts, "cid", "left").join(named, "cid", "left").select(
        "grp", "h1", "h2", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"),
        F.lit(True).alias("indexed")))
    out = narrow.join(named, ["grp", "h1", "h2"], "left")
    component = F.when(F.col("indexed"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
