"""Quality classifier (operator 4): hierarchical empirical Bayes over hosts and paths.

A classifier on the shape of a text gives every document a probability of good quality.
Grouped sums of these (and of the labels, where known) give each host and each path of a host a
posterior rate: a host's rate is shrunk towards the global rate and a path's towards its
host's, by prior strengths estimated from the spread of the rates themselves, so sparse
sites stay close to their parent.  A document's posterior log-odds are its own evidence plus its
path's log-odds against the global ones, the document itself left out of its site's sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut, hash_sample, map_arrow, one_per_id, record_batch, text_slices, texts_of
from lodestar.llm.textscan import WORD, Texts, byte_table, mix
from lodestar.llm.toxicity import fit_ordinal

SAMPLE_ROWS = 20_000       # labelled documents that the classifier is fitted on, at most about
BINS = 24                  # levels of each measure
BROADCAST_SITES = 100_000  # site rates are broadcast up to this many rows, else joined
SLICE = 1 << 20

_CLASSES = {
    "upper": byte_table(lambda b: 65 <= b <= 90), "digit": byte_table(lambda b: 48 <= b <= 57), "space": byte_table(lambda b: b == 32 or 9 <= b <= 13),
    "line": byte_table(lambda b: b == 10), "bar": byte_table(lambda b: b == 124), "shout": byte_table(lambda b: b == 33),
    "mark": byte_table(lambda b: 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126), "odd": byte_table(lambda b: chr(b) in "#$%&*<>=@^{}~\\")}
MEASURES = [*_CLASSES, "words", "word_size", "distinct", "stutter", "marked"]


def measure(texts: list[bytes]) -> np.ndarray:
    """(n, measures): shares of byte classes, log word count, mean word size, share of distinct
    words, of words equal to the one before, and of words with a mark of no sentence behind them."""
    t = Texts(texts, lower=False)
    n = np.maximum(t.size, 1)
    out = np.zeros((len(texts), len(MEASURES)))
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[t.offsets])
    for k, table in enumerate(_CLASSES.values()):
        out[:, k] = total(table[t.buf]) / n
    start, end, doc = t.runs(WORD)
    words = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
    h = mix(t.hashes(t.running(), start, end))
    k = len(_CLASSES)
    out[:, k] = np.log(words)
    out[:, k + 1] = np.bincount(doc, end - start, minlength=len(texts)) / words
    order = np.lexsort((h, doc))
    d, g = doc[order], h[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    out[:, k + 2] = np.bincount(d[new], minlength=len(texts)) / words
    again = np.zeros(len(doc), dtype=bool)
    again[1:] = (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
    out[:, k + 3] = np.bincount(doc[again], minlength=len(texts)) / words
    follow = np.concatenate((t.buf, np.full(1, 32, dtype=np.uint8)))[end]
    odd = _CLASSES["odd"][follow] & (end < t.offsets[doc + 1])
    out[:, k + 4] = np.bincount(doc[odd], minlength=len(texts)) / words
    return out


@dataclass
class Shape:
    """Additive model over the levels of each measure: P(good) = sigmoid(sum of weights - threshold)."""
    edges: list
    weights: np.ndarray
    threshold: float

    def levels(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") + k * (BINS + 1) for k, e in enumerate(self.edges)], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), 1 / (1 + np.exp(self.threshold)))
        return 1 / (1 + np.exp(np.clip(self.threshold - self.weights[self.levels(x)].sum(axis=1), -30, 30)))


def fit_shape(docs: DataFrame, known: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Shape:
    """(id, text) documents and (id, y) labels -> the shape model, on a bounded sample: about
    ``sample_rows`` labelled ids, one document each (of several, the one whose text hashes lowest)."""
    pick = hash_sample(known, ["id"], sample_rows, known.count())
    docs = one_per_id(docs.join(F.broadcast(pick), "id"))

    def run(batches):
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                x = measure(texts_of(col.slice(lo, hi - lo)))
                yield record_batch(y=b.column("y").slice(lo, hi - lo), x=pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())))

    got = map_arrow(docs.select("y", "text"), run, "y int, x array<double>").toArrow().combine_chunks()
    y = got.column("y").to_numpy().astype(np.int64)
    if len(y) < 2 or y.min() == y.max():
        rate = float(np.clip((y.sum() + 1) / (len(y) + 2), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        return Shape([], np.zeros(0), float(np.log((1 - rate) / rate)))
    x = np.stack(got.column("x").to_pylist())
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    shape = Shape(edges, np.zeros(len(edges) * (BINS + 1)), 0.0)
    cols = shape.levels(x)
    rows = np.repeat(np.arange(len(y)), cols.shape[1])
    shape.weights, t = fit_ordinal(rows, cols.ravel(), y, len(shape.weights), l2=1e-4, steps=400)
    shape.threshold = float(t[0])
    return shape


def _strength(groups: DataFrame, rate: str, parent: str) -> float:
    """Prior strength by moments: how many documents the parent's rate counts as.  The
    spread of group rates around the parent beyond what their sizes explain is the prior's variance."""
    m, v = F.col(parent), F.col(parent) * (1 - F.col(parent))
    got = groups.where("n > 1").agg(
        F.sum(F.col("n") * (F.col(rate) - m) ** 2).alias("spread"), F.sum(v).alias("noise"), F.sum(F.col("n") * v).alias("weight"), F.count("*").alias("c")).first()
    if not got.c or not got.weight:
        return 1.0
    share = max(1e-4, min(1.0, (got.spread - got.noise) / got.weight))  # prior variance over m(1 - m)
    return 1 / share


def _logit(p):
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
          target: str = "quality", sample_rows: int = SAMPLE_ROWS, cutoff: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, host, path, p_doc, host_rate, path_rate, posterior, kept.

    ``kept``: posterior >= ``cutoff``.  A null host or path is a group of its own.  Several labels of one id:
    the lowest counts.  Null and empty texts are measured as empty.  Without labels of
    both kinds every document has the same evidence and the sites decide nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"),
                       F.col(text_col).alias("text"))
    known = cut(labels.select(F.col(id_col).cast("long").alias("id"), F.col(target).cast("int").alias("y")).where("id is not null and y is not null")
                .groupBy("id").agg(F.min("y").alias("y")))
    shape = fit_shape(rows.select("id", "text"), known, sample_rows)

    def run(batches):
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                p = shape.probability(measure(texts_of(col.slice(lo, hi - lo))))
                yield record_batch(**{c: b.column(c).slice(lo, hi - lo) for c in ("id", "host", "path")}, p=p)

    seen = map_arrow(rows, run, "id long, host string, path string, p double")
    seen = cut(seen.join(known, "id", "left").withColumn("s", F.coalesce(F.when(F.col("y") > 0, 1.0).when(F.col("y") <= 0, 0.0), "p")))
    paths = cut(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("s").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    n, s = paths.agg(F.sum("n"), F.sum("s")).first()
    rate = (s + 0.5) / (n + 1) if n else 0.5
    k = _strength(hosts.select("n", (F.col("s") / F.col("n")).alias("r"), F.lit(rate).alias("m")), "r", "m")
    hosts = cut(hosts.select("host", ((F.col("s") + k * rate) / (F.col("n") + k)).alias("host_rate")))
    sites = cut(paths.join(hosts, paths.host.eqNullSafe(hosts.host)).select(paths.host, "path", "n", "s", "host_rate"))
    j = _strength(sites.select("n", (F.col("s") / F.col("n")).alias("r"), F.col("host_rate").alias("m")), "r", "m")
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("q"), F.col("n").alias("site_n"), F.col("s").alias("site_s"), "host_rate")
    out = seen.join(sites, seen.host.eqNullSafe(F.col("h")) & seen.path.eqNullSafe(F.col("q")))
    others = (F.col("site_s") - F.col("s") + j * F.col("host_rate")) / (F.col("site_n") - 1 + j)
    odds = _logit(F.col("p")) + _logit(F.col("path_rate")) - _logit(F.lit(rate))
    return (out.withColumn("path_rate", others).withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .select(F.col("id").alias("doc_id"), "host", "path", F.col("p").alias("p_doc"), "host_rate", "path_rate", "posterior",
                    (F.col("posterior") >= cutoff).alias("kept")))
