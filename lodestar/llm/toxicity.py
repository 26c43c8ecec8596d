"""Toxicity (operator 5): cumulative-link ordinal regression on sparse text features.

P(severity >= k) = sigmoid(w.x - t_k): one weight vector shared by all ordered
thresholds t_1 <= t_2 <= ...; the expected severity is the sum of these probabilities.
Features are the presence of hashed words and word beginnings.  The model is fitted on
a bounded sample of labelled documents (``sample_rows``, by hash of the id); scoring is
one map over all documents with the model in the closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut, hash_sample, map_arrow, one_per_id, record_batch, text_slices, texts_of
from lodestar.llm.textscan import WORD, Texts, mix

SAMPLE_ROWS = 20_000     # labelled documents the model is fitted on, at most about
STEMS = (4, 6, 8)        # word beginnings in bytes, beside the whole word
MIN_DOCS, MIN_Z = 5, 2.9  # a feature needs so many severe documents and such a log-odds z-score
SLICE = 1 << 20


class Kept:
    """Membership of 64-bit features in a sorted set: a bit table first, then the exact value."""
    BITS = 22

    def __init__(self, features: np.ndarray):
        self.features = features
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[features & ((1 << self.BITS) - 1)] = True

    def where(self, f: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[f & ((1 << self.BITS) - 1)])
        if not len(at):
            return at
        spot = np.minimum(np.searchsorted(self.features, f[at]), len(self.features) - 1)
        return at[self.features[spot] == f[at]]


def feature_hits(texts: list[bytes], kept: Kept | None = None):
    """(text, feature) of all distinct features of each text, in order; ``kept`` selects some."""
    t = Texts([x.decode("utf-8", "replace").lower().encode() for x in texts], lower=False)
    start, end, doc = t.runs(WORD)
    run = t.running()
    docs, feats = [], []
    for stem in (0, *STEMS):
        stop = end if not stem else start + stem
        ok = np.flatnonzero(stop < end) if stem else slice(None)
        h = (mix(t.hashes(run, start[ok], stop[ok]) + np.uint64(stem)) >> np.uint64(1)).astype(np.int64)
        d = doc[ok]
        if kept is not None:
            sel = kept.where(h)
            h, d = h[sel], d[sel]
        docs.append(d)
        feats.append(h)
    d, f = np.concatenate(docs), np.concatenate(feats)
    order = np.lexsort((f, d))
    d, f = d[order], f[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (f[1:] != f[:-1])
    return d[new], f[new]


def _sampled(docs: DataFrame, labels: DataFrame, id_col, text_col, target: str, sample_rows: int) -> DataFrame:
    """(y, feats) of a bounded labelled sample: about ``sample_rows`` ids, one document each (of several, the one
    whose text hashes lowest); several labels of one id: the highest."""
    known = cut(labels.select(F.col(id_col).alias("id"), F.col(target).cast("int").alias("y"))
                .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")))
    pick = hash_sample(known, ["id"], sample_rows, known.count())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(pick), "id")
    rows = one_per_id(rows).select("y", "text")

    def run(batches):
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                d, f = feature_hits(texts_of(col.slice(lo, hi - lo)))
                edge = np.searchsorted(d, np.arange(hi - lo + 1))
                yield record_batch(y=b.column("y").slice(lo, hi - lo),
                                   feats=pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(f, pa.int64())))

    return cut(map_arrow(rows, run, "y int, feats array<long>"))


@dataclass
class Ordinal:
    """Weights of the kept features and the ordered thresholds."""
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(1, 30.0))

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """(n, K) P(severity >= k)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_cols: int, l2: float = 1e-4, steps: int = 600):
    """Weights and thresholds of a cumulative-link (logit) model by Adam on the mean
    negative log-likelihood; x is 0/1 with ones at (rows, cols)."""
    n, top = len(y), int(y.max())
    share = np.array([np.clip((y >= k).mean(), 1e-6, 1 - 1e-6) for k in range(1, top + 1)])
    base = np.log((1 - share) / share)
    theta = np.concatenate((np.zeros(n_cols), base[:1], np.log(np.maximum(np.diff(base), 1e-3))))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, first, gaps = theta[:n_cols], theta[n_cols], np.exp(theta[n_cols + 1:])
        t = np.concatenate(([-np.inf], first + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        score = np.bincount(rows, w[cols], minlength=n)
        low = 1 / (1 + np.exp(np.clip(t[y] - score, -60, 60)))       # P(>= y)
        high = 1 / (1 + np.exp(np.clip(t[y + 1] - score, -60, 60)))  # P(>= y + 1)
        low[y == 0], high[y == top] = 1.0, 0.0
        p = np.maximum(low - high, 1e-12)
        dl, dh = low * (1 - low), high * (1 - high)
        g_score = -(dl - dh) / p / n
        g_t = np.zeros(top + 2)
        np.add.at(g_t, y, dl / p / n)
        np.add.at(g_t, y + 1, -dh / p / n)
        g_t = g_t[1:top + 1]
        tail = np.cumsum(g_t[::-1])[::-1]
        grad = np.concatenate((np.bincount(cols, g_score[rows], minlength=n_cols) + l2 * w, tail[:1], tail[1:] * gaps))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    first, gaps = theta[n_cols], np.exp(theta[n_cols + 1:])
    return theta[:n_cols], first + np.concatenate(([0.0], np.cumsum(gaps)))


def marked_features(sample: DataFrame) -> tuple[np.ndarray, int]:
    """Features that lean significantly to or from documents with y >= 1, and the row count."""
    n, pos = sample.agg(F.count("*"), F.sum((F.col("y") > 0).cast("long"))).first()
    if not n or not pos or pos == n:
        return np.zeros(0, dtype=np.int64), n or 0
    seen = sample.select("y", F.explode("feats").alias("f")).groupBy("f").agg(
        F.count("*").alias("c"), F.sum((F.col("y") > 0).cast("long")).alias("p"))
    a, b = F.col("p") + 0.5, F.col("c") - F.col("p") + 0.5
    c, d = F.lit(pos) - F.col("p") + 0.5, F.lit(n - pos) - (F.col("c") - F.col("p")) + 0.5
    z = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    kept = seen.where((F.col("p") >= MIN_DOCS) & (z >= MIN_Z)).select("f").toArrow().column("f").to_numpy()
    return np.sort(kept.astype(np.int64)), n


def _matrix(sample: DataFrame, features: np.ndarray):
    """The sample reduced to the kept features: (rows, cols, y) on the driver."""
    def run(batches):
        for b in batches:
            col = b.column("feats")
            f = col.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
            at = np.searchsorted(features, f)
            ok = features[np.minimum(at, len(features) - 1)] == f
            row, at = row[ok], at[ok]
            edge = np.searchsorted(row, np.arange(len(col) + 1))
            yield record_batch(y=b.column("y"), cols=pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(at, pa.int32())))

    got = map_arrow(sample, run, "y int, cols array<int>").toArrow().combine_chunks()
    y = got.column("y").to_numpy().astype(np.int64)
    cols = got.column("cols").combine_chunks() if got.num_rows else None
    sizes = np.array([len(c) for c in cols]) if cols is not None else np.zeros(0, int)
    flat = cols.flatten().to_numpy().astype(np.int64) if cols is not None else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(y)), sizes), flat, y


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, levels: tuple = (3, 6)) -> Ordinal:
    """Fit on labelled documents.  A target with grades 0, 1, 2, ... is used as it is.  A
    0/1 target is spread into grades: a labelled document is a grade higher for each
    entry of ``levels`` that its number of marked features reaches.  Without labels of
    both kinds the model calls nothing severe."""
    sample = _sampled(docs, labels, id_col, text_col, target, sample_rows)
    features, n = marked_features(sample)
    if not len(features):
        return Ordinal()
    rows, cols, y = _matrix(sample, features)
    if y.max() == 1:
        marks = np.bincount(rows, minlength=len(y))
        y = np.where(y > 0, 1 + sum((marks >= k).astype(np.int64) for k in levels), 0)
        y = np.unique(y, return_inverse=True)[1]  # grades nobody has are left out
    w, t = fit_ordinal(rows, cols, y, len(features))
    return Ordinal(features, w, t)


def _scores(texts: list[bytes], model: Ordinal, kept: Kept) -> np.ndarray:
    if not len(model.features):
        return np.zeros(len(texts))
    d, f = feature_hits(texts, kept)
    return np.bincount(d, model.weights[np.searchsorted(model.features, f)], minlength=len(texts))


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", cutoff: float = 0.5) -> DataFrame:
    """One row per input row: (doc_id, severity, p_toxic, grade, toxic).

    ``severity`` is the expected grade, ``p_toxic`` P(grade >= 1), ``grade`` the most
    likely grade (ties: the lower), ``toxic`` p_toxic >= ``cutoff``.  Null and empty texts have no
    feature: their scores come from the thresholds alone.
    """
    def run(batches):
        kept = Kept(model.features)
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                up = model.at_least(_scores(texts_of(col.slice(lo, hi - lo)), model, kept))
                each = np.concatenate((np.ones((hi - lo, 1)), up), axis=1) - np.concatenate((up, np.zeros((hi - lo, 1))), axis=1)
                yield record_batch(doc_id=b.column("id").slice(lo, hi - lo), severity=up.sum(axis=1), p_toxic=up[:, 0],
                                   grade=each.argmax(axis=1).astype(np.int32), toxic=up[:, 0] >= cutoff)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run,
                     "doc_id long, severity double, p_toxic double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: Ordinal, text_col: str = "text", cutoff: float = 0.5) -> DataFrame:
    """The rows that are not toxic, with all their columns.  Rows are judged one by one by their text alone: null and
    empty texts have no feature and stay unless the thresholds alone call them toxic; repeated rows stay or go
    together; null and repeated ids are no matter."""
    def run(batches):
        kept = Kept(model.features)
        for b in batches:
            col = b.column(text_col)
            for lo, hi in text_slices(col, SLICE):
                up = model.at_least(_scores(texts_of(col.slice(lo, hi - lo)), model, kept))
                yield b.slice(lo, hi - lo).filter(pa.array(up[:, 0] < cutoff))

    return map_arrow(docs, run, docs.schema)
