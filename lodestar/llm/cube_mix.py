"""Mixing sources to target weights (operator 13): cube-method balanced sampling.

A source's target over its size says how often its documents are read: a whole number of
times, and once more with a probability, the fraction.  The cube method turns these fractions
into 0 or 1 while it keeps the two totals of every source, documents and words: it takes three
undecided documents, moves their probabilities along the direction in which neither total
changes, up or down at random, until one of them is 0 or 1, and goes on with the next.

Each source is dealt over buckets of bounded size; a bucket ends with at most two
undecided documents, which meet those of other buckets in the next level, until one bucket is
left.  That last bucket ends with a small landing problem: a few documents held back and the
undecided ones, set to the combination whose totals miss the least.  Random numbers come from hashes
of the documents, so the result depends neither on the layout of the rows nor on retries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.ranking import exact_rank
from lodestar.llm.common import cut, unused
from lodestar.session import ship_package

WEIGHTS = (3, 1, 2)
SHARE = 1.5           # words of the mix over words of the documents
CAP = 2.0             # a source's target over its size, at most
BUCKET = 1 << 14      # units a task decides at a time
LARGE, MIXED = 6, 9   # units held back for the landing: the largest, and some at random
COPIES = 1 << 12      # copies of a repeated row written out at a time
_TINY = 1e-9
_SIZE = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, h, copies): rows with equal id, source and text hash together, with their number."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(_SIZE))).cast("long").alias("size"),
        F.xxhash64(F.lit("cube"), F.col(id_col).cast("long"), text, F.col(source_col).cast("string")).alias("h"),
    ).groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("copies"))


def targets(units: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt to the sources by weight; a target
    stops at ``cap`` times its source's size and the excess goes to the others by weight.

    Sources are ranked by code point, null last, by a distributed sort; each round of resharing
    is one sum over the source table.
    """
    table = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranked = exact_rank(cut(table), [F.asc_nulls_last("source")], name="rank")
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int"))
    ranked = cut(ranked.select("source", "source_size", w.alias("w")))
    most = F.lit(cap) * F.col("source_size")
    unit = None  # words a weight of one receives; it grows until no target is above its stop
    while True:
        stopped = F.lit(False) if unit is None else F.col("w") * F.lit(unit) >= most
        got = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(stopped, most).otherwise(0.0)).alias("held"),
                         F.sum(F.when(stopped, 0.0).otherwise(F.col("w"))).alias("open")).first()
        left = share * (got["all"] or 0) - (got.held or 0.0)
        now = left / got.open if got.open else unit or 0.0
        if unit is not None and now <= unit * (1 + 1e-12):
            break
        unit = now
    return ranked.select("source", "source_size", F.least(F.col("w") * F.lit(float(unit)), most).alias("target"))


def _uniform(h: np.ndarray, step: int) -> np.ndarray:
    """Random numbers in [0, 1) from the hashes of the units (finaliser of splitmix64)."""
    x = h.astype(np.uint64) + np.uint64((step * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def flight(size: np.ndarray, pi: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Moves ``pi`` until at most two entries are strictly between 0 and 1; sum(pi) and
    sum(pi * size) stay as they are.  The direction for three units is the cross product of
    the rows (1, 1, 1) and (their sizes); it goes up or down so that every expectation is kept."""
    pi = pi.astype(np.float64).copy()
    held: list[int] = []
    for k in np.flatnonzero((pi > _TINY) & (pi < 1 - _TINY)).tolist():
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = (float(size[i]) for i in held)
        move = (c - b, a - c, b - a)
        if not any(move):
            move = (1.0, -1.0, 0.0)
        now = [pi[i] for i in held]
        up = min((1 - p) / m if m > 0 else -p / m for p, m in zip(now, move) if m)
        down = min(p / m if m > 0 else (p - 1) / m for p, m in zip(now, move) if m)
        step = up if luck[k] * (up + down) < down else -down
        for i, p, m in zip(held, now, move):
            p += step * m
            pi[i] = 0.0 if p <= _TINY else 1.0 if p >= 1 - _TINY else p
        held = [i for i in held if 0.0 < pi[i] < 1.0]
    return np.where(pi <= _TINY, 0.0, np.where(pi >= 1 - _TINY, 1.0, pi))


def land(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """0 or 1 for a few units: of all combinations the one that misses the total of words
    least, one document counting as a hundredth of the mean size; ties: the first in binary order."""
    n = len(pi)
    pick = ((np.arange(1 << n)[:, None] >> np.arange(n)) & 1).astype(np.float64)
    words = np.abs(pick @ size - (pi * size).sum())
    miss = words + 0.01 * max(size.mean(), 1.0) * np.abs(pick.sum(axis=1) - pi.sum()) if n else words
    return pick[int(miss.argmin())]


def decide(size: np.ndarray, pi: np.ndarray, h: np.ndarray, last: bool) -> np.ndarray:
    """One bucket: flight, and in a source's last bucket the landing of what is left and held back."""
    luck = _uniform(h, 1)
    if not last:
        return flight(size, pi, luck)
    open_ = np.flatnonzero((pi > _TINY) & (pi < 1 - _TINY))
    by_size = open_[np.argsort(-size[open_], kind="stable")]
    rest = by_size[LARGE:]
    back = np.concatenate((by_size[:LARGE], rest[np.argsort(_uniform(h[rest], 2), kind="stable")[:MIXED]]))
    out = np.where(pi >= 1 - _TINY, 1.0, np.where(pi <= _TINY, 0.0, pi))
    flown = np.setdiff1d(open_, back)
    out[flown] = flight(size[flown], pi[flown], luck[flown])
    left = np.concatenate((back, flown[(out[flown] > 0) & (out[flown] < 1)]))
    out[left] = land(size[left].astype(np.float64), out[left])
    return out


_UNIT = "doc_id long, source string, size long, h long, copies long, source_size long, target double, base long, sure long, n long, buckets long, pi double"


def _level(units: DataFrame, salt: int) -> DataFrame:
    """One level: units of a source are dealt over its ``buckets`` by hash, each bucket is decided."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        col = {c: group.column(c).fill_null(0).to_numpy(zero_copy_only=False) if c == "doc_id" else group.column(c).to_numpy() for c in ("h", "doc_id", "size", "pi", "buckets")}
        order = np.lexsort((col["size"], col["doc_id"], col["h"]))
        group = group.take(pa.array(order)).drop(["bucket"])
        pi = decide(col["size"][order], col["pi"][order], col["h"][order], bool(col["buckets"][0] == 1))
        return group.set_column(group.column_names.index("pi"), "pi", pa.array(pi))

    ship_package(units.sparkSession)
    dealt = units.withColumn("bucket", F.pmod(F.xxhash64(F.lit(salt), "h"), F.col("buckets")))
    return dealt.groupBy("source", "bucket").applyInArrow(run, _UNIT)


def _bucket_count(units: str):
    return F.ceil(F.col(units) / F.lit(float(BUCKET))).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per input row; ``taken`` is size times the
    number of times the mix reads the document.

    A null source is a source of its own, ranked last; null and empty texts have size 0 and are never
    missed nor in the way.  Repeated rows (equal id, source and text) are exchangeable: their joint expectation is
    split into whole picks and one undecided copy.  An empty table gives an empty result.  Other columns are not looked at.
    """
    units = cut(sizes(docs, id_col, text_col, source_col))
    goal = cut(targets(units, weights, share, cap))
    own = unused(units, "own_source")
    goal = goal.withColumnRenamed("source", own)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio + F.lit(_TINY)).cast("long")
    expected = F.greatest(ratio - F.col("base"), F.lit(0.0)) * F.col("copies")
    units = units.join(goal, units.source.eqNullSafe(F.col(own))).drop(own)
    units = units.withColumn("base", base).withColumn("sure", F.floor(expected + F.lit(_TINY)).cast("long")).withColumn(
        "pi", F.greatest(expected - F.col("sure"), F.lit(0.0)))
    undecided = (F.col("pi") > _TINY) & (F.col("pi") < 1 - _TINY)
    units = cut(units)
    done = units.where(~undecided)
    todo, level = units.where(undecided), 0
    while True:
        counts = todo.groupBy("source").agg(F.count("*").alias("n")).withColumn("buckets", _bucket_count("n")).withColumnRenamed("source", own)
        counts = cut(counts)
        most = counts.agg(F.max("buckets")).first()[0]
        if not most:
            break
        dealt = todo.drop("n", "buckets").join(counts, todo.source.eqNullSafe(F.col(own))).drop(own)
        moved = cut(_level(dealt.select(*[c.split()[0] for c in _UNIT.split(", ")]), level))
        done = done.unionByName(moved.where(~undecided).drop("n", "buckets"))
        if most == 1:
            break
        todo, level = moved.where(undecided), level + 1
    picks = F.col("sure") + F.when(F.col("pi") >= 1 - _TINY, 1).otherwise(0)
    done = done.withColumn("picks", picks)
    once = done.where("copies = 1").select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("base") + F.col("picks"))).alias("taken"))
    return once.unionByName(_copies(done.where("copies > 1")))


def _copies(done: DataFrame) -> DataFrame:
    """Rows of repeated documents written out: first in chunks, which are dealt over all tasks, then one by one."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))).alias("chunk")
    dealt = done.select("*", chunk).repartition("h", "doc_id", "chunk")
    first = F.col("chunk") * COPIES
    each = F.explode(F.sequence(first, F.least(first + COPIES, F.col("copies")) - 1)).alias("at")
    times = F.col("base") + F.when(F.col("at") < F.col("picks"), 1).otherwise(0)
    return dealt.select("*", each).select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))
