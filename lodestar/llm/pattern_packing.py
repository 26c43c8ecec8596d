"""Best-fit packing (operator 10): length patterns fitted by non-negative least squares.

Documents become token counts, and only the histogram of piece lengths (one entry per
length up to the sequence size, whatever the corpus) reaches the driver.  There, patterns of
two to four lengths that fill a sequence exactly are enumerated, their repeat counts
are fitted to the histogram by non-negative least squares and rounded down, twice more
on what is left, and the residual is packed best fit first, longest pieces first, run by run of
equal lengths.  The plan is a table of runs (length, first rank) -> (sequence, offset);
tasks give every piece its rank among the pieces of its length and look it up.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import cut, map_arrow, record_batch, text_slices, texts_of

CAPACITY = 4096
END_ID = 1
SLICE = 1 << 20
CACHE_PARTS = 600_000    # word parts a task remembers between texts

# Fixed value: how the tokenizer cuts text, for lower-cased ASCII and Latin letters (each
# match is a part of its own: nothing is carried across a cut).
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+")
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]|<\|")


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for; ``new`` lists those not yet learned."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class PartIds:
    """Token ids of texts through a cache of word parts.

    For a tokenizer that cuts text by ``_PART``, drops white space and ends the last
    token of each part with ``</w>``: the ids of a text are then those of its parts.  New parts are
    encoded many at a time.  Words with other characters, or that may hold a special
    token, are encoded whole by the tokenizer.
    """

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self._reset()

    def _reset(self):
        self.at = _Numbers()
        self.pool = np.zeros(0, dtype=np.uint32)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self):
        """Encode the new parts (white space in front marks a whole word) and remember them."""
        new, self.at.new = self.at.new, []
        whole = np.fromiter((p[0] == " " for p in new), dtype=bool, count=len(new))
        parts, words = [p for p in new if p[0] != " "], [p for p in new if p[0] == " "]
        flat, sizes = [], []
        for lo in range(0, len(parts), 256):
            block = parts[lo:lo + 256]
            ids = self._ids([" ".join(block)])[0]
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(block) or stop[-1] != len(ids):
                each = self._ids(block)
                ids, stop = [i for e in each for i in e], np.cumsum([len(e) for e in each])
            flat.append(ids)
            sizes.append(np.diff(stop, prepend=0))
        for ids in self._ids([w[1:] for w in words]):
            flat.append(ids)
            sizes.append([len(ids)])
        size = np.concatenate(sizes).astype(np.int64)
        start = len(self.pool) + np.cumsum(size) - size
        row = np.argsort(np.argsort(whole, kind="stable"))  # encoded parts first, words after them
        self.start = np.concatenate((self.start, start[row]))
        self.size = np.concatenate((self.size, size[row]))
        self.pool = np.concatenate((self.pool, *(np.array(ids, dtype=np.uint32) for ids in flat)))

    @staticmethod
    def parts(text: str) -> list[str]:
        if text.isascii() and "<|" not in text or not _OTHER.search(text):
            return _PART.findall(text.lower())
        out = []
        for w in re.split(r"[\t-\r ]+", text):
            if _OTHER.search(w):
                out.append(" " + w)
            else:
                out += _PART.findall(w.lower())
        return out

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with ``end_id`` after it; ids per text)."""
        if len(self.at) > CACHE_PARTS:
            self._reset()
        found, per_doc = [], []
        for t in texts:
            p = self.parts(t.decode("utf-8", "replace"))
            per_doc.append(len(p))
            found += p
        row = np.fromiter(map(self.at.__getitem__, found), dtype=np.int64, count=len(found))
        if self.at.new:
            self._learn()
        size, start = self.size[row], self.start[row]
        doc = np.repeat(np.arange(len(texts)), per_doc)
        counts = np.bincount(doc, size, minlength=len(texts)).astype(np.int64)
        place = np.cumsum(size) - size + doc  # every earlier text has one more id, its end
        out = np.full(int(counts.sum()) + len(texts), end_id, dtype=np.uint32)
        k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(place, size) + k] = self.pool[np.repeat(start, size) + k]
        return out, counts + 1


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """Tokenised pieces: doc_id, piece, start, length, ids_crc32, and the piece's place as
    (part, nth): the nth piece of its length in input partition ``part``.

    Only documents longer than ``capacity`` are cut.  A null text is the empty text: its
    only id is ``end_id``.
    """
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        parts, seen = PartIds(tokenizer), np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            col, ids = b.column("text"), b.column("id")
            for lo, hi in text_slices(col, SLICE):
                tok, n = parts.encode(texts_of(col.slice(lo, hi - lo)), end_id)
                first = np.cumsum(n) - n
                cuts = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                raw = tok.astype("<u4").tobytes()
                at = 4 * (first[doc] + start)
                crc = [zlib.crc32(raw[a:z]) for a, z in zip(at.tolist(), (at + 4 * length).tolist())]
                order = np.argsort(length, kind="stable")
                own = length[order]
                head = np.searchsorted(own, own)
                nth = np.empty(len(doc), dtype=np.int64)
                nth[order] = seen[own] + np.arange(len(doc)) - head
                seen += np.bincount(length, minlength=capacity + 1)
                yield record_batch(doc_id=ids.take(pa.array(lo + doc)), piece=piece.astype(np.int32), start=start, length=length,
                                   ids_crc32=pa.array(crc, pa.int64()), part=np.full(len(doc), part, dtype=np.int32), nth=nth)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run,
                     "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


# -- the plan ------------------------------------------------------------------

def enumerate_patterns(have: np.ndarray, capacity: int, triples: int = 6, quads: int = 6) -> np.ndarray:
    """(m, 4) lengths, longest first and padded with 0, that sum to ``capacity``: for each
    longest length its pair and evenly spread triples and quadruples of lengths that occur."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[have] = True
    out = []

    def spread(x, k):
        return x if len(x) <= k else x[np.linspace(0, len(x) - 1, k).astype(int)]

    for a in have.tolist():
        rest = capacity - a
        if rest <= 0:
            continue
        if rest <= a and there[rest]:
            out.append((a, rest, 0, 0))
        b = have[(have <= a) & (have < rest)]
        c = rest - b
        for x in spread(b[(c <= b) & there[c]], triples).tolist():
            out.append((a, x, rest - x, 0))
        for x in spread(b, quads).tolist():
            left = rest - x
            y = have[(have <= x) & (have < left)]
            z = left - y
            for k in spread(y[(z <= y) & there[z]], 2).tolist():
                out.append((a, x, k, left - k))
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = 150) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, column j of A counting pattern j's lengths;
    multiplicative updates, which keep x non-negative and never raise the error."""
    m, n = len(patterns), len(histogram)
    flat, col = patterns.ravel(), np.repeat(np.arange(m), patterns.shape[1])
    col, flat = col[flat > 0], flat[flat > 0]
    target = np.bincount(col, histogram[flat].astype(float), minlength=m)
    x = np.full(m, 1.0)
    for _ in range(steps):
        made = np.bincount(flat, x[col], minlength=n)
        x *= target / np.maximum(np.bincount(col, made[flat], minlength=m), 1e-12)
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, of a histogram: [([(length, times), ...], sequences), ...].
    Sequences with the same room are one group, so the steps depend on the number of
    different lengths, not of pieces."""
    groups: dict[int, list] = {}
    rooms: list[int] = []

    def add(room, pattern, n):
        if n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((pattern, n))

    for length in np.flatnonzero(left)[::-1].tolist():
        c = int(left[length])
        while c:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                q = capacity // length
                add(capacity - q * length, ((length, q), None), c // q)
                if c % q:
                    add(capacity - (c % q) * length, ((length, c % q), None), 1)
                break
            room = rooms[at]
            pattern, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            q = room // length
            full = min(n, c // q)
            add(room - q * length, ((length, q), pattern), full)
            c -= full * q
            if c and full < n:
                add(room - c * length, ((length, c), pattern), 1)
                add(room, pattern, n - full - 1)
                c = 0
            elif full < n:
                add(room, pattern, n - full)
    out = []
    for many in groups.values():
        for pattern, n in many:
            flat = []
            while pattern:
                flat.append(pattern[0])
                pattern = pattern[1]
            out.append((flat[::-1], n))
    return out


def plan(histogram: np.ndarray, capacity: int, rounds: int = 3) -> dict[str, np.ndarray]:
    """Runs that place every piece: arrays length, rank (first), times, sequence (first), offset,
    ordered by length and rank.  A run gives ``times`` pieces to each sequence in turn."""
    left = histogram.astype(np.int64).copy()
    used: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        used.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    for _ in range(rounds):
        patterns = enumerate_patterns(np.flatnonzero(left), capacity)
        if not len(patterns):
            break
        repeats = np.floor(fit_repeats(patterns, left)).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            if not repeats[j]:
                break
            lengths, times = np.unique(patterns[j][patterns[j] > 0], return_counts=True)
            n = min(int(repeats[j]), int((left[lengths] // times).min()))
            if n:
                left[lengths] -= n * times
                used.append((list(zip(lengths[::-1].tolist(), times[::-1].tolist())), n))
    used += best_fit(left, capacity)
    rank, base, runs = np.zeros(capacity + 1, dtype=np.int64), 0, []
    for pattern, n in used:
        offset = 0
        for length, times in pattern:
            runs.append((length, rank[length], times, base, offset))
            rank[length] += n * times
            offset += length * times
        base += n
    runs = np.array(runs, dtype=np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    return dict(zip(("length", "rank", "times", "sequence", "offset"), runs.T.copy()))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every sequence holds at most ``capacity`` ids without gaps from offset 0.  Null ids
    are carried through; repeated rows are packed as rows of their own; an empty table
    gives no sequence.
    """
    own = cut(pieces(docs, tokenizer, id_col, text_col, capacity, end_id))
    counts = cut(own.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    runs = plan(histogram, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = cut(counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("first")))
    ranked = own.join(first, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))
    shared = own.sparkSession.sparkContext.broadcast(runs)  # at most a few runs per pattern: set by the capacity, not the corpus

    def place(batches):
        t = shared.value
        key = (t["length"] << 44) + t["rank"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            k, times = rank - t["rank"][at], t["times"][at]
            yield record_batch(**{c: b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                               sequence_id=t["sequence"][at] + k // times, offset=t["offset"][at] + k % times * length)

    return map_arrow(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
