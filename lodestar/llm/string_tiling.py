"""Benchmark decontamination (operator 7): greedy string tiling of items over documents.

A tile is a run of words that an item and a document share, word for word, in which no
word is already covered by another tile.  Tiles are placed longest first until none of
``min_match`` words is left, so a passage whose parts were put in another order is still
covered.  A document is contaminated by an item when tiles cover ``coverage`` or more
of the item's words.

Seeds are windows of ``min_match`` words joined by running Karp-Rabin hash; the item
side is a query set that travels to the tasks in blocks of bounded size, every block
meets every document, and documents never leave their task.  Only (document, item)
pairs whose seeds together could reach the coverage are tiled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut, map_arrow, record_batch, text_slices, texts_of
from lodestar.llm.textscan import WORD, Texts, mix

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 16 << 20   # item text in one task closure
SLICE = 1 << 20
MOST_MATCHES = 1 << 20   # seed matches expanded at a time
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _windows(h: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """(start, hash) of each ``width``-word window that stays within one text."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    g = h[:n].copy()
    for k in range(1, width):
        g *= _STEP
        g += h[k:n + k]
    at = np.flatnonzero(doc[:n] == doc[width - 1:])
    return at, mix(g[at])


class Items:
    """One block of benchmark items with the index of their seed windows."""

    def __init__(self, ids: list, texts: list[bytes], min_match: int):
        self.ids, self.width = ids, min_match
        t = Texts(texts)
        start, end, doc = t.runs(WORD)
        self.first = np.searchsorted(doc, np.arange(len(ids) + 1))
        self.size = np.diff(self.first)
        raw = t.buf.tobytes()
        self.code: dict = {}  # item word -> number, so that words are compared as numbers
        self.words = np.fromiter((self.code.setdefault(raw[s:e], len(self.code)) for s, e in zip(start, end)), dtype=np.int64, count=len(start))
        at, g = _windows(mix(t.hashes(t.running(), start, end)), doc, min_match)
        order = np.argsort(g, kind="stable")
        self.seed, self.item, self.pos = g[order], doc[at][order], (at - self.first[doc[at]])[order]
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[(self.seed >> np.uint64(42)).astype(np.int64)] = True

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first index entry, entries) of the windows whose hash is in the index."""
        hit = np.flatnonzero(self.table[(g >> np.uint64(42)).astype(np.int64)])
        lo = np.searchsorted(self.seed, g[hit], side="left")
        n = np.searchsorted(self.seed, g[hit], side="right") - lo
        return hit[n > 0], lo[n > 0], n[n > 0]


def _ranges(n: np.ndarray, most: int):
    """Ranges (from, to) of rows whose ``n`` add up to about ``most``."""
    cuts = np.flatnonzero(np.diff((np.cumsum(n) - n) // most)) + 1
    edge = [0, *cuts.tolist(), len(n)]
    return zip(edge[:-1], edge[1:])


def _expand(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, lo[row] + k) for each k below n[row]."""
    return np.repeat(np.arange(len(n)), n), np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _heads(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(key, prepend=-1))


def _candidates(doc: np.ndarray, lo: np.ndarray, n: np.ndarray, items: Items, coverage: float) -> np.ndarray:
    """Sorted keys (document * items + item) of the pairs whose seeds together could reach the
    coverage.  A document counts a seed once, so at most the whole index is expanded for it."""
    order = np.lexsort((lo, doc))
    doc, lo, n = doc[order], lo[order], n[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1])
    doc, lo, n = doc[new], lo[new], n[new]
    edge, out = np.append(_heads(doc), len(doc)), []
    for a, b in _ranges(np.add.reduceat(n, edge[:-1]), MOST_MATCHES):
        own = slice(edge[a], edge[b])
        row, k = _expand(lo[own], n[own])
        key, pos = doc[own][row] * len(items.ids) + items.item[k], items.pos[k]
        order = np.lexsort((pos, key))
        key, pos = key[order], pos[order]
        step = np.full(len(key), items.width)
        step[:-1] = np.where(key[1:] == key[:-1], np.minimum(np.diff(pos), items.width), items.width)
        head = _heads(key)
        pair = key[head]
        out.append(pair[np.add.reduceat(step, head) >= coverage * items.size[pair % len(items.ids)]])
    return np.concatenate(out)


def tile(runs, width: int, item_words: int, doc_words: int) -> tuple[list[tuple[int, int, int]], int]:
    """Greedy tiling from maximal runs (item word, document word, length) of equal words.

    Returns the tiles (item word, document word, length), longest first (ties: earlier
    in the item, then in the document), and how many item words they cover.  It ends as soon as
    no stretch of ``width`` item words is left, however many runs there are.
    """
    import heapq
    todo = [(-n, i, d) for i, d, n in runs]
    heapq.heapify(todo)
    free_i, free_d = np.ones(item_words, dtype=bool), np.ones(doc_words, dtype=bool)
    tiles, covered, room = [], 0, True
    while todo and room:
        n, i, d = heapq.heappop(todo)
        free = free_i[i:i - n] & free_d[d:d - n]
        if free.all():
            tiles.append((i, d, -n))
            free_i[i:i - n] = free_d[d:d - n] = False
            covered -= n
            room = any(z - a >= width for a, z in _stretches(free_i))
            continue
        for a, z in _stretches(free):  # what is left of the run, piece by piece
            if z - a >= width:
                heapq.heappush(todo, (a - z, i + a, d + a))
    return tiles, covered


def _stretches(free: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _runs(items: Items, pairs: np.ndarray, code: np.ndarray, doc: np.ndarray, word: np.ndarray, first: np.ndarray, n: np.ndarray):
    """(pair, item word, document word, length) of the maximal runs of equal words, sorted by pair.

    Seed matches are expanded in bounded ranges and compared word for word; only those that start or end
    a run are kept, and on a diagonal the n-th start belongs to the n-th end."""
    ends: tuple[list, list] = ([], [])
    width, last = items.width, len(items.words) - 1
    for a, b in _ranges(n, MOST_MATCHES):
        row, k = _expand(first[a:b], n[a:b])
        w = word[a:b][row]
        key = doc[w] * len(items.ids) + items.item[k]
        own = pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key
        key, w, i = key[own], w[own], items.first[items.item[k[own]]] + items.pos[k[own]]
        same = np.ones(len(w), dtype=bool)
        for step in range(width):
            same &= code[w + step] == items.words[i + step]
        key, w, i = key[same], w[same], i[same]
        item = key % len(items.ids)
        into = (w > 0) & (i > items.first[item]) & (doc[w - 1] == doc[w]) & (code[w - 1] == items.words[i - 1])
        z, j = np.minimum(w + width, len(code) - 1), np.minimum(i + width, last)
        on = (w + width < len(code)) & (i + width < items.first[item + 1]) & (doc[z] == doc[w]) & (code[z] == items.words[j])
        for out, own in zip(ends, (~into, ~on)):
            out.append(np.stack((key[own], w[own] - i[own], w[own], i[own])))
    start, stop = (np.concatenate(x, axis=1) for x in ends)
    start, stop = (x[:, np.lexsort((x[2], x[1], x[0]))] for x in (start, stop))
    return start[0], start[3], start[2], stop[2] - start[2] + width


def _block_hits(texts: list[bytes], items: Items, coverage: float):
    """Yield (document, item, tiles, covered share) of contaminated pairs of one range."""
    t = Texts(texts)
    start, end, doc = t.runs(WORD)
    at, g = _windows(mix(t.hashes(t.running(), start, end)), doc, items.width)
    hit, first, n = items.find(g)
    if not len(hit):
        return
    pairs = _candidates(doc[at[hit]], first, n, items, coverage)
    if not len(pairs):
        return
    raw = t.buf.tobytes()
    code = np.full(len(doc), -1, dtype=np.int64)
    span = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d in np.unique(pairs // len(items.ids)):
        code[span[d]:span[d + 1]] = [items.code.get(raw[s:e], -1) for s, e in zip(start[span[d]:span[d + 1]], end[span[d]:span[d + 1]])]
    key, i, w, size = _runs(items, pairs, code, doc, at[hit], first, n)
    edge = np.append(_heads(key), len(key))
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
        text, item = divmod(int(key[lo]), len(items.ids))
        runs = zip((i[lo:hi] - items.first[item]).tolist(), (w[lo:hi] - span[text]).tolist(), size[lo:hi].tolist())
        tiles, covered = tile(runs, items.width, int(items.size[item]), int(span[text + 1] - span[text]))
        if tiles and covered >= coverage * items.size[item]:
            yield text, item, tiles, covered / int(items.size[item])


def _item_blocks(items: DataFrame, id_col: str, text_col: str, min_match: int, coverage: float):
    """(items, coverage asked, whether more follow) in blocks of ``BLOCK_BYTES``; one is made at a time.  Items of fewer than
    ``min_match`` words come in blocks of their own, one per number of words, and must be covered whole."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    open_: dict[int, tuple[list, list]] = {}
    size: dict[int, int] = {}

    def made():
        for r in rows.orderBy("id", "text").toLocalIterator():
            t = r.text.encode()
            width = min(min_match, len(Texts([t]).runs(WORD)[0]))
            if not width:
                continue
            if width in open_ and size[width] + len(t) > BLOCK_BYTES:
                yield width, open_.pop(width)
            ids, texts = open_.setdefault(width, ([], []))
            size[width] = len(t) + (size[width] if texts else 0)
            ids.append(r.id)
            texts.append(t)
        yield from sorted(open_.items(), reverse=True)

    ahead = made()
    now = next(ahead, None)
    while now is not None:
        after = next(ahead, None)
        width, (ids, texts) = now
        yield Items(ids, texts, width), coverage if width == min_match else 1.0, after is not None
        now = after


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """One row per contaminated (document row, item): doc_id, item_id, tiles, longest,
    covered, coverage, spans (``item word:document word:length`` of each tile by item word).

    Words are runs of letters, digits and marks after Unicode case folding, so case,
    punctuation and white space do not hide a passage.  Null and empty texts match nothing, nor do items without a
    word; an item of fewer than ``min_match`` words must stand whole and in order.  Repeated rows are judged row by row,
    null ids are kept, equal item ids are items of their own, and other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = "doc_id long, item_id long, tiles int, longest int, covered int, coverage double, spans string"
    out = None
    for block, share, more in _item_blocks(items, item_id, item_text, min_match, coverage):
        def run(batches, block=block, share=share):
            for b in batches:
                col, ids = b.column("text"), b.column("id")
                for lo, hi in text_slices(col, SLICE):
                    hits = list(_block_hits(texts_of(col.slice(lo, hi - lo)), block, share))
                    if hits:
                        yield record_batch(
                            doc_id=ids.take(pa.array([lo + h[0] for h in hits])), item_id=pa.array([block.ids[h[1]] for h in hits], pa.int64()),
                            tiles=pa.array([len(h[2]) for h in hits], pa.int32()), longest=pa.array([h[2][0][2] for h in hits], pa.int32()),
                            covered=pa.array([sum(x[2] for x in h[2]) for h in hits], pa.int32()), coverage=[h[3] for h in hits],
                            spans=[",".join(f"{i}:{d}:{n}" for i, d, n in sorted(h[2])) for h in hits])

        part = map_arrow(rows, run, kind)
        part = cut(part) if more else part  # the block leaves the driver before the next one is made
        out = part if out is None else out.union(part)
    return rows.sparkSession.createDataFrame([], kind) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns.

    Rows are judged one by one by their text alone: null and empty texts stay, repeated rows stay or go together, null
    and repeated ids are no matter.  With several blocks of items, what a block leaves is written before the next is made.
    """
    for block, share, more in _item_blocks(items, item_id, item_text, min_match, coverage):
        def run(batches, block=block, share=share):
            for b in batches:
                col = b.column(text_col)
                for lo, hi in text_slices(col, SLICE):
                    bad = {h[0] for h in _block_hits(texts_of(col.slice(lo, hi - lo)), block, share)}
                    yield b.slice(lo, hi - lo).filter(pa.array([k not in bad for k in range(hi - lo)]))

        docs = map_arrow(docs, run, docs.schema)
        docs = cut(docs) if more else docs
    return docs
