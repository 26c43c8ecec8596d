"""Ranked lexical search (operator 11): pipelined term partitioning.

Documents are cut into blocks of bounded size; one scan leaves, per block, the posting lists of
the terms that some item asks for.  Terms belong to owners by the share of documents that hold them,
the rarest first.  A bundle of items carries its sparse accumulators, (item, document) ->
score, for one block from owner to owner: each stage is a cogroup of the bundles with that
owner's postings by (bundle, block), which adds integer contributions.  After the last owner
every bundle selects within its block, and a second selection takes the best of all blocks.

An accumulator is given up only when its score and all that the owners to come can still
add stay below the score that the block's tenth document of that item has already: such a document
cannot be among the ten, so the ranking is exact.  Nothing grows with the corpus but
the number of blocks: the scan's filter on terms is a table of fixed size, and a term's weight
travels with its postings.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import cut, map_arrow, record_batch, text_slices, texts_of
from lodestar.llm.textscan import WORD, Texts
from lodestar.session import ship_package

TOP = 10
BLOCK_BYTES = 4 << 20                  # text of a block, at most (a longer single text is a block)
BUNDLE_ITEMS = 256                     # items of a bundle
OWNER_SHARES = (1 / 256, 1 / 16, 1 / 4)  # an owner's terms stand in up to this share of documents; a last owner has the rest
FILTER_BITS = 22                       # the scan's term filter is a table of 2**22 entries

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _spot(terms: list[bytes]) -> np.ndarray:
    """The filter entry of each term."""
    import xxhash
    return np.fromiter((xxhash.xxh3_64_intdigest(t) >> (64 - FILTER_BITS) for t in terms), dtype=np.int64, count=len(terms))


def term_table(texts: list[bytes]):
    """(text, code) of every term occurrence in order, and the distinct terms by code.

    Terms are runs of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased."""
    t = Texts(texts, lower=False)
    start, end, doc = t.runs(WORD)
    size = end - start
    edge = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    at = np.arange(edge[-1]) + np.repeat(start - edge[:-1], size)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edge), pa.py_buffer(_LOWER[t.buf[at]])])
    named = words.dictionary_encode()
    return doc, named.indices.to_numpy(zero_copy_only=False).astype(np.int64), named.dictionary.to_pylist()


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term): distinct terms of every distinct (id, text) row; ``item`` numbers these rows."""
    rows = cut(items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct())
    counts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()  # one row a partition
    first, seen = {}, 0
    for r in sorted(counts, key=lambda r: r.part):
        first[r.part], seen = seen, seen + r.n

    def run(batches):
        from pyspark import TaskContext
        item = first.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            col, ids = b.column("text"), b.column("item_id")
            for lo, hi in text_slices(col, BLOCK_BYTES):
                doc, code, terms = term_table(texts_of(col.slice(lo, hi - lo)))
                if len(doc):
                    own, which = np.divmod(np.unique(doc * len(terms) + code), len(terms))
                    yield record_batch(item=own + item + lo, item_id=ids.take(pa.array(own + lo)),
                                       term=pa.array(terms, pa.binary()).take(pa.array(which)))
            item += b.num_rows

    return cut(map_arrow(rows, run, "item long, item_id long, term binary"))


def _filter(terms: DataFrame) -> np.ndarray:
    """Table of 2**FILTER_BITS entries, true where an item's term falls."""
    def run(batches):
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        for b in batches:
            seen[_spot(b.column("term").to_pylist())] = True
        yield record_batch(at=np.flatnonzero(seen).astype(np.int32))

    table = np.zeros(1 << FILTER_BITS, dtype=bool)
    spots = map_arrow(terms.select("term"), run, "at int").distinct().toArrow().column("at").to_numpy()  # 2**FILTER_BITS rows at most
    table[spots] = True
    return table


def _scan(docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
    """Two kinds of rows per block: its documents (term null: ids and term counts ``n``) and, per
    term that passes the filter, its posting list (positions ``docs`` in the block and ``tf``)."""
    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, BLOCK_BYTES):
                doc, code, terms = term_table(texts_of(col.slice(lo, hi - lo)))
                n = np.bincount(doc, minlength=hi - lo).astype(np.int32)
                ids = b.column("id").slice(lo, hi - lo)
                yield record_batch(block=pa.array([block]), term=pa.array([None], pa.binary()), ids=pa.ListArray.from_arrays([0, hi - lo], ids),
                                   docs=pa.array([None], pa.list_(pa.int32())), tf=pa.ListArray.from_arrays([0, hi - lo], pa.array(n)))
                if len(terms):
                    keep = wanted[_spot(terms)][code]
                    key, tf = np.unique(code[keep] * (hi - lo) + doc[keep], return_counts=True)
                    which, own = np.divmod(key, hi - lo)
                    head = np.flatnonzero(np.diff(which, prepend=-1))
                    edge = pa.array(np.append(head, len(which)).astype(np.int32))
                    if len(head):
                        yield record_batch(block=np.full(len(head), block), term=pa.array(terms, pa.binary()).take(pa.array(which[head])),
                                           ids=pa.nulls(len(head), pa.list_(pa.int64())), docs=pa.ListArray.from_arrays(edge, pa.array(own.astype(np.int32))),
                                           tf=pa.ListArray.from_arrays(edge, pa.array(tf.astype(np.int32))))
                block += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return cut(map_arrow(rows, run, "block long, term binary, ids array<long>, docs array<int>, tf array<int>"))


def _norm(n, docs: int, terms: int):
    """m of a document of ``n`` terms: 10 and 90 times its length over the mean length, rounded down."""
    return 100 - 90 + (90 * n * docs) // terms


def _gain(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _flat(col) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges) of a list column."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    edge = np.concatenate((np.zeros(1, np.int64), np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False)))) if len(col) else np.zeros(1, np.int64)
    return col.flatten().to_numpy(zero_copy_only=False), edge


_STATE = "bundle int, block long, ids array<long>, n array<int>, rest array<array<long>>, item array<int>, doc array<int>, score array<long>"


def _stage(state: DataFrame, postings: DataFrame, owner: int, docs: int, terms: int, top: int) -> DataFrame:
    """One owner: its postings of a (bundle, block) are added to the bundle's accumulators there."""
    kind = pa.schema([("bundle", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())),
                      ("rest", pa.list_(pa.list_(pa.int64()))), ("item", pa.list_(pa.int32())), ("doc", pa.list_(pa.int32())), ("score", pa.list_(pa.int64()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return kind.empty_table()
        n = left.column("n").combine_chunks().flatten().to_numpy()
        rest = np.array(left.column("rest")[0].as_py(), dtype=np.int64)  # (items, owners): what an owner can add to an item at most
        m = _norm(n.astype(np.int64), docs, terms)
        own_docs, doc_edge = _flat(right.column("docs"))
        tf, _ = _flat(right.column("tf"))
        gain = _gain(tf.astype(np.int64), m[own_docs]) if right.num_rows else tf
        asked, asked_edge = _flat(right.column("items"))
        weight = np.repeat(right.column("weight").to_numpy(), np.diff(asked_edge)) if right.num_rows else asked
        order = np.argsort(asked, kind="stable")
        row = np.repeat(np.arange(right.num_rows), np.diff(asked_edge))[order]
        asked, weight = asked[order], weight[order]
        before, at, score = (left.column(c).combine_chunks().flatten().to_numpy() for c in ("item", "doc", "score"))
        out = []
        for k in range(len(rest)):
            acc = np.zeros(len(n), dtype=np.int64)
            mine = slice(*np.searchsorted(before, [k, k + 1]))
            acc[at[mine]] = score[mine]
            for j in range(*np.searchsorted(asked, [k, k + 1])):
                span = slice(doc_edge[row[j]], doc_edge[row[j] + 1])
                acc[own_docs[span]] += weight[j] * gain[span]
            best = np.partition(acc, len(acc) - top)[len(acc) - top] if len(acc) > top else 0
            live = np.flatnonzero((acc > 0) & (acc + rest[k, owner + 1:].sum() >= best))
            out.append((np.full(len(live), k, dtype=np.int32), live.astype(np.int32), acc[live]))
        item, doc, score = (np.concatenate(x) for x in zip(*out))
        one = lambda x: pa.array([x])
        return pa.table([left.column(c).combine_chunks() for c in ("bundle", "block", "ids", "n", "rest")] + [one(item), one(doc), one(score)], schema=kind)

    ship_package(state.sparkSession)
    return state.groupBy("bundle", "block").cogroup(postings.where(F.col("owner") == owner).drop("owner").groupBy("bundle", "at")).applyInArrow(run, _STATE)


def _select(state: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score): the best ``top`` of every block."""
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = b.slice(r, 1)
                ids = row.column("ids").flatten()
                named = ids.fill_null(0).to_numpy(zero_copy_only=False)
                item, doc, score = (row.column(c).flatten().to_numpy() for c in ("item", "doc", "score"))
                order = np.lexsort((named[doc], ids.is_null().to_numpy(zero_copy_only=False)[doc], -score, item))
                nth = np.arange(len(item)) - np.searchsorted(item[order], item[order])
                order = order[nth < top]
                if len(order):
                    yield record_batch(item=item[order].astype(np.int64) + row.column("bundle")[0].as_py() * BUNDLE_ITEMS,
                                       doc_id=ids.take(pa.array(doc[order])), score=score[order])

    return map_arrow(state.select("bundle", "ids", "item", "doc", "score"), run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item with a score above 0.

    Equal scores rank by ascending doc_id, null ids last.  Null and empty texts have no term: such documents
    count for nothing and such items find nothing.  Document rows are ranked row by row, so a repeated
    row can hold several ranks; repeated (id, text) rows of items count once, and different texts under
    one item id are items of their own, each with ranks from 1.  Other columns of either table are not looked at.
    """
    asked = _item_terms(items, item_id, item_text)
    index = _scan(docs, id_col, text_col, _filter(asked))
    blocks, lists = index.where("term is null"), index.where("term is not null")
    total = blocks.select(F.explode("tf").alias("n")).where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms"), F.min("n").alias("least")).first()
    n_docs, n_terms = int(total.docs), int(total.terms or 1)
    floor_m = _norm(int(total.least or 0), n_docs, n_terms)
    owners = len(OWNER_SHARES) + 1

    found = lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("tf")).alias("most"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (2.0 * F.col("df") + 1))).cast("long")
    owner = reduce(lambda rest, k: F.when(F.col("df") <= F.lit(OWNER_SHARES[k] * n_docs), k).otherwise(rest), range(owners - 2, -1, -1), F.lit(owners - 1))
    gain = F.expr(f"(1000000000L * most) div (1000L * most + 8L * {floor_m}L)")
    terms = asked.join(found, "term").select(
        (F.col("item") / BUNDLE_ITEMS).cast("int").alias("bundle"), (F.col("item") % BUNDLE_ITEMS).cast("int").alias("own"), "term", weight.alias("weight"),
        owner.alias("owner"), gain.alias("gain")).where("weight > 0")
    terms = cut(terms)

    posted = lists.select("block", "term", "docs", "tf").join(
        terms.groupBy("bundle", "term", "weight", "owner").agg(F.collect_list("own").alias("items")), "term").select(
        "bundle", F.col("block").alias("at"), "owner", "weight", "items", "docs", "tf")
    limits = terms.groupBy("bundle", "own", "owner").agg(F.sum(F.col("weight") * F.col("gain")).alias("up")).groupBy("bundle").agg(
        F.collect_list(F.struct("own", "owner", "up")).alias("ups"))  # BUNDLE_ITEMS x owners entries at most

    def up(k, o):
        return F.aggregate("ups", F.lit(0).cast("long"), lambda a, u: a + F.when((u["own"] == k) & (u["owner"] == o), u["up"]).otherwise(0))

    rest = F.transform(F.sequence(F.lit(0), F.lit(BUNDLE_ITEMS - 1)), lambda k: F.array(*[up(k, o) for o in range(owners)]))
    limits = cut(limits.select("bundle", rest.alias("rest")))
    none = [F.array().cast("array<int>").alias("item"), F.array().cast("array<int>").alias("doc"), F.array().cast("array<long>").alias("score")]
    last = limits.agg(F.max("bundle").alias("last")).first().last
    each = F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("bundle")  # the join leaves out bundles whose terms nobody holds
    state = (blocks.select(each, "block", "ids", F.col("tf").alias("n")).join(limits, "bundle")
             .select("bundle", "block", "ids", "n", "rest", *none))
    for k in range(owners):
        state = _stage(state, posted, k, n_docs, n_terms, top)
    best = _select(state, top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= top)
    names = asked.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
