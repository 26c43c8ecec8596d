import math
import re
from collections import Counter

from lodestar.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOW)))


def brute(docs, items, top=10):
    """Ranked rows of each (item id, text), straight from the formulas."""
    held = [(i, terms(t)) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for (doc, c), n in zip(held, sizes):
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "x", 7) for i, t in docs], "doc_id long, text string, block int, term string, item_id long")
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, score int")
    return sorted([tuple(r) for r in L.search(d.repartition(3), b, **kw).select("item_id", "rank", "doc_id", "score").collect()], key=repr)


WORDS = [f"w{k}" for k in range(40)] + ["Straße", "ÉTÉ", "été", "naïve", "x1", "X1", "日本"]


def text(k, n):
    return " ".join(WORDS[(k * 7 + j * j * 3 + k * j) % len(WORDS)] if (k + j) % 4 else "w0" for j in range(n))


def test_ranking_matches_brute_force(spark):
    docs = [(k, text(k, 1 + k * 5 % 60)) for k in range(300)]
    items = [(k, text(3 * k + 1, 6)) for k in range(20)]
    assert found(spark, docs, items) == brute(docs, items)


def test_many_bundles_and_blocks_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "BUNDLE_ITEMS", 3)
    monkeypatch.setattr(L, "BLOCK_BYTES", 400)
    docs = [(k, text(k, 1 + k * 5 % 60)) for k in range(120)]
    items = [(k, text(3 * k + 1, 6)) for k in range(11)]
    assert found(spark, docs, items, top=4) == brute(docs, items, top=4)


def test_ties_repeats_nulls_and_long_texts(spark):
    long = " ".join(f"L{k % 5000} w{k % 7}" for k in range(60000))
    docs = [(5, "w1 w2"), (3, "W1, w2!"), (4, "w1 w2"), (4, "w1 w2"), (None, "w1 w2"), (9, None), (8, ""), (7, " \n."), (10, long)] + [(20 + k, "w1 w2") for k in range(30)]
    docs += [(100 + k, f"other{k} thing") for k in range(40)]
    items = [(1, "w2 w1 w1"), (1, "w2 w1 w1"), (1, "thing L77"), (None, "l77"), (2, None), (3, ""), (4, "nowhere"), (6, long)]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[2] for r in sorted(x for x in got if x[0] == 1 and x[3] == max(y[3] for y in got if y[0] == 1 and y[2] == 3))][:4] == [3, 4, 4, 5]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "w1")]) == []
    assert found(spark, [(1, "w1")], []) == []
    assert found(spark, [(1, None)], [(1, "w1")]) == []
