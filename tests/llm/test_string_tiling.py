import random
import re

from lodestar.llm import string_tiling as T


def words(t):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())


def brute_tiles(item, doc, width):
    """Greedy string tiling by trying every pair of unmarked positions each time."""
    mi, md, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and not mi[i + k] and not md[d + k] and item[i + k] == doc[d + k]:
                    k += 1
                if k >= width and (best is None or k > best[2]):
                    best = (i, d, k)
        if best is None:
            return tiles
        tiles.append(best)
        for k in range(best[2]):
            mi[best[0] + k] = md[best[1] + k] = True


def data():
    rnd = random.Random(8)
    vocab = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(5, 30)))) for k in range(12)] + [(90, "one two"), (93, "w7 w8"), (94, "w39"), (91, None), (92, ""), (3, "w1 w2 w3 w4 w5 w6")]
    docs = [(0, None), (1, ""), (2, "w1 " * 4000)]
    for k in range(60):
        ws = rnd.choice(items[:12])[1].split()
        a = rnd.randrange(len(ws))
        mixed = [rnd.choice(vocab) for _ in range(rnd.randint(0, 15))] + ws[a:] + ["###"] + [w.upper() + "," for w in ws[:a]]
        if k % 3 == 0:
            mixed[rnd.randrange(len(mixed))] = "changed"
        docs.append((10 + k, " ".join(mixed)))
    docs.append((10, docs[5][1]))
    return docs, items


def test_matches_brute_force(spark, docs_of):
    docs, items = data()
    want = []
    for d, t in docs:
        for i, s in items:
            w = words(s)
            if w:
                tiles = brute_tiles(w, words(t)[:300], min(5, len(w))) if t is None or len(t) < 5000 else []
                covered = sum(x[2] for x in tiles)
                if tiles and covered >= (0.6 if len(w) >= 5 else 1) * len(w):
                    want.append((d, i, covered, max(x[2] for x in tiles)))
    df = docs_of(docs).withColumnRenamed("lang", "item_id").withColumnRenamed("source", "tiles").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.covered, r.longest) for r in T.contaminated(df, bench).collect()]
    assert sorted(got) == sorted(want) and len(want) > 30
    bad = {d for d, *_ in want}
    clean = T.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_item_blocks_give_the_same_result(spark, docs_of, monkeypatch):
    docs, items = data()
    df, bench = docs_of(docs), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, T.contaminated(df, bench).collect()))
    monkeypatch.setattr(T, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, T.contaminated(df, bench).collect())) == one


def test_empty_tables(spark, docs_of):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert T.contaminated(docs_of([]), bench).count() == 0
    assert T.contaminated(docs_of(docs), bench.limit(0)).count() == 0
    assert T.drop_contaminated(docs_of(docs), bench.limit(0)).count() == len(docs)


def test_small_expansions_give_the_same_hits(monkeypatch):
    docs, items = data()
    rnd = random.Random(4)
    shared = "which of the following is most true about"
    items = [(i, s) for i, s in items if s] + [(200 + k, f"{shared} " + " ".join(f"w{rnd.randrange(40)}" for _ in range(4))) for k in range(300)]
    texts = [(t or "").encode() for _, t in docs] + [(shared + " w1 ").encode() * 50, (items[-1][1] + " and " + items[-2][1]).encode()]
    index = T.Items([i for i, _ in items], [s.encode() for _, s in items], 5)
    whole = list(T._block_hits(texts, index, 0.6))
    monkeypatch.setattr(T, "MOST_MATCHES", 7)
    assert list(T._block_hits(texts, index, 0.6)) == whole
    hit = {(d, index.ids[i]) for d, i, _, _ in whole}
    assert (len(texts) - 1, items[-1][0]) in hit and (len(texts) - 1, items[-2][0]) in hit


def test_case_and_punctuation_beyond_ascii_hide_nothing(spark, docs_of):
    items = [(1, "où l'élève français a-t-il étudié l'économie générale très tôt à genève"), (2, "die straße führt über größere flüsse nach köln und münchen"),
             (3, "ο λόγος τους είναι πολύ καλός για όλους"), (4, "alpha beta gamma delta epsilon zeta")]
    docs = [(10 + i, t.upper()) for i, t in items] + [
        (21, items[0][1].replace(" ", "\u00a0").replace("'", "\u2019")), (22, "\u00ab" + items[1][1].replace(" ", "\u2014") + "\u00bb"),
        (24, "\u201calpha beta\u2026gamma\u200bdelta\u3000epsi\u00adlon\u00b7zeta\u201d"), (30, "où l'eleve francais a-t-il etudie l'economie generale tres tot a geneve")]
    df, bench = docs_of(docs), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.coverage) for r in T.contaminated(df, bench).collect()}
    assert got == {(11, 1, 1.0), (12, 2, 1.0), (13, 3, 1.0), (14, 4, 1.0), (21, 1, 1.0), (22, 2, 1.0), (24, 4, 1.0)}
    assert [r.doc_id for r in T.drop_contaminated(df, bench).collect()] == [30]


def test_repetitive_texts_need_little_time_and_memory(spark):
    import resource
    import time
    index = T.Items([1, 2, 3], [b"again " * 120, b"again " * 100 + b"a b c d e f g h " * 3, b"x y " * 60], 5)
    texts = [b"again " * 100_000, b"x y " * 50_000, b"a b c d e f g h " * 9000]
    before, t0 = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    got = [(d, i, tiles[0], share) for d, i, tiles, share in T._block_hits(texts, index, 0.6)]
    assert got == [(0, 0, (0, 0, 120), 1.0), (0, 1, (0, 0, 100), 100 / 124), (1, 2, (0, 0, 120), 1.0)]
    assert time.time() - t0 < 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600 * 1024


def test_repetitive_texts_match_brute_force():
    rnd = random.Random(3)
    for width in (2, 3, 5):
        for _ in range(40):
            item = [rnd.choice("ab") for _ in range(rnd.randint(width, 14))]
            doc = [rnd.choice("abc" if rnd.random() < 0.3 else "ab") for _ in range(rnd.randint(width, 40))]
            index = T.Items([0], [" ".join(item).encode()], width)
            got = [(tiles, share) for _, _, tiles, share in T._block_hits([" ".join(doc).encode()], index, 0.01)]
            want = brute_tiles(item, doc, width)
            assert [t for t, _ in got] == ([want] if want else [])


def test_short_items_must_stand_whole(spark, docs_of):
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "one two three four"), (4, "..."), (5, None)], "item_id long, text string")
    docs = docs_of([(1, "Alpha, beta!"), (2, "beta alpha"), (3, "x GAMMA y"), (4, "one two x three four"), (5, "say one two three four"), (6, None), (None, "gamma")])
    got = sorted(((r.doc_id, r.item_id, r.coverage) for r in T.contaminated(docs, bench).collect()), key=repr)
    assert got == [(1, 1, 1.0), (3, 2, 1.0), (5, 3, 1.0), (None, 2, 1.0)]
    assert sorted(r.doc_id for r in T.drop_contaminated(docs, bench).collect()) == [2, 4, 6]
