import random

import duckdb
import pytest

import corpus_pipeline
from lodestar.llm import queries, secret_scan, toxicity
from lodestar.llm.oracles import SQL

SF = "/root/testdata/sf0.001"


def test_stages_keep_and_drop(spark, docs_of, tables):
    rnd = random.Random(2)
    vocab = [f"{a}{b}" for a in ("ba", "ti", "re", "on") for b in ("lo", "mer", "sta", "kin", "dur")]
    text = lambda n=60: " ".join(rnd.choice(vocab) for _ in range(n))
    item = text(20)
    docs = [(i, text()) for i in range(80)]
    docs += [(100 + i, text() + " moron scum " + text(5)) for i in range(20)]
    docs += [(200, docs[3][1]), (201, docs[3][1].upper()), (202, None), (203, ""), (None, text()), (None, docs[4][1])]
    docs += [(300, text(10) + " " + item + " " + text(10)), (301, text(10) + ' token = "abcdef123456" ' + text(9)), (302, "ba " * 40_000), (7, docs[7][1]), (8, text()), (9, docs[4][1])]
    labels = [(i, 1, int(i >= 100)) for i in [*range(40), *range(100, 112)]]
    folder = tables(documents=docs_of(docs), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    columns, seen = ["doc_id", "text", "lang", "source", "n_chars"], []
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        out.write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        seen.append(frame.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == columns
    ids = [sorted(str(r.doc_id) for r in rows) for rows in seen]
    clean = [str(i) for i, _ in docs if i is None or not 100 <= i < 120]
    assert ids[0] == sorted(clean)
    assert not {"200", "201", "203"} & set(ids[1]) and ids[1].count("7") == 1 and ids[1].count("None") == 1 and "202" in ids[1]
    assert set(ids[0]) - set(ids[1]) == {"200", "201", "203"}
    texts = [r.text for r in seen[1]]
    assert ids[1].count("8") == 2 and ids[1].count("9") == 1 and texts.count(docs[4][1]) == 1  # one id on two texts
    assert set(ids[1]) - set(ids[2]) == {"300"}
    assert ids[3] == ids[2]
    masked = next(r for r in seen[3] if r.doc_id == 301)
    assert "[SECRET]" in masked.text and "abcdef123456" not in masked.text and masked.n_chars == len(masked.text)
    assert sorted({str(r.doc_id) for r in seen[4]}) == sorted(set(ids[3]))


def test_run_matches_a_brute_force_chain(spark, docs_of, tables):
    """Every stage done anew, text by text or pair by pair, on what the one before kept; the two trained models are given."""
    import zlib
    import numpy as np
    from tokenizers import Tokenizer
    from test_secret_scan import brute as secrets, slow_markov
    from test_simhash_vp import brute as groups
    from test_string_tiling import brute_tiles, words
    from test_toxicity import slow_features

    rnd = random.Random(12)
    vocab = [f"{a}{b}" for a in ("ba", "ti", "re", "on", "sul") for b in ("lo", "mer", "sta", "kin", "dur")]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, text(12)) for k in range(5)]
    docs = [(k, text(rnd.randint(3, 40))) for k in range(90)] + [(k, text(20) + " scum moron " * rnd.randint(1, 3) + text(4)) for k in range(100, 125)]
    docs += [(200 + k, docs[k][1].upper() if k % 2 else docs[k][1] + " ") for k in range(12)] + [(230 + k, text(6) + " " + items[k % 5][1].title() + " " + text(5)) for k in range(8)]
    docs += [(250 + k, text(8) + f' api_key: "{rnd.getrandbits(80):x}zz" ' + text(4)) for k in range(6)] + [(270, None), (271, ""), (272, "\n"), (273, text(1)), (274, "é " * 900)]
    folder = tables(documents=docs_of(docs).repartition(4), labels=spark.createDataFrame([(k, 1, int(k >= 100)) for k, _ in docs[:115]], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame(items, "item_id long, text string"))
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    tox = toxicity.fit(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    weight = dict(zip(tox.features.tolist(), tox.weights.tolist()))
    kept = [(i, t) for i, t in docs if 1 / (1 + np.exp(tox.thresholds[0] - sum(weight.get(f, 0.0) for f in slow_features(t)))) < 0.5]
    assert {i for i, _ in docs} - {i for i, _ in kept} == set(range(100, 125))
    own = {i: c for i, _, c in groups(kept)}
    kept = [(i, t) for i, t in kept if own[i] == i]
    before, kept = kept, [(i, t) for i, t in kept if not any(sum(x[2] for x in brute_tiles(words(s), words(t), 5)) >= 0.6 * 12 for _, s in items)]
    assert {i for i, _ in before} - {i for i, _ in kept} == {230 + k for k in range(8)}
    model = secret_scan.fit(docs_of(kept))
    masked = []
    for i, t in kept:
        spans = sorted([(s, e) for s, _, e in secrets(t)] + [tuple(map(int, m.split(":")[1:])) for m in slow_markov(t, model)])
        for s, e in reversed(spans):
            t = t[:s] + "[SECRET]" + t[e:]
        masked.append((i, t))
    assert sum("[SECRET]" in (t or "") for _, t in masked) == 6
    tok, want = Tokenizer.from_file(queries.word_tokenizer()), []
    for i, t in masked:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, 4096 * k, len(p), zlib.crc32(np.array(p, dtype="<u4").tobytes())) for k, p in enumerate(ids[a:a + 4096] for a in range(0, len(ids), 4096))]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_near_duplicates_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7, 8), (2, "a b c d", 9, 9), (3, "e f g h", 5, 5)], "doc_id long, text string, _key long, n long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d", 7, 8), (3, "e f g h", 5, 5)]


def test_run_on_empty_tables(spark, docs_of, tables):
    folder = tables(documents=docs_of([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(SQL[name])
    cols = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    key = lambda rows: sorted(map(str, rows))
    assert key([tuple(r[c] for c in cols) for r in got.collect()]) == key(want.fetchall())
