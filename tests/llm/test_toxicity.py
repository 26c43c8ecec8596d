import random

import numpy as np

from lodestar.llm import toxicity as T

BAD = ["trash", "moron", "scum", "clown"]


def corpus(n=600, seed=1):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ba", "ti", "re", "on") for b in ("lo", "mer", "sta", "kin", "dur")]
    docs, labels = [], []
    for i in range(n):
        ws, bad = [rnd.choice(vocab) for _ in range(rnd.randint(5, 60))], i % 5 == 0
        for _ in range(rnd.randint(1, 6) if bad else 0):
            ws.insert(rnd.randrange(len(ws)), rnd.choice(BAD).upper() + "!")
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark, docs_of):
    docs, labels = corpus()
    extra = [(9001, None), (9002, ""), (9003, "lo " * 50_000), (9004, "you moron " * 20_000), (None, "scum scum scum"), (0, docs[0][1])]
    lab = spark.createDataFrame([x for x in labels if x[0] % 2 == 0] + [(None, 1, 1), (4, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    df = docs_of(docs + extra).withColumnRenamed("lang", "y").withColumnRenamed("source", "id").repartition(4)
    m = T.fit(df, lab)
    assert len(m.thresholds) > 1 and (np.diff(m.thresholds) >= 0).all()
    rows = T.score(df, m).collect()
    assert len(rows) == len(docs) + len(extra)
    truth = {i: bool(t) for i, _, t in labels}
    test = [r for r in rows if r.doc_id is not None and r.doc_id % 2 and r.doc_id < 9000]
    assert sum(r.toxic == truth[r.doc_id] for r in test) >= 0.97 * len(test)
    by = {r.doc_id: r for r in rows}
    assert not by[9001].toxic and not by[9002].toxic and not by[9003].toxic and by[9004].toxic and by[None].toxic
    many, few = [np.mean([r.severity for r in test if r.toxic and (r.doc_id in s)]) for s in (
        {i for i, t in docs if sum(t.lower().count(w) for w in BAD) >= 5}, {i for i, t in docs if sum(t.lower().count(w) for w in BAD) == 1})]
    assert many > few
    kept = T.drop_toxic(df, m)
    assert kept.columns == df.columns and kept.count() == sum(not r.toxic for r in rows)


def test_empty_and_single_class(spark, docs_of):
    docs, labels = corpus(40)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    m = T.fit(docs_of(docs), lab.where("toxic = 0"))
    assert T.score(docs_of(docs), m).where("toxic").count() == 0
    assert T.score(docs_of([]), T.fit(docs_of([]), lab.limit(0))).count() == 0


def test_ordinal_fit_recovers_thresholds_and_shared_weights():
    rng = np.random.default_rng(0)
    n, w, t = 20_000, np.array([2.0, -1.0, 0.5]), np.array([0.5, 2.0])
    x = rng.random((n, 3)) < 0.5
    y = (x @ w + rng.logistic(size=n))[:, None] >= t[None, :]
    rows, cols = np.nonzero(x)
    got, cut = T.fit_ordinal(rows, cols, y.sum(axis=1), 3, l2=0.0)
    assert np.abs(got - w).max() < 0.1 and np.abs(cut - t).max() < 0.1


def slow_features(text):
    """The features of one text, word by word: the word's and its beginnings' polynomial hashes."""
    mask, out = (1 << 64) - 1, set()

    def mixed(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    import re
    for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").lower().encode()):
        for stem in (0, 4, 6, 8):
            if stem < len(w):
                h = sum((b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(w[:stem] if stem else w)) & mask
                out.add(mixed((h + stem) & mask) >> 1)
    return out


def test_scores_match_a_computation_text_by_text(spark, docs_of):
    docs, labels = corpus(200)
    docs = docs + [(900, None), (901, ""), (902, "TRASH, moron! scumbag clowns"), (903, "Ünïcode trash\u00a0moron"), (904, "clown " * 3000)]
    m = T.fit(docs_of(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    weight = dict(zip(m.features.tolist(), m.weights.tolist()))
    for r in T.score(docs_of(docs).repartition(3), m).collect():
        s = sum(weight.get(f, 0.0) for f in slow_features(dict(docs)[r.doc_id]))
        up = [1 / (1 + np.exp(t - s)) for t in m.thresholds]
        each = -np.diff([1.0, *up, 0.0])
        assert abs(r.severity - sum(up)) < 1e-9 and abs(r.p_toxic - up[0]) < 1e-9
        assert each[r.grade] > each.max() - 1e-12 and r.toxic == (up[0] >= 0.5)


def test_an_id_on_very_many_rows_is_one_labelled_document(spark, docs_of):
    docs, labels = corpus(60)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    many = docs + [(0, docs[0][1])] * 50 + [(0, "another text of the same id")] * 50
    from lodestar.llm.site_quality import fit_shape
    rows = T._sampled(docs_of(many).repartition(4), lab, "doc_id", "text", "toxic", 1000)
    assert rows.count() == 60
    known = lab.selectExpr("doc_id id", "quality y")
    assert fit_shape(docs_of(many).selectExpr("doc_id id", "text"), known).threshold is not None
