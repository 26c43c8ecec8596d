import random

import numpy as np
import pytest

from lodestar.llm import site_quality as Q

VOCAB = [f"{a}{b}" for a in ("ba", "ti", "re", "on") for b in ("lo", "mer", "sta", "kin", "dur")]


def corpus(n=800, seed=4):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        host = "bad.com" if i % 8 == 0 else rnd.choice(["a.com", "b.com", "c.com"])
        good = rnd.random() < (0.1 if host == "bad.com" else 0.95)
        ws = [rnd.choice(VOCAB) for _ in range(rnd.randint(8, 80))]
        text = " ".join(ws).capitalize() + "." if good else rnd.choice([" | ".join(ws), "!! ".join(ws).upper(), " ".join(w + "%%%" for w in ws), " ".join(ws[k // 9 * 9] for k in range(len(ws)))])
        docs.append((i, text, rnd.choice(["en", "fr"]), host, len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("n_chars", "p").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_shrinkage_and_edges(spark, monkeypatch):
    docs, labels = corpus()
    extra = [(5000, None, "en", "a.com", 0), (5001, "", None, None, 0), (5002, "ba " * 90_000, "en", "solo.com", 0), (None, docs[1][1], "en", "a.com", 0), docs[3]]
    known = [x for x in labels if x[0] % 2] + [(None, 1, 0), (5, None, 0), (1, labels[1][1], 0)]
    df, lab = frames(spark, docs + extra, known)
    rows = Q.judge(df, lab).collect()
    assert len(rows) == len(docs) + len(extra)
    truth = {i: q for i, q, _ in labels}
    test = [r for r in rows if r.doc_id is not None and r.doc_id < 5000 and r.doc_id % 2 == 0]
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in test]) >= 0.95
    rate = {r.host: r.host_rate for r in rows}
    assert rate["bad.com"] < 0.4 < 0.8 < rate["a.com"]
    assert rate["bad.com"] < rate["solo.com"] < rate["a.com"] + 0.1  # one document: near the global rate
    assert {r.doc_id for r in rows if r.host is None} == {5001}
    monkeypatch.setattr(Q, "BROADCAST_SITES", 0)
    again = Q.judge(df, lab).collect()
    flat = lambda rs: sorted((str(r.doc_id), str(r.host), r.path or "", r.kept, round(r.posterior, 9)) for r in rs)
    assert flat(again) == flat(rows)


def test_rates_match_grouped_sums(spark):
    docs, labels = corpus(200)
    df, lab = frames(spark, docs, labels)
    rows = Q.judge(df, lab).collect()
    n = {}
    for i, _, path, host, _ in docs:
        n.setdefault((host, path), []).append(labels[i][1])
    hosts = {}
    for (h, _), ys in n.items():
        hosts.setdefault(h, []).extend(ys)
    mean = (sum(map(sum, hosts.values())) + 0.5) / (len(docs) + 1)
    strength = lambda gs: 1 / max(1e-4, min(1, (sum(len(y) * (np.mean(y) - m) ** 2 for y, m in gs) - sum(m * (1 - m) for _, m in gs)) / sum(len(y) * m * (1 - m) for y, m in gs)))
    k = strength([(y, mean) for y in hosts.values()])
    host = {h: (sum(y) + k * mean) / (len(y) + k) for h, y in hosts.items()}
    j = strength([(y, host[h]) for (h, _), y in n.items()])
    for r in rows:
        y = n[r.host, r.path]
        assert r.host_rate == pytest.approx(host[r.host])
        own = labels[r.doc_id][1]
        rate = (sum(y) - own + j * host[r.host]) / (len(y) - 1 + j)
        assert r.path_rate == pytest.approx(rate)
        lo = lambda p: np.log(p / (1 - p))
        assert r.posterior == pytest.approx(1 / (1 + np.exp(-(lo(np.clip(r.p_doc, 1e-6, 1 - 1e-6)) + lo(rate) - lo(mean)))))


def test_empty_and_single_class(spark):
    docs, labels = corpus(60)
    df, lab = frames(spark, docs, labels)
    assert Q.judge(df.limit(0), lab.limit(0)).count() == 0
    assert Q.judge(df, lab.where("quality = 1")).where("kept").count() == 60
