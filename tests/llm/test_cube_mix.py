import re
from collections import defaultdict

import numpy as np
import pytest

from lodestar.llm import cube_mix as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes):
    """Targets by resharing the excess until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, pool = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while free and pool > 1e-9:
        total, spare = sum(w[s] for s in free), 0.0
        for s in list(free):
            target[s] += pool * w[s] / total
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                spare += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
        pool = spare
    return target


def mixed(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, s, 1, "y", 5) for i, t, s in rows], "doc_id long, text string, source string, size int, h string, own_source int")
    return sorted([tuple(r) for r in C.mix(df.repartition(parts)).select("doc_id", "size", "source_size", "target", "taken").collect()], key=repr)


def checked(rows, got, near):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    target = goals(size)
    assert sorted((i, len(WORD.findall(t or "")), size[s], round(target[s], 6)) for i, t, s in rows if i is not None) == \
        sorted((r[0], r[1], r[2], round(r[3], 6)) for r in got if r[0] is not None)
    assert len(got) == len(rows) and all(0 <= r[4] <= 2 * r[1] and (not r[1] or r[4] % r[1] == 0) for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[round(r[3], 6), r[2]] += r[4]
    wanted = defaultdict(float)
    for s in size:
        wanted[round(target[s], 6), size[s]] += target[s]
    for k in wanted:
        assert abs(taken[k] - wanted[k]) <= near, (k, taken[k], wanted[k])


def docs(n, sources, seed=0):
    rng = np.random.default_rng(seed)
    share = np.arange(1, sources + 1) ** 1.5
    at = rng.choice(sources, n, p=share / share.sum())
    return [(k, "word " * int(rng.lognormal(4, 1)), f"s{at[k]}") for k in range(n)]


def test_targets_and_totals(spark):
    rows = docs(1500, 7)
    got = mixed(spark, rows)
    checked(rows, got, near=3)
    assert mixed(spark, rows[::-1], parts=5) == got


def test_several_levels(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET", 32)
    rows = docs(1500, 3)
    checked(rows, mixed(spark, rows), near=20)


def test_nulls_empties_long_texts_and_clashing_columns(spark):
    rows = docs(60, 2) + [(900, None, "s0"), (901, "", "s1"), (902, " \t\n\x0b\x0c\r", None), (903, "a b c d", None), (904, "x " * 50000, "S"), (905, "é", "é"),
                          (None, "no id", "s0"), (None, None, None), (906, None, "void")]
    got = mixed(spark, rows)
    checked(rows, got, near=25000)  # one document of 50,000 words is a source: it is read once or twice
    by = {r[0]: r for r in got if r[0] is not None}
    assert by[903][1] == 2 and by[904][1] == 50000 and by[906][1:] == (0, 0, 0.0, 0)


def test_repeated_rows_share_their_expectation(spark, monkeypatch):
    monkeypatch.setattr(C, "COPIES", 16)
    rows = docs(40, 2, seed=3) + [(7000, "a b c", "s0")] * 100 + [(7000, "a b c d", "s0")] + [(None, "e f", "s1")] * 90
    got = mixed(spark, rows)
    checked(rows, got, near=3)
    same = [r for r in got if r[0] == 7000 and r[1] == 3]
    share = same[0][3] / same[0][2]
    assert len(same) == 100 and abs(sum(r[4] for r in same) / 300 - share) <= 0.011


def test_empty_table(spark):
    assert mixed(spark, []) == []


def test_flight_keeps_both_totals_and_decides_all_but_two():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 500, 400).astype(float)
    pi = rng.random(400)
    out = C.flight(size, pi, rng.random(400))
    assert ((out > 0) & (out < 1)).sum() <= 2 and out.min() >= 0 and out.max() <= 1
    assert out.sum() == pytest.approx(pi.sum(), abs=1e-6) and (out * size).sum() == pytest.approx((pi * size).sum(), abs=1e-4)


def test_flight_keeps_expectations():
    size, pi = np.array([5.0, 9.0, 2.0, 7.0, 7.0]), np.array([0.2, 0.5, 0.7, 0.4, 0.3])
    rng = np.random.default_rng(2)
    mean = np.mean([C.flight(size, pi, rng.random(5)) for _ in range(20000)], axis=0)
    assert np.abs(mean - pi).max() < 0.015


def test_landing_takes_the_best_combination():
    size, pi = np.array([10.0, 3.0, 4.0, 100.0]), np.array([0.5, 0.5, 0.5, 0.05])
    out = C.land(size, pi)
    errors = {m: abs(sum(s for j, s in enumerate(size) if m >> j & 1) - (size * pi).sum()) for m in range(16)}
    assert abs((out * size).sum() - (size * pi).sum()) == pytest.approx(min(errors.values()), abs=1.1)
