import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodestar.llm import pattern_packing as P
from lodestar.llm.queries import word_tokenizer


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(word_tokenizer())


def odd_texts():
    rnd = random.Random(3)
    chars = [chr(c) for c in [*range(1, 0x250), 0x300, 0x301, 0x3A3, 0x2028, 0x3000, 0xAC00, 0x1100, 0x1161, 0x1F600, 0xFB01]]
    out = ["don't x's 'tis y.'s <|endoftext|> a<|startoftext|>b <| x", "É Œ İstanbul ﬁ ſ K ª º µ × ÷ 中文 😀", "A1b2 12.50 ½ ² ٣ q\x85r\x1cs",
           "", " ", "\n\t", "'", "a'b'c'd 's't", "ß STRASSE ÀÉÎ ÿ Ÿ naïve", "a" * 3000, "I'LL it'S _a_b_ --", "\x1f", "e\x1f'LL \x1c 0\x1c\x00\x7f?"]
    out += ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    return out + ["".join(rnd.choice(" abé'sT.,<|>1%") for _ in range(rnd.randint(1, 60))) for _ in range(400)]


def test_part_cache_gives_the_tokenizers_ids(tok, monkeypatch):
    monkeypatch.setattr(P, "CACHE_PARTS", 300)
    texts, parts = odd_texts(), P.PartIds(word_tokenizer())
    for lo in range(0, len(texts), 100):
        own = texts[lo:lo + 100]
        ids, n = parts.encode([t.encode() for t in own], 1)
        want = [tok.encode(t, add_special_tokens=False).ids + [1] for t in own]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def check_packing(rows, want, capacity):
    """Pieces equal brute-force cuts; sequences are gapless and within capacity."""
    own = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert own == sorted(want)
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(used)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_round_trip(spark, docs_of, tok, capacity):
    rnd = random.Random(1)
    docs = [(None, None), (0, ""), (1, "word " * 9000), (2, "Hello world"), (2, "Hello world"), (2, "Hello there world")]
    docs += [(10 + k, " ".join(rnd.choice(["alpha", "beta,", "Gamma", "x1", "é"]) for _ in range(rnd.randint(1, 40)))) for k in range(150)]
    want, total = [], 0
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[s:s + capacity], dtype="<u4")
            want.append((str(i), p, s, len(part), zlib.crc32(part.tobytes())))
    df = docs_of(docs).withColumnRenamed("lang", "length").withColumnRenamed("source", "part").repartition(5)
    n = check_packing(P.pack(df, word_tokenizer(), capacity=capacity).collect(), want, capacity)
    assert -(-total // capacity) <= n <= -(-total // capacity) + 2


def test_empty_table(spark, docs_of):
    assert P.pack(docs_of([]), word_tokenizer()).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 512
    h = np.zeros(capacity + 1, dtype=np.int64)
    np.add.at(h, np.clip(rng.lognormal(4, 1.2, 6000).astype(int), 1, capacity), 1)
    r = P.plan(h, capacity)
    key = (r["length"] << 44) + r["rank"]
    length = np.repeat(np.arange(capacity + 1), h)
    rank = np.arange(len(length)) - np.repeat(np.cumsum(h) - h, h)
    at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
    assert (r["length"][at] == length).all()
    k = rank - r["rank"][at]
    seq, off = r["sequence"][at] + k // r["times"][at], r["offset"][at] + k % r["times"][at] * length
    fill = np.bincount(seq, length)
    assert fill.max() <= capacity and fill.min() > 0
    o = np.lexsort((off, seq))
    same = np.diff(seq[o]) == 0
    assert (off[o][1:][same] == (off + length)[o][:-1][same]).all() and (off[o][np.concatenate(([True], ~same))] == 0).all()
    assert len(fill) <= -(-int(length.sum()) // capacity) + 1
