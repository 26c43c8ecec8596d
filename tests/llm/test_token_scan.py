import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lodestar.llm import token_scan as T


def brute(ids, sep):
    out, start, doc = [], 0, 0
    for k, x in enumerate(ids):
        if x == sep:
            out.append((doc, start, k - start, True))
            start, doc = k + 1, doc + 1
    if start < len(ids):
        out.append((doc, start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("width,block", [(2, 1), (2, 7), (4, 16), (2, 1 << 20)])
def test_blocks_are_stitched(spark, tmp_path, monkeypatch, width, block):
    monkeypatch.setattr(T, "GROUP_BLOCKS", 3)
    rnd, sep, want = random.Random(block), 50256, []
    files = {"empty": [], "only": [sep], "two": [sep, sep], "none": [1] * 40, "tail": [1, sep, 2, 3], "odd": [0x50, 0xC4, 0x50C4, sep, 0xC450 - 1]}
    files |= {f"r{k}": [rnd.choice([sep, 1, 2, 0x50C4, 0xC4]) if rnd.random() < 0.4 else rnd.randrange(50000) for _ in range(rnd.randrange(120))] for k in range(6)}
    for name, ids in files.items():
        raw = np.array(ids, dtype=f"<u{width}").tobytes()
        (tmp_path / f"{name}.bin").write_bytes(raw + (b"\x01" if name == "tail" else b""))
        want += [(name, *r) for r in brute(ids, sep)]
    got = [(r.file.split("/")[-1][:-4], r.doc, r.start, r.tokens, r.ended) for r in T.count_tokens(spark, str(tmp_path), sep, width, block).collect()]
    assert sorted(got) == sorted(want)


def test_written_files_round_trip(spark, docs_of, tmp_path):
    ranks, sep = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256
    docs = [(0, None), (1, ""), (2, "Hello world\nagain"), (3, "é😀 <|endoftext|>"), (4, "word " * 30_000), (4, "word " * 30_000), (5, "a" * 50_000)]
    T.write_flat(docs_of(docs).withColumnRenamed("lang", "ids").repartition(3), str(tmp_path / "flat"), ranks, sep)
    import base64
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    got = T.count_tokens(spark, str(tmp_path / "flat"), sep, block_tokens=1000).collect()
    want = sorted(len(enc.encode_ordinary(t or "")) for _, t in docs)
    assert sorted(r.tokens for r in got) == want and all(r.ended for r in got)
    for f in (tmp_path / "flat").glob("part-*"):
        ids = np.frombuffer(f.read_bytes(), dtype="<u2").tolist()
        assert brute(ids, sep) == sorted((r.doc, r.start, r.tokens, r.ended) for r in got if r.file.endswith(f.name))


def test_no_documents(spark, docs_of, tmp_path):
    T.write_flat(docs_of([]), str(tmp_path / "flat"), public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256)
    assert T.count_tokens(spark, str(tmp_path / "flat"), 50256).count() == 0


def test_very_many_short_documents_in_a_block(spark, tmp_path):
    import time
    ids = np.full(1_000_000, 7, dtype="<u2")
    ids[1::2] = 50256
    (tmp_path / "short.bin").write_bytes(ids.tobytes())
    t0 = time.time()
    r = T.count_tokens(spark, str(tmp_path), 50256).selectExpr("count(*) n", "sum(tokens) t", "count(distinct doc) d", "sum(start) s", "bool_and(ended) e").first()
    assert tuple(r) == (500_000, 500_000, 500_000, 2 * sum(range(500_000)), True) and time.time() - t0 < 60
