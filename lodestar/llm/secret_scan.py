"""Secret scans (operator 2): fixed patterns plus a pair of character Markov models.

One model is trained on random strings (label 1), one on ordinary identifiers (label
0).  A candidate run of key characters is reported when the log-likelihood ratio of
the two models says random.  Training counts character pairs in the tasks, so the
models come from one grouped sum.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut, hash_sample, map_arrow, record_batch, text_slices, texts_of
from lodestar.llm.textscan import Texts, byte_table

# The patterns and least lengths that the contract names, in its order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

KEY = byte_table(lambda b: chr(b).isalnum() and b < 128 or chr(b) in "+/_-")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
LEAST_MARKOV = 20        # characters of a candidate
LEAST_SAMPLE = 8         # characters of a training string
MARGIN = 10.0            # nats by which a candidate must look random
SAMPLE_DOCS = 20_000     # documents that labelled strings are taken from, at most about
SLICE = 1 << 20

# Characters the models know; everything else is one more symbol, and one starts a string.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=."
_SYMBOL = np.full(256, len(_ALPHABET), dtype=np.int64)
for _i, _c in enumerate(_ALPHABET):
    _SYMBOL[ord(_c)] = _i
STATES = len(_ALPHABET) + 2


def pair_codes(strings: list[str]) -> np.ndarray:
    """STATES * previous symbol + symbol for every character of every string."""
    raw = np.frombuffer("\n".join(["", *strings]).encode("ascii", "replace"), dtype=np.uint8)
    sym = _SYMBOL[raw]
    sym[raw == 10] = STATES - 1
    return (STATES * sym[:-1] + sym[1:])[raw[1:] != 10]


@dataclass
class Markov:
    """log P(random) - log P(ordinary) of each character pair."""
    ratio: np.ndarray

    def llr(self, s: str) -> float:
        return float(self.ratio[pair_codes([s])].sum())


def train(samples: DataFrame, text_col: str = "text", label_col: str = "label", smoothing: float = 0.5) -> Markov:
    """Fit both models on (string, 0/1) rows; other labels and null strings are skipped.
    Without any samples of a label its model is uniform."""
    def run(batches):
        total = np.zeros((2, STATES * STATES), dtype=np.int64)
        for b in batches:
            label = b.column("label").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = b.column("text").filter(pa.array(label == k)).to_pylist()
                total[k] += np.bincount(pair_codes(own), minlength=STATES * STATES)
        k, code = np.nonzero(total)
        yield record_batch(label=k.astype(np.int32), code=code.astype(np.int32), n=total[k, code])

    rows = samples.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).where("text is not null and label in (0, 1)")
    got = map_arrow(rows, run, "label int, code int, n long").groupBy("label", "code").agg(F.sum("n").alias("n")).collect()
    count = np.full((2, STATES * STATES), smoothing)
    for r in got:
        count[r.label, r.code] += r.n
    p = count.reshape(2, STATES, STATES)
    p = np.log(p / p.sum(axis=2, keepdims=True)).reshape(2, -1)
    return Markov(p[1] - p[0])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns: leftmost, non-overlapping per kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


def untouched(matches, base: list):
    """Matches, in text order, that overlap no span of the sorted ``base``."""
    k, reach = 0, 0
    for m in matches:
        s, e = m.span()
        while k < len(base) and base[k][0] < e:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= s:
            yield m


def markov_spans(text: str, model: Markov, base: list) -> list[tuple[int, int, int]]:
    """Candidates that look random and touch no span of the fixed patterns."""
    out = []
    for m in untouched(CANDIDATE.finditer(text), base):
        s, e = m.span()
        if e - s >= LEAST_MARKOV and model.llr(m[0]) >= MARGIN:
            out.append((s, 3, e))
    return out


def suspects(texts: list[bytes]) -> np.ndarray:
    """Texts that can hold a span at all: one has a key word, AKIA or a long run of key characters."""
    t = Texts(texts, lower=False)
    start, end, doc = t.runs(KEY)
    out = np.zeros(len(texts), dtype=bool)
    out[doc[end - start >= LEAST_MARKOV - 2]] = True  # a candidate may end in ==
    for i in np.flatnonzero(~out):
        low = texts[i].lower()
        out[i] = any(k in low for k in KEYWORDS)
    return out


def spans(text: str, model: Markov) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + markov_spans(text, model, base))


def _joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def labelled_strings(docs: DataFrame, text_col: str = "text", total: int | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Training strings (text, label) of a bounded sample of documents: values that the
    fixed patterns find are 1, other identifiers outside their spans 0.  A text counts once however often it
    is repeated; about ``sample_docs`` of ``total`` (default: all) texts are taken, by hash of the text."""
    rows = docs.select(F.col(text_col).alias("text")).where("text is not null")
    rows = hash_sample(rows, ["text"], sample_docs, rows.select(F.approx_count_distinct("text", 0.02)).first()[0] if total is None else total)
    first = rows.groupBy(F.xxhash64("text"), F.md5("text")).agg(F.any_value("text").alias("text"))
    rows = first.select("text")
    ident = re.compile(r"[A-Za-z][A-Za-z0-9_-]{%d,}" % (LEAST_SAMPLE - 1))

    def run(batches):
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                strings, labels = [], []
                texts = texts_of(col.slice(lo, hi - lo))
                may = suspects(texts)
                for t, check in zip(texts, may):
                    text = t.decode("utf-8", "replace")
                    base = base_spans(text) if check else []
                    for s, k, e in base:
                        v = ASSIGN.match(text[s:e])[2] if k == 0 else text[s:e]
                        if len(v) >= LEAST_SAMPLE:
                            strings.append(v)
                            labels.append(1)
                    for m in untouched(ident.finditer(text), base):
                        strings.append(m[0])
                        labels.append(0)
                yield record_batch(text=pa.array(strings, pa.string()), label=pa.array(labels, pa.int32()))

    return map_arrow(rows, run, "text string, label int")


def scan(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    A span is ``kind:start:end`` in code points, end exclusive, listed by start and then
    in the order of ``KINDS``; ``base_sha256`` covers the fixed patterns' spans only.
    Null and empty texts have none.
    """
    def run(batches):
        for b in batches:
            col, ids = b.column("text"), b.column("id")
            for lo, hi in text_slices(col, SLICE):
                texts = texts_of(col.slice(lo, hi - lo))
                count = np.zeros((hi - lo, 4), dtype=np.int64)
                sha, joined = [hashlib.sha256(b"").hexdigest()] * (hi - lo), [""] * (hi - lo)
                for i in np.flatnonzero(suspects(texts)):
                    found = spans(texts[i].decode("utf-8", "replace"), model)
                    if found:
                        count[i] = np.bincount([k for _, k, _ in found], minlength=4)
                        sha[i] = hashlib.sha256(_joined([x for x in found if x[1] < 3]).encode()).hexdigest()
                        joined[i] = _joined(found)
                yield record_batch(doc_id=ids.slice(lo, hi - lo), n_assign=count[:, 0], n_access=count[:, 1], n_hex=count[:, 2],
                                   n_markov=count[:, 3], base_sha256=sha, spans=joined)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run,
                     "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")


def masked(text: str, found: list, mask: str) -> str:
    out, at = [], 0
    for s, _, e in sorted(found):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Markov, text_col: str = "text", length_col: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """All rows with all their columns; every span's text (overlapping spans as one) becomes
    ``mask``, and ``length_col`` follows the changed texts."""
    schema = docs.schema

    def run(batches):
        for b in batches:
            col = b.column(text_col)
            for lo, hi in text_slices(col, SLICE):
                texts, part = texts_of(col.slice(lo, hi - lo)), b.slice(lo, hi - lo)
                new = {}
                for i in np.flatnonzero(suspects(texts)).tolist():
                    text = texts[i].decode("utf-8", "replace")
                    found = spans(text, model)
                    if found:
                        new[i] = masked(text, found, mask)
                if new:
                    old = part.column(text_col).to_pylist()
                    part = part.set_column(part.schema.get_field_index(text_col), text_col,
                                           pa.array([new.get(i, t) for i, t in enumerate(old)], part.column(text_col).type))
                    if length_col in part.schema.names:
                        n = part.column(length_col)
                        part = part.set_column(part.schema.get_field_index(length_col), length_col,
                                               pa.array([len(new[i]) if i in new else v for i, v in enumerate(n.to_pylist())], n.type))
                yield part

    return map_arrow(docs, run, schema)


def fit(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Markov:
    """Both models from the strings of about ``sample_docs`` distinct texts (documented bound on labelled rows)."""
    return train(cut(labelled_strings(docs, text_col, sample_docs=sample_docs)))
