"""Store of the library's own fitted models (S8): versioned Parquet, no pickles.

A model is one Parquet dataset of (format, kind, field, part, dtype, shape, reals, ints, text): array
fields as flat numbers in parts of bounded size, everything else as JSON text.  Doubles
come back bit for bit.  Kinds are named, so a loader builds only models that it knows.
"""

from __future__ import annotations

import dataclasses
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lodestar.operators.kmeans import LloydModel
from lodestar.operators.manifold import LandmarkMap
from lodestar.operators.mixture import Mixture
from lodestar.operators.reduce import ICAModel, PCAModel, WidePCA

FORMAT = 1
PART = 1 << 17  # numbers of one row


@dataclasses.dataclass
class CutPoints:
    """Cut points per feature, as the discretisers give them."""
    cuts: list


KINDS = {c.__name__: c for c in (Mixture, PCAModel, WidePCA, ICAModel, LloydModel, LandmarkMap, CutPoints)}
_SCHEMA = "format INT, kind STRING, field STRING, part INT, dtype STRING, shape ARRAY<INT>, reals ARRAY<DOUBLE>, ints ARRAY<BIGINT>, text STRING"


def _array_rows(kind: str, name: str, a: np.ndarray):
    whole = np.issubdtype(a.dtype, np.integer) or a.dtype == bool
    flat = a.ravel().astype(np.int64 if whole else np.float64).tolist()
    for part, lo in enumerate(range(0, max(len(flat), 1), PART)):
        own = flat[lo:lo + PART]
        yield (FORMAT, kind, name, part, a.dtype.str, list(a.shape), None if whole else own, own if whole else None, None)


def model_rows(model) -> list[tuple]:
    kind, out = type(model).__name__, []
    if KINDS.get(kind) is not type(model):
        raise ValueError(f"no model store for {kind}")
    for f in dataclasses.fields(model):
        v = getattr(model, f.name)
        if isinstance(v, np.ndarray):
            out += _array_rows(kind, f.name, v)
        elif isinstance(v, list) and v and all(isinstance(e, np.ndarray) for e in v):
            out.append((FORMAT, kind, f.name, -1, None, None, None, None, json.dumps(len(v))))
            for k, e in enumerate(v):
                out += _array_rows(kind, f"{f.name}/{k}", e)
        else:
            if isinstance(v, np.generic):
                v = v.item()
            text = {"tuple": list(v)} if isinstance(v, tuple) else v
            out.append((FORMAT, kind, f.name, 0, None, None, None, None, json.dumps(text, default=lambda e: e.item())))
    return out


def save(spark: SparkSession, model, path: str) -> str:
    """Writes (replacing what stood there) one model; returns the path."""
    spark.createDataFrame(model_rows(model), _SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def _value(rows: list):
    if rows[0]["dtype"] is None:
        v = json.loads(rows[0]["text"])
        return tuple(v["tuple"]) if isinstance(v, dict) and set(v) == {"tuple"} else v
    whole = rows[0]["reals"] is None
    flat = [n for r in sorted(rows, key=lambda r: r["part"]) for n in r["ints" if whole else "reals"]]
    return np.array(flat, dtype=np.int64 if whole else np.float64).astype(np.dtype(rows[0]["dtype"])).reshape(rows[0]["shape"])


def from_frame(df: DataFrame):
    """The model of a stored frame; another format or an unknown kind is refused."""
    rows = df.collect()  # a model's own size
    kinds, formats = {r["kind"] for r in rows}, {r["format"] for r in rows}
    if formats != {FORMAT} or len(kinds) != 1 or not kinds <= set(KINDS):
        raise ValueError(f"not one model of format {FORMAT}: kinds {sorted(kinds)}, formats {sorted(formats)}")
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["field"], []).append(r)
    values = {}
    for name, own in by.items():
        if "/" in name:
            continue
        if own[0]["part"] == -1:
            values[name] = [_value(by[f"{name}/{k}"]) for k in range(json.loads(own[0]["text"]))]
        else:
            values[name] = _value(own)
    return KINDS[kinds.pop()](**values)


def load(spark: SparkSession, path: str):
    return from_frame(spark.read.parquet(path))
