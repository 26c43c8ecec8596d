"""Column expressions over vector columns ``x ARRAY<DOUBLE>``.

Element-wise forms are written as explicit ``x[i]`` expressions with double
literals, so they stay inside whole-stage codegen (higher-order array
functions such as ``transform``/``aggregate`` are interpreted).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def elem(c, i: int) -> Column:
    """0-based element access."""
    return col_(c).getItem(i)


def head(c, d: int) -> Column:
    """First d entries (P8: ``mtx[, 1:d]``)."""
    return F.slice(col_(c), 1, d)


def select_idx(c, idx: Sequence[int]) -> Column:
    """Columns by index list (P2 on a vector column)."""
    return F.array(*[elem(c, int(i)) for i in idx])


def affine(c, shift: Sequence[float], scale: Sequence[float]) -> Column:
    """(x - shift) / scale element-wise; a zero or undefined scale gives 0.0."""
    out = []
    for i, (m, s) in enumerate(zip(shift, scale)):
        if s is None or s != s or s == 0.0:
            out.append(F.lit(0.0))
        else:
            out.append((elem(c, i) - F.lit(float(m))) / F.lit(float(s)))
    return F.array(*out)


def argmax_first(c) -> Column:
    """0-based index of the maximum; the first maximum wins (R ``which.max``)."""
    return (F.array_position(col_(c), F.array_max(col_(c))) - 1).cast("int")


def row_sum(c) -> Column:
    """A7 ``rowSums`` over an array column."""
    return F.aggregate(col_(c), F.lit(0.0), lambda acc, v: acc + v)
