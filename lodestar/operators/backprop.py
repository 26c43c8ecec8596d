"""Many one-hidden-layer nets trained together by back-propagation.

A net has sigmoid hidden and output units and is fitted on the squared error against one-hot
targets.  One training step is one statistics pass: every task runs all nets (all seeds, all input
sets) forward and backward over its rows and returns the summed gradients together with the
squared error and the misclassified rows of both stages, so a learning curve costs no scan
of its own.  Weights live on the driver and travel in the task closure; their number depends on
the nets, never on the rows.

Patterns are not presented one by one, as a sequential trainer would: a step uses the whole
gradient, by resilient steps (each weight has its own step size, which grows while its gradient
keeps its sign and halves when it turns) or by plain gradient descent on the mean gradient.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import partial_sums
from lodestar.functions.blocks import blocks

HIDDEN = 30
NETS, ROWS = 5, 256          # nets and rows a kernel handles at a time: what they hold stays in the CPU's cache
WEIGHTS_PER_SCAN = 2_000_000  # nets are trained in chunks of so many weights at most
SPREAD = 0.3                 # starting weights lie in [-SPREAD, SPREAD)


@dataclass(frozen=True)
class Net:
    """One net: ``cols`` are the entries of the input vector that it sees."""
    tag: tuple
    seed: int
    cols: tuple


@dataclass
class Fit:
    """A net's weights after the last step and its curve: (step, stage, squared error, wrong rows, rows)."""
    net: Net
    hidden: np.ndarray   # (inputs + 1, hidden); the last row is the bias
    output: np.ndarray   # (hidden + 1, classes)
    curve: list

    def classes(self, X: np.ndarray) -> np.ndarray:
        """Most activated output of every row (first wins)."""
        return _Stack(self.hidden[None], self.output[None], _Room()).forward(_inputs(X, list(self.net.cols)))[0].argmax(axis=0)


def start_weights(seed: int, n: int) -> np.ndarray:
    """``n`` weights in [-SPREAD, SPREAD): the k-th from the first 8 hex digits of md5("seed:k"), a
    rule that SQL can follow."""
    u = [int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16) for k in range(n)]
    return (np.array(u, dtype=np.float64) / 2.0 ** 32 * 2 - 1) * SPREAD


def _sigmoid(a: np.ndarray) -> np.ndarray:
    """Of the negated entries of ``a``, in their place."""
    np.minimum(a, 500.0, out=a)
    np.exp(a, out=a)
    a += 1.0
    return np.reciprocal(a, out=a)


class _Room:
    """Arrays that every part of the rows, whatever its length, and every stack of nets uses again."""

    def __init__(self):
        self.flat: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.flat or self.flat[name].size < size:
            self.flat[name] = np.empty(size)
        return self.flat[name][:size].reshape(shape)


class _Stack:
    """R nets on the same inputs, for passes over rows.

    Arrays lie units by rows, (R, units, rows): the nets' hidden units are one product with the rows, the others are
    products of stacked matrices without a turned copy, and what a unit holds for the rows is contiguous.  Weights
    are turned (and negated, as the sigmoid wants them) once.
    """

    def __init__(self, W1: np.ndarray, W2: np.ndarray, room: _Room):
        (self.r, self.d, self.h), self.c = W1.shape, W2.shape[2]
        self.first = -W1.transpose(0, 2, 1).reshape(self.r * self.h, self.d)
        self.second = -W2[:, :-1].transpose(0, 2, 1)
        self.bias = -W2[:, -1][:, :, None]
        self.back = np.ascontiguousarray(W2[:, :-1])
        self.room = room
        self.G1, self.G2 = np.zeros(self.first.shape), np.zeros(W2.shape)

    def forward(self, A: np.ndarray) -> np.ndarray:
        """Outputs (R, classes, rows) for rows A (rows, inputs + 1); valid until the next call of a stack in the room."""
        n = len(A)
        self.H, self.O = self.room("H", self.r * self.h, n), self.room("O", self.r, self.c, n)
        _sigmoid(np.matmul(self.first, A.T, out=self.H))
        np.matmul(self.second, self.H.reshape(self.r, self.h, n), out=self.O)
        self.O += self.bias
        return _sigmoid(self.O)

    def backward(self, A: np.ndarray, E: np.ndarray) -> None:
        """Adds the gradients of half the squared error; A went :meth:`forward` just before, E is what came less the goal."""
        n, H = len(A), self.H
        D2 = np.subtract(1.0, self.O, out=self.room("D2", self.r, self.c, n))
        D2 *= self.O
        D2 *= E
        self.G2[:, :-1] += np.matmul(H.reshape(self.r, self.h, n), D2.transpose(0, 2, 1))
        self.G2[:, -1] += D2.sum(axis=2)
        D1 = self.room("D1", self.r * self.h, n)
        np.matmul(self.back, D2, out=D1.reshape(self.r, self.h, n))
        D1 *= H
        np.subtract(1.0, H, out=H)
        D1 *= H
        self.G1 += np.matmul(D1, A, out=self.room("G1", *self.first.shape))

    def take(self, G1: np.ndarray, G2: np.ndarray) -> None:
        """Moves the gradients added so far into (R, inputs + 1, hidden) and (R, hidden + 1, classes)."""
        G1 += self.G1.reshape(self.r, self.h, self.d).transpose(0, 2, 1)
        G2 += self.G2
        self.G1[:], self.G2[:] = 0.0, 0.0

    def errors(self, O: np.ndarray, goal: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(outputs less the goal, squared error and wrong rows per net); of equal outputs the first is the answer."""
        E = np.subtract(O, goal, out=self.room("E", *O.shape))
        top, own = O.max(axis=1), O[:, target, np.arange(len(target))]
        if np.count_nonzero(O == top[:, None]) == top.size:
            wrong = np.count_nonzero(own != top, axis=1)
        else:  # equal outputs
            wrong = np.count_nonzero(O.argmax(axis=1) != target, axis=1)
        return E, np.einsum("rcn,rcn->r", E, E), wrong


def _inputs(X: np.ndarray, cols) -> np.ndarray:
    """The entries ``cols`` of every row and a 1 for the bias."""
    A = np.ones((len(X), len(cols) + 1))
    A[:, :-1] = X[:, cols]
    return A


class _Layout:
    """Where the nets' weights stand in one flat vector; nets with equal inputs stand together."""

    def __init__(self, nets: Sequence[Net], hidden: int, classes: int):
        self.groups, at = [], 0
        by_cols: dict[tuple, list[int]] = {}
        for k, net in enumerate(nets):
            by_cols.setdefault(net.cols, []).append(k)
        for cols, members in by_cols.items():
            a, b = (len(cols) + 1) * hidden, (hidden + 1) * classes
            self.groups.append((np.array(cols), members, at, len(cols) + 1, a, b))
            at += len(members) * (a + b)
        self.size, self.hidden, self.classes, self.nets = at, hidden, classes, nets

    def views(self, w: np.ndarray):
        for cols, members, at, d, a, b in self.groups:
            r = len(members)
            mid = at + r * a
            yield cols, members, w[at:mid].reshape(r, d, self.hidden), w[mid:mid + r * b].reshape(r, self.hidden + 1, self.classes)

    def start(self) -> np.ndarray:
        w = np.empty(self.size)
        for (_, members, W1, W2), (_, _, _, _, a, b) in zip(self.views(w), self.groups):
            for r, k in enumerate(members):
                own = start_weights(self.nets[k].seed, a + b)
                W1[r], W2[r] = own[:a].reshape(W1[r].shape), own[a:].reshape(W2[r].shape)
        return w


def _pass(df: DataFrame, x: str, y: str, fold: str, lay: _Layout, w: np.ndarray):
    """One scan: (gradients, (nets, 2 stages, [squared error, wrong]), rows per stage)."""
    n_nets, stacks = len(lay.nets), []

    def fn(b):
        if not stacks:  # once a task
            room = _Room()
            stacks.extend([_Stack(W1[lo:lo + NETS], W2[lo:lo + NETS], room) for lo in range(0, len(W1), NETS)] for _, _, W1, W2 in lay.views(w))
        X, target, stage = b[x], b[y].astype(np.int64), b[fold].astype(np.int64)
        out = np.zeros(lay.size + n_nets * 4 + 2)
        marks = out[lay.size:lay.size + n_nets * 4].reshape(n_nets, 2, 2)
        out[-2:] += np.bincount(stage, minlength=2)
        for s in (0, 1):
            rows = np.flatnonzero(stage == s)
            own, answer = X[rows], target[rows]
            goal = (np.arange(lay.classes)[:, None] == answer).astype(np.float64)
            for parts, (cols, members, G1, G2) in zip(stacks, lay.views(out[:lay.size])):
                A = _inputs(own, cols)
                for at, stack in zip(range(0, len(members), NETS), parts):
                    here = marks[members[at:at + NETS], s]
                    for lo in range(0, len(rows), ROWS):
                        some = A[lo:lo + ROWS]
                        E, sse, wrong = stack.errors(stack.forward(some), goal[:, lo:lo + ROWS], answer[lo:lo + ROWS])
                        here[:, 0] += sse
                        here[:, 1] += wrong
                        if s == 0:
                            stack.backward(some, E)
                    marks[members[at:at + NETS], s] = here
                    if s == 0:
                        stack.take(G1[at:at + NETS], G2[at:at + NETS])
        return out

    v = partial_sums(df, [x, y, fold], fn, lay.size + n_nets * 4 + 2)
    return v[:lay.size], v[lay.size:-2].reshape(n_nets, 2, 2), v[-2:]


class Resilient:
    """Step sizes of resilient back-propagation; a weight whose gradient turned waits one step."""
    GROW, SHRINK, FIRST, LEAST, MOST = 1.2, 0.5, 0.1, 1e-6, 50.0

    def __init__(self, size: int):
        self.step, self.last = np.full(size, self.FIRST), np.zeros(size)

    def update(self, g: np.ndarray, n: float) -> np.ndarray:
        turn = g * self.last
        self.step = np.clip(np.where(turn > 0, self.step * self.GROW, np.where(turn < 0, self.step * self.SHRINK, self.step)), self.LEAST, self.MOST)
        self.last = np.where(turn < 0, 0.0, g)
        return -np.sign(self.last) * self.step


class Descent:
    """Plain gradient descent on the mean gradient."""

    def __init__(self, rate: float):
        self.rate = rate

    def update(self, g: np.ndarray, n: float) -> np.ndarray:
        return -self.rate * g / max(n, 1.0)


def train(df: DataFrame, nets: Sequence[Net], classes: int, steps: int, x: str = "x", y: str = "label_ix", fold: str = "fold",
          hidden: int = HIDDEN, method: str = "resilient", rate: float = 0.6) -> list[Fit]:
    """Trains every net for ``steps`` steps; ``fold`` 0 marks the training rows, 1 the test rows.

    The curve has one entry per step and stage, measured with the weights after that step (step 0:
    the starting weights).  Rows of a null label are trained as a class of their own when ``y`` is a
    level index; a null in ``x``, ``y`` or ``fold`` is refused.  An empty frame leaves the starting weights.
    """
    out: list[Fit] = []
    with blocks(df.select(x, F.col(y).cast("int").alias(y), F.col(fold).cast("int").alias(fold)), [x, y, fold]) as df:
        for chunk in _chunks(nets, hidden, classes):
            lay = _Layout(chunk, hidden, classes)
            w = lay.start()
            rule = Resilient(lay.size) if method == "resilient" else Descent(rate)
            curves: list[list] = [[] for _ in chunk]
            for step in range(steps + 1):
                g, marks, rows = _pass(df, x, y, fold, lay, w)
                for k, curve in enumerate(curves):
                    curve += [(step, stage, float(marks[k, s, 0]), int(marks[k, s, 1]), int(rows[s])) for s, stage in enumerate(("Train", "Test"))]
                if step < steps:
                    w = w + rule.update(g, rows[0])
            for _, members, W1, W2 in lay.views(w):
                out += [Fit(chunk[k], W1[r].copy(), W2[r].copy(), curves[k]) for r, k in enumerate(members)]
    order = {id(net): k for k, net in enumerate(nets)}
    return sorted(out, key=lambda f: order[id(f.net)])


def _chunks(nets: Sequence[Net], hidden: int, classes: int):
    chunk, size = [], 0
    for net in nets:
        own = (len(net.cols) + 1) * hidden + (hidden + 1) * classes
        if chunk and size + own > WEIGHTS_PER_SCAN:
            yield chunk
            chunk, size = [], 0
        chunk.append(net)
        size += own
    if chunk:
        yield chunk


def stacked(fits: Sequence[Fit]) -> list[tuple]:
    """(tag..., run, idx, stage, squared error) for idx = 1 .. steps."""
    return [(*f.net.tag, f.net.seed, step, stage, sse) for f in fits for step, stage, sse, _, _ in f.curve if step]


def final_errors(fits: Sequence[Fit]) -> list[tuple]:
    """(tag..., run, stage, error rate after the last step) (M29); null for a stage without rows."""
    out = []
    for f in fits:
        last = f.curve[-1][0]
        out += [(*f.net.tag, f.net.seed, stage, wrong / n if n else None) for step, stage, _, wrong, n in f.curve if step == last]
    return out
