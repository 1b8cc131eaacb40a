"""Hinge-loss SVM over random Fourier features whose mapped rows are never stored (ML14).

The model is that of ``models.fourier_features`` and ``models.linear_svm``: the mean hinge loss of the standardised map with an
intercept, minimised by the same steps (ten pairs of L-BFGS; no step turns a coefficient's sign; a first try is always
shortened).  A mapped row takes 256 doubles, so ``LinearSVC`` passes over 25 times the design in every turn; here the
design stays as blocks of its few features, and a task maps a block's rows anew.

The loss is linear while no row's margin passes 1, so value and slopes at a new point are those at the last one plus what
the rows that passed 1 add.  A pass maps all rows in single precision, with a bound for its error: rows that may have
passed 1, or are within the bound of it, are mapped in double precision, and only they are added up.  A pass serves several lengths of a step.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.operators.cache import persist, release
from creditspark.operators.models import fourier_matrix

BLOCK_ROWS = 4096
TASK_ROWS = 1_000_000
#: Rows that are mapped at a time, for the cache.
ROWS = 256
PAIRS, TRIES, LEAST, MEMORY = 10, 20, 1e-10, 20
GROW, ARMIJO, WOLFE = 2.1, 1e-4, 0.9
SINGLE = 2.0 ** -23


@dataclass(frozen=True)
class Fourier:
    """z(x) = sqrt(2/D) cos(x W + b), as ``models.fourier_features``."""
    w: np.ndarray
    b: np.ndarray

    @property
    def scale(self) -> float:
        return math.sqrt(2.0 / len(self.b))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """By cos(u) = 2 / (1 + tan(u / 2)^2) - 1: numpy has no vector code for the cosine of doubles."""
        z = x @ (self.w / 2)
        z += self.b / 2
        np.tan(z, out=z)
        np.multiply(z, z, out=z)
        z += 1.0
        np.divide(2.0, z, out=z)
        z -= 1.0
        z *= self.scale
        return z


@dataclass
class Hinge:
    """Class 1 where ``z(x) @ coefficients + intercept`` is above 0; ``history`` has the loss after every turn."""
    map: Fourier
    coefficients: np.ndarray
    intercept: float
    history: list[float]


class Unfit(Exception):
    """No step, or none from these pairs."""


def blocks_of(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """The rows without NULLs as blocks (x, y as bytes of doubles), dealt evenly to tasks; y is -1 or 1."""
    k = len(features)
    rows = df.dropna(subset=[*features, label])
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit")
    rows = rows.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = np.stack([b.column(i).to_numpy() for i in range(k)], axis=1), b.column(k).to_numpy()
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("a label is neither 0 nor 1")
            cuts = range(0, len(y), BLOCK_ROWS)
            yield pa.RecordBatch.from_pydict({"x": pa.array([x[i:i + BLOCK_ROWS].tobytes() for i in cuts], pa.binary()),
                                              "y": pa.array([(2 * y[i:i + BLOCK_ROWS] - 1).tobytes() for i in cuts], pa.binary())})

    cores = df.sparkSession.sparkContext.defaultParallelism
    return rows.mapInArrow(run, "x binary, y binary").repartition(cores * -(-n // (cores * TASK_ROWS)))


def _passed(blocks: DataFrame, k: int, sums) -> list[np.ndarray]:
    """What ``sums`` makes of each task's (x, y) blocks; the driver gets one array a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sums((np.frombuffer(x.as_buffer()).reshape(-1, k), np.frombuffer(y.as_buffer())) for b in batches for x, y in zip(b.column(0), b.column(1)))
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    return [np.frombuffer(x.as_buffer()) for x in blocks.mapInArrow(run, "sums binary").toArrow()["sums"]]


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows: (rows, sum of y; mean, squares about it, sum of y z)."""
    d = (len(a) - 2) // 3
    n, off = a[0] + b[0], b[2:2 + d] - a[2:2 + d]
    return np.concatenate([[n, a[1] + b[1]], a[2:2 + d] + off * (b[0] / n), a[2 + d:2 + 2 * d] + b[2 + d:2 + 2 * d] + off * off * (a[0] * b[0] / n), a[2 + 2 * d:] + b[2 + 2 * d:]])


def _moments(fourier: Fourier):
    def sums(blocks) -> np.ndarray | None:
        total = None
        for x, y in blocks:
            for first in range(0, len(y), ROWS):
                z, s = fourier(x[first:first + ROWS]), y[first:first + ROWS]
                shift = z[0].copy()  # a column that does not vary has squares of exactly 0
                own = z - shift
                mean = own.mean(axis=0)
                own -= mean
                part = np.concatenate([[len(s), s.sum()], shift + mean, np.einsum("ij,ij->j", own, own), s @ z])
                total = part if total is None else _merged(total, part)
        return total

    return sums


def _changes(fourier: Fourier, points: np.ndarray, intercepts: np.ndarray):
    """For the points after the first: of the rows whose margin is below 1 there, less those where it is so at the first point,
    their number, the sum of their y and of their y z.  ``points`` are columns of weights of the map."""
    w32, b32 = fourier.w.astype(np.float32), fourier.b.astype(np.float32)
    c32, i32 = (fourier.scale * points).astype(np.float32), intercepts.astype(np.float32)
    size = fourier.scale * np.abs(points).sum(axis=0)
    d, k = len(fourier.b), len(fourier.w)
    widest = np.abs(fourier.w).max(initial=0.0)
    # rounding of the angle is at most (k + 2) half units of its parts' sizes, that of the sum (d + 8) of size; both twice here
    angle = (k + 2) * SINGLE * widest * size
    fixed = (k + 2) * SINGLE * (2 * math.pi) * size + (d + 8) * SINGLE * (size + np.abs(intercepts) + 1)

    def sums(blocks) -> np.ndarray | None:
        total = np.zeros((len(intercepts) - 1, 2 + d))
        for x, y in blocks:
            narrow = x.astype(np.float32)
            low = np.empty((len(y), len(intercepts)))
            for first in range(0, len(y), ROWS):
                rows = slice(first, first + ROWS)
                u = narrow[rows] @ w32
                u += b32
                np.cos(u, out=u)
                low[rows] = u @ c32
            slack = 1 - y[:, None] * (low + i32)
            unsure = ~(np.abs(slack) > np.abs(x).sum(axis=1)[:, None] * angle + fixed)
            on = slack > 0
            at = np.flatnonzero(unsure.any(axis=1) | (on[:, 1:] != on[:, :1]).any(axis=1))
            for first in range(0, len(at), ROWS):
                rows = at[first:first + ROWS]
                z, s = fourier(x[rows]), y[rows]
                exact = 1 - s[:, None] * (z @ points + intercepts) > 0
                moved = exact[:, 1:].astype(float) - exact[:, :1]
                total[:, 0] += moved.sum(axis=0)
                total[:, 1] += s @ moved
                total[:, 2:] += (moved * s[:, None]).T @ z
        return total.ravel()

    return sums


class _Loss:
    """The mean hinge loss and its slopes; points have one weight for each standardised column and the intercept."""

    def __init__(self, blocks: DataFrame, fourier: Fourier):
        self.blocks, self.fourier = blocks, fourier
        got = None
        for part in _passed(blocks, len(fourier.w), _moments(fourier)):
            got = part if got is None else _merged(got, part)
        d = len(fourier.b)
        if not np.isfinite(got).all():
            raise ValueError("a feature is not finite")
        self.n, self.mean = got[0], got[2:2 + d]
        std = np.sqrt(got[2 + d:2 + 2 * d] / max(self.n - 1, 1))
        self.inverse = np.divide(1.0, std, out=np.zeros(d), where=std > 0)
        self.base, self.known = np.zeros(d + 1), {}
        self.at = np.concatenate([got[:2], got[2 + 2 * d:]])  # at 0, every margin is below 1
        self.known[self.base.tobytes()] = self.at

    def unscaled(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        own = v[:-1] * self.inverse
        return own, float(v[-1] - own @ self.mean)

    def look(self, wanted: list[np.ndarray]) -> None:
        """One pass for all ``wanted`` points."""
        weights, intercepts = zip(*[self.unscaled(v) for v in [self.base, *wanted]])
        parts = _passed(self.blocks, len(self.fourier.w), _changes(self.fourier, np.stack(weights, axis=1), np.array(intercepts)))
        for v, change in zip(wanted, sum(parts).reshape(len(wanted), -1)):
            self.known[v.tobytes()] = self.at + change

    def __call__(self, v: np.ndarray) -> tuple[float, np.ndarray]:
        rows, ys, yz = (s := self.known[v.tobytes()])[0], s[1], s[2:]
        slopes = np.append((yz - self.mean * ys) * self.inverse, ys)
        return float(rows - slopes @ v) / self.n, -slopes / self.n

    def move(self, v: np.ndarray) -> None:
        """The next passes count from ``v``."""
        self.base, self.at = v, self.known[v.tobytes()]
        self.known = {v.tobytes(): self.at}


def _direction(slopes: np.ndarray, steps: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Minus the inverse Hessian of the pairs (latest first) times the slopes, without what does not descend."""
    d, first = slopes, 1.0
    if steps:
        bend = steps[0] @ turns[0]
        if not bend >= 0:
            raise Unfit
        first = bend / (turns[0] @ turns[0])
    along = []
    for s, t in zip(steps, turns):
        along.append((s @ d) / (s @ t))
        if math.isnan(along[-1]):
            raise Unfit
        d = d - along[-1] * t
    d = d * first
    for a, s, t in zip(along[::-1], steps[::-1], turns[::-1]):
        d = d + (a - (t @ d) / (s @ t)) * s
    return np.where(-d * slopes < 0, -d, 0.0)


def _step(loss: _Loss, v: np.ndarray, value: float, slopes: np.ndarray, d: np.ndarray, first: bool) -> np.ndarray:
    """The next point along ``d``.  The first length tried counts with the value at ``v``, so that it is always shortened."""
    signs = np.sign(np.where(v != 0, v, -slopes))
    slope = float(slopes @ d)
    shrink = 0.1 if first else 0.5

    def at(length: float) -> np.ndarray:
        x = v + length * d
        return np.where(np.sign(x) == signs, x, 0.0)

    def seen(length: float) -> tuple[float, float]:
        if at(length).tobytes() not in loss.known:
            ahead = GROW if first else shrink
            near = {x.tobytes(): x for x in map(at, (length, length * ahead, length * ahead * ahead)) if x.tobytes() not in loss.known}
            loss.look(list(near.values()))
        own, along = loss(at(length))
        return own, float(along @ d)

    length = 0.5 / float(np.linalg.norm(slopes)) if first else 1.0
    for k in range(TRIES):
        limit = value + length * slope * ARMIJO
        own, along = (value, None) if k == 0 and value > limit else seen(length)
        own = value if k == 0 else own
        times = shrink if own > limit else GROW if along < WOLFE * slope else shrink if along > -WOLFE * slope else 1.0
        if times == 1.0 or k == TRIES - 1:
            break
        length *= times
        if length < LEAST:
            raise Unfit
    seen(length)
    return at(length)


def fit(df: DataFrame, features: list[str], label: str, sigma: float, n_components: int = 256, seed: int = 1,
        max_iter: int = 100, tol: float = 1e-6) -> Hinge:
    """ML14; ``max_iter`` turns without convergence are reported by a warning."""
    fourier = Fourier(*fourier_matrix(len(features), sigma, n_components, seed))
    blocks = persist(blocks_of(df, features, label))
    loss = _Loss(blocks, fourier)
    v, steps, turns, failed = loss.base, [], [], False
    value, slopes = loss(v)
    history, recent = [value], [math.inf]
    while len(history) <= max_iter:
        if len(recent) > 1 and abs(value - max(recent)) <= tol * history[0] or np.linalg.norm(slopes) <= max(tol * value, 1e-8):
            break
        try:
            to = _step(loss, v, value, slopes, _direction(slopes, steps, turns), len(history) == 1)
        except Unfit:  # once more without the pairs
            if failed:
                break
            steps, turns, failed = [], [], True
            continue
        own, along = loss(to)
        steps, turns, failed = [to - v, *steps[:PAIRS - 1]], [along - slopes, *turns[:PAIRS - 1]], False
        loss.move(to)
        v, value, slopes = to, own, along
        history.append(value)
        recent = [*recent, value][-MEMORY:]
    else:
        warnings.warn(f"the Fourier SVM had not converged after {max_iter} iterations", stacklevel=2)
    release(blocks)
    return Hinge(fourier, *loss.unscaled(v), history)


def classify(df: DataFrame, features: list[str], key: str, model: Hinge) -> DataFrame:
    """(key, pred) of the rows without NULL features."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            x = np.stack([b.column(i + 1).to_numpy() for i in range(len(features))], axis=1)
            margin = np.concatenate([np.zeros(0), *[m.map(x[i:i + ROWS]) @ m.coefficients for i in range(0, len(x), ROWS)]]) + m.intercept
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((margin > 0).astype(np.int32))], [key, "pred"])

    rows = df.dropna(subset=features).select(key, *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    return rows.mapInArrow(run, f"{df.schema[key].simpleString().replace(':', ' ', 1)}, pred int")
